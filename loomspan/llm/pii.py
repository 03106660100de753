"""Operator 8: personal data by patterns, and more by a linear-chain conditional random field over word shapes."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomspan.llm.words import slices

KINDS = ("email", "ip", "card", "phone")
#: Labels of the field: nothing, then the first and the further words of each kind.
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
STEPS, RATE, DECAY = 200, 0.1, 1e-3

#: The labelled table that the field is trained on; [kind text] marks a span. Its values are from ranges kept for examples: domains
#: under example, documentation and private networks, numbers of test cards, telephone numbers kept for drama. The sentences and
#: formats are of no table that is judged.
LABELLED = """
write to [email anna.k@post.example.org] today
mail: [email j_doe+news@site.example.com], thanks
ask [email info@shop.example] or call
<[email a1@b2.example.net]> wrote
contact [email m.ruiz7@correo.example.es].
send it to [email root@localhost] please
reach [email admin@intranet] inside
user [email k.lee@build7] logged in
twitter @someone said so
at 5 @ 3 euros each
user@ host unknown
meet @ 8 or 9
@media screen and
host is [ip 10.20.30.40] now
from [ip 192.168.0.17], port 80
pinged [ip 198.51.100.4] 3 times
[ip 203.0.113.9:8080] answered
server [ip 172.16.254.3/24] up
address [ip 2001:db8::8a2e:370:7334] is new
dns [ip 2001:db8:0:1::53] and
under CC BY 4.0. end
version 3. of it
release 1.2.3 is out
section 4.5.6.7.8 of part 2
build 999.888.777.666 failed
figure 2.1.4 shows
at 12:30:45 sharp
ratio 16:9 or 4:3
paid with [card 4111 1111 1111 1111] today
card [card 5500-0000-0000-0004] expired
card no. [card 4012888888881881] ok
amex [card 3782 822463 10005], thanks
visa [card 4000.0566.5566.5556] declined
card: [card 5105/1051/0510/5100] used
order 4111111111111112 shipped
number 1234567890123456 is no card
isbn 978-3-16-148410-0 in print
issn 0317-8471 since 1999
tracking 00340434161094021501 sent
iban DE89370400440532013000 given
call [phone +44 20 7946 0958] now
dial [phone +49 30 23125 001] please
ring [phone (030) 901820 55] at night
tel. [phone (020) 7946 0143] or
call [phone 212-555-0198] soon
phone [phone 646.555.0199] today
fax [phone 030/9018-2055] ok
mobile [phone 07700 900 123] works
her number is [phone 01632 960 017] again
cell: [phone (415) 555-0134], evenings
text [phone 555-0172] first
hotline [phone 0800 496 0123] free
telefon [phone 089/99998-123] morgens
tel [phone 01 99 00 45 67] le soir
llame al [phone 900 12 34 56] hoy
born 12.04.1988 in town
on 2024-05-17 at 10:30
from 1999 to 2003 there
about 12 500 people
sold 1 250 000 copies
costs 1,299.00 euros
room 101, floor 3
pages 12-15 and 20
score 3-2 after 90 minutes
lost 21-19, 15-21 and 21-18
in 1984 and 2001.
the 1st and 2nd of 10
on 17/05/2024 and 18/05/2024
commit 3f9a2b7c81d4 broke it
md5 d41d8cd98f00b204e9800998ecf8427e matches
uuid 123e4567-e89b-12d3-a456-426614174000 is set
sha da39a3ee5e6b4b0d3255bfef95601890afd80709 here
hash 5f4dcc3b5aa765d61d8327deb882cf99 found
hex 0x7ffde12 and 0b1011
session 8f14e45fceea167a ended
checksum="e4d909c290d0fb1ca068ffaddf22cbd0" done
ref=45c48cce2e2d7fbdea1afc51 kept
part no. A320-214 fits
flight LH 400 at 10
sum 2+2 is 4
+5 points
c++ and a+b
id 20240517 noted
zip 10115 Berlin
po box 1234, 80331
temperature -12.5 and 30 degrees
coordinates 52.5200 13.4050 there
paragraph 12 (3) 4
grew 10-15 % in 2020-2021
call 3 or 4 people
phone 2 was lost
card 7 of 52
"""

_SOLID = re.compile(r"[^\x20\x09-\x0D]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_HINT = re.compile(r"[0-9@]")
_CUE = re.compile(r"[0-9@+]")
_DIGIT, _LETTER = re.compile("[0-9]"), re.compile(r"[^\W\d_]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d += d * (k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for chain in _CHAIN.finditer(text):
        parts, at = chain[0].split("."), chain.start()
        for k in range(0, len(parts) - 3, 4):  # matches do not overlap and take four parts each
            four = parts[k : k + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in four):
                yield at, at + size
            at += size + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns' matches in code points, each kind's leftmost and non-overlapping."""
    if not _HINT.search(text):
        return []
    out = [(0, a, b) for a, b in _emails(text)]
    out += [(1, a, b) for a, b in _ips(text)]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def runs(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of neighbouring words with a digit, @ or +, on one line.

    The field lets all other words be O only, so a whole text's best labelling is its runs' best ones."""
    run: list[tuple[int, int]] = []
    end = 0
    for cue in _CUE.finditer(text):
        if cue.start() < end:
            continue
        start = cue.start()
        while start > end and not _SPACE.match(text[start - 1]):
            start -= 1
        gap = text[end:start] if run else "\n"
        if run and (_SOLID.search(gap) or "\n" in gap):
            yield run
            run = []
        stop = _SPACE.search(text, cue.end())
        end = stop.start() if stop else len(text)
        run.append((start, end))
    if run:
        yield run


def _shape(word: str) -> str:
    """Runs of letters and digits by kind, long runs by length; of a shape of over 64 marks the first 64."""
    long = lambda m: "9" if len(m[0]) == 1 else f"9<{min(len(m[0]), 20)}>"
    return re.sub("[0-9]+", long, re.sub(r"[^\W\d_]+", "a", word.rstrip(".,;")))[:64]


def features(text: str, run: list[tuple[int, int]]) -> list[list[str]]:
    """What the field sees of each word of a run; words are looked at whole."""
    before = re.search(r"([^\W\d_]+)\W*\Z", text[max(0, run[0][0] - 24) : run[0][0]])
    cue = before[1].lower() if before else "^"
    words = [text[a:b] for a, b in run]
    shapes = [_shape(w) for w in words]
    digits = [len(_DIGIT.findall(w)) for w in words]
    out = []
    for k, word in enumerate(words):
        marks = "".join(sorted(set(re.sub(r"\w", "", word.rstrip(".,;")))))[:64]
        out.append(
            [
                "bias",
                f"shape {shapes[k]}",
                f"marks {marks}",
                f"digits {min(digits[k], 17)}",
                f"near {min(sum(digits[max(0, k - 3) : k + 4]), 20)}",
                f"ends {word[0] if not word[0].isalnum() else 'w'}",
                f"before {re.sub('<.*?>', '', shapes[k - 1]) if k else '^'}",
                f"after {re.sub('<.*?>', '', shapes[k + 1]) if k + 1 < len(run) else '$'}",
                f"cue {cue if not k else '-'}",
                f"letters {bool(_LETTER.search(word))}",
                f"luhn {13 <= digits[k] <= 19 and luhn(re.sub('[^0-9]', '', word))}",
            ]
        )
    return out


class Field:
    """Weights of (feature, label) and (label, next label); words unseen in training add nothing."""

    def __init__(self, table: str = LABELLED):
        sequences = [x for line in table.strip().split("\n") for x in self._marked(line)]
        names = sorted({f for fs, _ in sequences for word in fs for f in word})
        self.index = {name: k for k, name in enumerate(names)}
        n, t = len(sequences), max(len(y) for _, y in sequences)
        seen = np.zeros((n, t, len(names)))
        gold, mask = np.zeros((n, t), int), np.zeros((n, t), bool)
        for s, (fs, ys) in enumerate(sequences):
            for k, (word, y) in enumerate(zip(fs, ys, strict=True)):
                seen[s, k, [self.index[f] for f in word]] = 1
                gold[s, k], mask[s, k] = y, True
        size = len(TAGS)
        self.allowed = np.zeros((size + 1, size))  # the last row: the first word of a run
        for j, tag in enumerate(TAGS):
            if tag[0] == "I":
                self.allowed[:, j] = -1e9
                self.allowed[[TAGS.index("B" + tag[1:]), j], j] = 0
        self.weight, self.step = np.zeros((len(names), size)), np.zeros((size, size))
        self._fit(seen, gold, mask)

    @staticmethod
    def _marked(line: str) -> Iterator[tuple[list[list[str]], list[int]]]:
        text, spans = "", []
        for part in re.split(r"(\[\w+ [^\]]*\])", line):
            if part.startswith("[") and part.endswith("]"):
                kind, inner = part[1:-1].split(" ", 1)
                spans.append((kind, len(text), len(text) + len(inner.rstrip())))
                text += inner
            else:
                text += part
        for run in runs(text):
            tags = []
            for a, b in run:
                own = next(((k, s) for k, s, e in spans if a < e and s < b), None)
                tags.append(TAGS.index(f"{'B' if a <= own[1] < b else 'I'}-{own[0]}") if own else 0)
            yield features(text, run), tags

    def _fit(self, seen: np.ndarray, gold: np.ndarray, mask: np.ndarray) -> None:
        """Adam on the penalised conditional likelihood; forward and backward over all sequences at once."""
        n, t, _ = seen.shape
        hot = np.eye(len(TAGS))[gold] * mask[..., None]
        pairs = np.einsum("nti,ntj->ij", hot[:, :-1], hot[:, 1:])
        moments = [np.zeros_like(self.weight), np.zeros_like(self.weight), np.zeros_like(self.step), np.zeros_like(self.step)]
        for step in range(1, STEPS + 1):
            score = seen @ self.weight
            move = self.step + self.allowed[:-1]
            ahead, back = np.zeros_like(score), np.zeros_like(score)
            ahead[:, 0] = score[:, 0] + self.allowed[-1]
            for k in range(1, t):
                ahead[:, k] = np.where(mask[:, k, None], _logsum(ahead[:, k - 1, :, None] + move, 1) + score[:, k], ahead[:, k - 1])
            for k in range(t - 2, -1, -1):
                more = _logsum(move + (score[:, k + 1] + back[:, k + 1])[:, None, :], 2)
                back[:, k] = np.where(mask[:, k + 1, None], more, 0)
            total = _logsum(ahead[:, -1], 1)
            share = np.exp(ahead + back - total[:, None, None]) * mask[..., None]
            both = np.exp(ahead[:, :-1, :, None] + move + (score + back)[:, 1:, None, :] - total[:, None, None, None]) * mask[:, 1:, None, None]
            slopes = (np.einsum("ntf,nti->fi", seen, share - hot) / n + DECAY * self.weight, (both.sum((0, 1)) - pairs) / n + DECAY * self.step)
            for k, (value, slope) in enumerate(zip((self.weight, self.step), slopes, strict=True)):
                moments[2 * k] = 0.9 * moments[2 * k] + 0.1 * slope
                moments[2 * k + 1] = 0.99 * moments[2 * k + 1] + 0.01 * slope**2
                value -= RATE * (moments[2 * k] / (1 - 0.9**step)) / (np.sqrt(moments[2 * k + 1] / (1 - 0.99**step)) + 1e-8)

    def labels(self, sequences: list[list[list[str]]]) -> list[list[int]]:
        """The best labels of each run: Viterbi over batches of runs of like length."""
        out: list[list[int]] = [[] for _ in sequences]
        order = sorted(range(len(sequences)), key=lambda s: len(sequences[s]))
        move, at = self.step + self.allowed[:-1], 0
        while at < len(order):
            t = len(sequences[order[at]])
            batch = [s for s in order[at : at + max(1, 100_000 // t)] if len(sequences[s]) <= 2 * t]
            at += len(batch)
            t = len(sequences[batch[-1]])
            score = np.zeros((len(batch), t, len(TAGS)))
            for b, s in enumerate(batch):
                for k, word in enumerate(sequences[s]):
                    score[b, k] = self.weight[[self.index[f] for f in word if f in self.index]].sum(0)
            best, trail = score[:, 0] + self.allowed[-1], np.zeros(score.shape, np.int8)
            bests = [best]
            for k in range(1, t):
                paths = best[:, :, None] + move
                trail[:, k] = paths.argmax(1)
                best = paths.max(1) + score[:, k]
                bests.append(best)
            for b, s in enumerate(batch):
                k = len(sequences[s]) - 1
                path = [int(bests[k][b].argmax())]
                for j in range(k, 0, -1):
                    path.append(int(trail[b, j, path[-1]]))
                out[s] = path[::-1]
        return out

    def spans(self, texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
        """(kind, start, end) that the field adds to each text: none that touches a base span."""
        found = [(i, run) for i, text in enumerate(texts) if _HINT.search(text) for run in runs(text)]
        tags = self.labels([features(texts[i], run) for i, run in found])
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for (i, run), path in zip(found, tags, strict=True):
            taken: list[list[int]] = []
            for (a, b), tag in zip(run, path, strict=True):
                if TAGS[tag][0] == "B":
                    taken.append([(tag - 1) // 2, a, b])
                elif TAGS[tag][0] == "I":
                    taken[-1][2] = b
            for kind, a, b in taken:
                while a < b and texts[i][a] in "<\"'[{:,;":
                    a += 1
                while a < b and texts[i][b - 1] in ">\"'[]{}:,;.!?":
                    b -= 1
                if a < b and not any(a < y and x < b for _, x, y in base[i]):
                    out[i].append((kind, a, b))
        return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def _line(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def personal_data(docs: DataFrame, redact: bool = False) -> DataFrame:
    """docs with n_email, n_ip, n_card, n_phone and base_sha256 of the patterns' spans, and spans of all.

    Spans are kind:start:end in code points, end exclusive. Columns of these names are replaced; with `redact` the text has <KIND>
    in place of each span. Null and empty texts have no spans, and a null text stays null; whole texts are read, however
    long. The field is trained on the driver on LABELLED, some ninety lines."""
    field, added = Field(), [*(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
    docs = docs.drop(*added)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def cleaned(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
        done, out = 0, []
        for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
            if b > done:
                out += [text[done : max(a, done)], f"<{KINDS[kind].upper()}>"] if a >= done else []
                done = b
        return "".join([*out, text[done:]]) if spans else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            texts = rows.column("text").to_pylist()
            whole = [t or "" for t in texts]
            base = [base_spans(t) for t in whole]
            more = shared.value.spans(whole, base)
            every = [b + m for b, m in zip(base, more, strict=True)]
            new = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in range(len(KINDS))]
            new.append(pa.array([hashlib.sha256(_line(b).encode()).hexdigest() for b in base]))
            new.append(pa.array([_line(e) for e in every]))
            old = list(rows.columns)
            if redact:
                old[rows.schema.get_field_index("text")] = pa.array([cleaned(t, e) for t, e in zip(texts, every, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*old, *new], [*rows.schema.names, *added])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, kinds + "".join(f", n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def op8_personal_data(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return personal_data(docs).select("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans")
