"""Token ids of whole texts with the tokenizers library, remembered word by word."""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from loomspan.llm.memory import on_release, release

#: Words kept per worker process; beyond it the memory starts anew. About 200 bytes each.
REMEMBERED = 800_000
#: Words of these letters are one piece each for the pre-tokenizer, so many can go in as one text. Words of
#: them and of ASCII digits and marks, but no apostrophe, fall into such pieces, single digits and runs of marks.
_SIMPLE = re.compile(rb"(?:[\x21-\x26\x28-\x7e]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_PIECES = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+|[0-9]|[^a-z0-9\xc3]+")
_LETTERS = re.compile(rb"(?:[a-z]++|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])++")
#: Marks after letters are pieces of their own; the apostrophe isn't one of them.
_MARKS = bytes(x for x in range(0x21, 0x7F) if not (chr(x).isalnum() or x == 0x27))
#: Words of letters that one call of the library gets; bytes of text that a stage encodes at a time.
TOGETHER, SLICE = 2048, 1 << 21


class Encoder:
    """Encodes texts to unsigned little-endian 32-bit ids.

    For a vocabulary whose pre-tokenizer drops white space and never joins across it, and whose
    normalizer lower-cases, a text's ids are its white-space-separated words' ids in turn, and one
    full stop or comma after an ASCII letter or digit is a piece of its own. Each distinct word goes
    through the library once per worker, and is looked up once per call, however often it stands there. `by_word=False` hands whole texts to the library."""

    def __init__(self, path: str, by_word: bool = True, most: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library, self.by_word, self.most = Tokenizer.from_file(path), by_word, most
        self.letters = Tokenizer.from_str(_for_letters(self.library.to_str()))
        self.known: dict[bytes, bytes] = {}
        names = self.library.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(names.values()) + 1, bool)
        self.last[[i for w, i in names.items() if w.endswith("</w>")]] = True

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """One byte string of ids per text; null and empty texts have none."""
        if not self.by_word:
            return self.whole([t or "" for t in texts])
        low = [(t or "").encode("utf-8", "replace").lower() for t in texts]
        odd = [i for i, t in enumerate(texts) if t and "<|" in t]  # special tokens are case-sensitive
        for i in odd:
            low[i] = b""
        split = pc.ascii_split_whitespace(pa.array(low, pa.large_binary()).cast(pa.large_string()))
        coded = split.flatten().cast(pa.large_binary()).dictionary_encode()
        ids = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first, word = np.cumsum(size) - size, coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(size[word])])
        place = np.arange(ends[-1]) + np.repeat(first[word] - ends[:-1], size[word])
        raw = np.frombuffer(b"".join(ids), "<u4")[place].tobytes()
        cut = (ends[np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy())])] * 4).tolist()
        out = [raw[a:b] for a, b in zip(cut, cut[1:], strict=False)]
        for i in odd:
            out[i] = self.whole([texts[i]])[0]
        return out

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of each of distinct words; white space at the ends of a text leaves an empty one, which has none."""
        found = list(map(self.known.get, words))
        fresh = [k for k, x in enumerate(found) if x is None]
        if fresh:
            if len(self.known) > self.most:
                self.known.clear()
            self._learn([words[k] for k in fresh])
            for k in fresh:
                found[k] = self.known[words[k]]
        return found

    def _learn(self, words: list[bytes]) -> None:
        known, letters, other, ended, made = self.known, set(), set(), [], []
        for w in words:
            head = w.rstrip(_MARKS)
            if head.isalpha() or _LETTERS.fullmatch(head):
                letters.add(head)
                if tail := w[len(head) :]:
                    other.add(tail)
                    ended.append((w, head, tail))
            elif _SIMPLE.fullmatch(w) and len(pieces := _PIECES.findall(w)) > 1:
                made.append((w, pieces))
                for x in pieces:
                    (letters if _LETTERS.fullmatch(x) else other).add(x)
            else:
                other.add(w)
        new = [w for w in letters if w not in known]
        for i in range(0, len(new), TOGETHER):
            self._together(new[i : i + TOGETHER])
        new = [w for w in other if w not in known]
        known.update(zip(new, self.whole([w.decode() for w in new]), strict=True))
        known.update([(w, known[head] + known[tail]) for w, head, tail in ended])
        known.update([(w, b"".join([known[x] for x in pieces])) for w, pieces in made])

    def _together(self, words: list[bytes]) -> None:
        """Ids of many words from one call: each word's last piece ends in the end-of-word mark."""
        found = self.letters.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)
        raw = np.array(found[0].ids, "<u4").tobytes()
        cut = (np.flatnonzero(self.last[np.frombuffer(raw, "<u4")]) + 1) * 4
        if len(cut) != len(words):
            self.known.update(zip(words, self.whole([w.decode() for w in words]), strict=True))
            return
        cut = cut.tolist()
        self.known.update(zip(words, [raw[a:b] for a, b in zip([0, *cut[:-1]], cut, strict=True)], strict=True))


def _for_letters(settings: str) -> str:
    """The same model for words of lower-case or accented letters alone with blanks between them: only what such words need
    before it, so that a call takes less time."""
    own = json.loads(settings)
    steps = (own["pre_tokenizer"] or {}).get("pretokenizers", [])
    if own["normalizer"] and "Lowercase" in json.dumps(own["normalizer"]) and [x["type"] for x in steps] == ["Split", "ByteLevel"]:
        own["normalizer"] = {"type": "Lowercase"}
        steps[0] = {"type": "Split", "pattern": {"String": " "}, "behavior": "Removed", "invert": False}
    return json.dumps(own)


_made: dict[tuple, Encoder] = {}
on_release(_made.clear)


def encoder(path: str, by_word: bool = True, most: int = REMEMBERED) -> Encoder:
    """The worker process's encoder, made once; what other stages have left in the process goes first."""
    if (path, by_word, most) not in _made:
        release()
        _made[path, by_word, most] = Encoder(path, by_word, most)
    return _made[path, by_word, most]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
