"""Span lists of a row as Python lists of (start, end), for what no column function expresses.

All are small helpers of Arrow functions; spans are closed, ascending and without overlaps."""

from __future__ import annotations

import re

from loomspan.functions.splice import STRANDS

Spans = list[tuple[int, int]]


def length(spans: Spans) -> int:
    return sum(e - s + 1 for s, e in spans)


def plain(seq: str) -> str:
    """The sequence without junction marks."""
    return seq.replace(":", "")


def bases(seq: str) -> str:
    """The bases that lie on the genome: no junction marks and no insertions."""
    return re.sub(r"\+[^+]*\+", "", plain(seq))


def insertions(seq: str, spans: Spans) -> dict[int, str]:
    """What is inserted before each place of the genome."""
    out, at, places = {}, 0, [p for s, e in spans for p in range(s, e + 1)]
    for k, part in enumerate(plain(seq).split("+")):
        if k % 2 and at < len(places):
            out[places[at]] = part
        elif not k % 2:
            at += len(part)
    return out


def grouped(flags: list[bool], chars: list[str]):
    """(flag, characters) of each run of equal flags."""
    at = 0
    for k in range(1, len(flags) + 1):
        if k == len(flags) or flags[k] != flags[at]:
            yield flags[at], chars[at:k]
            at = k


def with_insertions(seq: str, spans: Spans, inserted: dict[int, str]) -> str:
    """A marked sequence with insertions put before their places."""
    if not inserted:
        return seq
    out, places = [], iter(p for s, e in spans for p in range(s, e + 1))
    for base in seq:
        if base != ":" and (more := inserted.get(next(places))):
            out.append(f"+{more}+")
        out.append(base)
    return "".join(out)


def marked(seq: str, spans: Spans) -> str:
    """The sequence with a colon where the spans leave a gap."""
    out, at = [], 0
    for s, e in spans:
        out.append(seq[at : at + e - s + 1])
        at += e - s + 1
    return ":".join(out)


def cut_front(spans: Spans, seq: str, n: int) -> tuple[Spans, str]:
    """Without the first n bases."""
    out, left = [], n
    for s, e in spans:
        gone = min(left, e - s + 1)
        left -= gone
        if s + gone <= e:
            out.append((s + gone, e))
    return out, seq[n:]


def cut_back(spans: Spans, seq: str, n: int) -> tuple[Spans, str]:
    """Without the last n bases."""
    keep = max(length(spans) - n, 0)
    out, left = [], keep
    for s, e in spans:
        take = min(left, e - s + 1)
        left -= take
        if take:
            out.append((s, s + take - 1))
    return out, seq[:keep]


def common(lists: list[Spans], seq: str) -> tuple[Spans, str]:
    """The longest region that all lists cover, as the first list has it, and its part of the first list's sequence.

    A region goes on over places that no list covers, and ends at one that only some do; the first of equals wins."""
    change: dict[int, int] = {}
    for spans in lists:
        for s, e in spans:
            change[s] = change.get(s, 0) + 1
            change[e + 1] = change.get(e + 1, 0) - 1
    edges, covering = sorted(change), 0
    best, run = (0, 0, 0), None
    for low, high in zip(edges, edges[1:], strict=False):
        covering += change[low]
        if covering == len(lists):
            run = (run[0], high - 1, run[2] + high - low) if run else (low, high - 1, high - low)
            best = run if run[2] > best[2] else best
        elif covering:
            run = None
    low, high, size = best
    if not size:
        return [], ""
    skipped = sum(min(e, low - 1) - s + 1 for s, e in lists[0] if s < low)
    inside = [(max(s, low), min(e, high)) for s, e in lists[0] if e >= low and s <= high]
    return inside, seq[skipped : skipped + size]


def one_of_mates(up: tuple[Spans, str], down: tuple[Spans, str], contained: bool = False, repair: bool = False) -> tuple[Spans, str] | None:
    """Touching or overlapping mates (spans, marked sequence) as one alignment, or None if their blocks contradict each other.

    contained: a mate within a block of the upstream one adds nothing. repair: else try without the downstream mate's first base, then
    without the upstream one's last."""
    (u, us), (d, ds) = (up[0], bases(up[1])), (down[0], bases(down[1]))
    if contained and len(d) == 1 and any(s <= d[0][0] and d[0][1] <= e for s, e in u):
        found = (u, us)
    else:
        found = fuse(u, d, us, ds, dangling=0) if d[-1][1] >= u[-1][1] else None
    if repair and not found and d[-1][1] > u[-1][1]:
        tries = ((u, us, *cut_front(d, ds, 1)), (*cut_back(u, us, 1), d, ds))
        found = next((x for a, b, c, e in tries if a and c and (x := fuse(a, c, b, e, dangling=0))), None)
    if not found:
        return None
    inserted = insertions(up[1], up[0]) | insertions(down[1], down[0])
    return found[0], with_insertions(marked(found[1], found[0]), found[0], inserted)


def fuse(up: Spans, down: Spans, up_seq: str, down_seq: str, dangling: int = 6) -> tuple[Spans, str] | None:
    """Two mates as one alignment, or None if their blocks contradict each other where they overlap.

    A last block of the upstream mate of at most `dangling` bases that lies behind the whole downstream mate is
    taken for misaligned and dropped, and so is the downstream mate's first block before the upstream one."""
    while len(up) > 1 and up[-1][1] - up[-1][0] < dangling and down[-1][1] < up[-1][1]:
        up, up_seq = cut_back(up, up_seq, up[-1][1] - up[-1][0] + 1)
    while len(up) > 1 and len(down) > 1 and down[0][1] - down[0][0] < dangling and down[0][0] < up[0][0]:
        down, down_seq = cut_front(down, down_seq, down[0][1] - down[0][0] + 1)
    if up[-1][1] + 1 == down[0][0]:
        return [*up[:-1], (up[-1][0], down[0][1]), *down[1:]], up_seq + down_seq
    if up[-1][1] < down[0][0]:
        return up + down, up_seq + down_seq
    first = next((k for k, (s, e) in enumerate(up) if s <= down[0][0] <= e), None)
    if first is None or len(up) - first > len(down):
        return None
    shared = list(zip(up[first:], down, strict=False))
    inner = all(u[1] == d[1] for u, d in shared[:-1]) and all(u[0] == d[0] for u, d in shared[1:])
    if not inner or not shared[-1][1][0] <= up[-1][1] <= shared[-1][1][1]:
        return None
    merged = [*up[:first], (up[first][0], down[0][1]), *down[1:]]
    new = length(merged) - length(up)
    return merged, up_seq + (down_seq[len(down_seq) - new :] if new else "")


def attempts(spans: Spans, seq: str, ends: bool = True, most: int = 6):
    """The alignment with one to three bases off its front, then off its back; or without a short first, then last block."""
    if ends:
        for n in (1, 2, 3):
            yield cut_front(spans, seq, n)
        for n in (1, 2, 3):
            yield cut_back(spans, seq, n)
        return
    if len(spans) > 1 and spans[0][1] - spans[0][0] < most:
        yield cut_front(spans, seq, spans[0][1] - spans[0][0] + 1)
    if len(spans) > 1 and spans[-1][1] - spans[-1][0] < most:
        yield cut_back(spans, seq, spans[-1][1] - spans[-1][0] + 1)


def fused_mates(a: tuple[Spans, str], b: tuple[Spans, str], a_first: bool) -> tuple[Spans, str] | None:
    """a and b fused as they are, else after small repairs of a's ends, a's end blocks, then b's; the first that fits."""

    def tried(x: tuple[Spans, str], y: tuple[Spans, str]) -> tuple[Spans, str] | None:
        if not x[0] or not y[0]:
            return None
        (u, us), (d, ds) = (x, y) if a_first else (y, x)
        return fuse(u, d, us, ds)

    found = tried(a, b)
    for repaired in () if found else (*attempts(*a), *attempts(*a, ends=False)):
        found = found or tried(repaired, b)
    for repaired in () if found else attempts(*b, ends=False):
        found = found or tried(a, repaired)
    return found


def trimmed(spans: Spans, seq: str, genome: str) -> tuple[Spans, str]:
    """Without the bases at both ends up to the first two neighbours that both match the genome.

    Of two end bases, a wrong inner one takes both off, a wrong outer one itself."""
    front = _bad(seq, genome)
    spans, seq, genome = *cut_front(spans, seq, front), genome[front:]
    return cut_back(spans, seq, _bad(seq[::-1], genome[::-1]))


def _bad(seq: str, genome: str) -> int:
    at = 0
    while at + 1 < len(seq):
        if seq[at + 1] != genome[at + 1]:
            at += 2
        elif seq[at] != genome[at]:
            at += 1
        else:
            return at
    return len(seq)


def sam_fields(spans: Spans, seq: str, left: int, right: int, genome: str | None, intron: int = 15) -> tuple[str, str | None, int | None, str | None]:
    """(CIGAR, MD, NM, strand of the introns) of a marked sequence. genome: the bases under the spans, those of gaps shorter than
    `intron`, and of others the first and the last two; null or of another length: CIGAR only."""
    ops: list[list] = [[left, "S"]] if left > 0 else []
    md, same, wrong, at, ref, strands = [], 0, 0, 0, 0, set()

    def add(n: int, op: str) -> None:
        if ops and ops[-1][1] == op:
            ops[-1][0] += n
        else:
            ops.append([n, op])

    gaps = [s - e - 1 for (_, e), (s, _) in zip(spans, spans[1:], strict=False)]
    sound = genome is not None and len(genome) == length(spans) + sum(g if g < intron else 4 for g in gaps)
    genome, text = genome if sound else "", plain(seq)
    for k, (s, e) in enumerate(spans):
        if k and gaps[k - 1] < intron:
            add(gaps[k - 1], "D")
            md.append(f"{same}^{genome[ref : ref + gaps[k - 1]]}")
            same, wrong, ref = 0, wrong + gaps[k - 1], ref + gaps[k - 1]
        elif k:
            add(gaps[k - 1], "N")
            strands.add(STRANDS.get(genome[ref : ref + 4].upper()))
            ref += 4
        n = e - s + 1
        while n:
            if text[at : at + 1] == "+":
                end = text.index("+", at + 1)
                add(end - at - 1, "I")
                wrong, at = wrong + end - at - 1, end + 1
                continue
            add(1, "M")
            if sound and text[at] != genome[ref]:
                md.append(f"{same}{genome[ref]}")
                same, wrong = 0, wrong + 1
            else:
                same += 1
            at, ref, n = at + 1, ref + 1, n - 1
    if right > 0:
        ops.append([right, "S"])
    strands.discard(None)
    cigar = "".join(f"{n}{op}" for n, op in ops)
    return (cigar, "".join(md) + str(same), wrong, strands.pop() if len(strands) == 1 else None) if sound else (cigar, None, None, None)
