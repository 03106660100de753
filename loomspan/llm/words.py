"""Words of texts and their hashes, for whole Arrow batches in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` and `[^\x20\x09-\x0D]` over UTF-8 bytes after A-Z became a-z.
ALNUM = np.ones(256, bool)
ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False
SOLID = np.ones(256, bool)
SOLID[[0x20, *range(0x09, 0x0E)]] = False

_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most `most` bytes of text, or of one row: bounds numpy's memory."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = utf8(batch.column(text))
        row = 0
        while row < batch.num_rows:
            end = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
            yield batch.slice(row, end - row)
            row = end


class Words:
    """Words of a text column: data (lower-cased bytes), start and end of each, first (per row, one more)."""

    def __init__(self, column: pa.Array, inside: np.ndarray):
        raw, at = utf8(column)
        self.data, n = LOWER[raw], len(raw)
        mask = inside[self.data]
        edge = np.zeros(n + 1, bool)
        edge[at] = True
        before = np.empty(n, bool)
        before[:1], before[1:] = False, mask[:-1]
        after = np.empty(n, bool)
        after[-1:], after[:-1] = False, mask[1:]
        self.start = np.flatnonzero(mask & (~before | edge[:n]))
        self.end = np.flatnonzero(mask & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, at)
        self.hash = self._hash(mask)

    def _hash(self, mask: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        long = self.end - self.start
        own = np.cumsum(long) - long
        place = np.arange(int(long.sum())) - np.repeat(own, long)
        return mix(np.add.reduceat(_BYTE[self.data[mask]] * powers(_P, int(long.max()))[place], own))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()

    def runs(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; those that run over the row's end mean nothing."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        q = powers(_Q, k)
        total = self.hash[:n] * q[0]
        for j in range(1, k):
            total += self.hash[j : j + n] * q[j]
        return mix(total + np.uint64(k))

    def inside(self, k: int) -> np.ndarray:
        """Whether k words from each start lie in one row (of the length of runs(k))."""
        n = max(0, len(self.hash) - k + 1)
        ends = np.repeat(self.first[1:], np.diff(self.first))
        return np.arange(n) + k <= ends[:n]
