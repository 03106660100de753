"""Operator 4: packing tokenized documents into few fixed-length sequences by linear grouping."""

from __future__ import annotations

import bisect
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspan.llm.ranks import gapless
from loomspan.llm.store import written
from loomspan.llm.tokens import SLICE, default_path, encoder
from loomspan.llm.words import slices

#: Pieces over this share of the capacity are large; large ones are rounded within this many groups, whose configurations are
#: optimised in at most so many steps.
LARGE, GROUPS, STEPS = 1 / 4, 64, 2000
#: Words that a worker remembers: fewer than where tokenizing is all that a stage does.
REMEMBERED = 500_000


def pieces(docs: DataFrame, path: str, end: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of whole texts' ids and the end id.

    Only documents over `capacity` ids are cut, each piece but the last to exactly that length."""
    tail = struct.pack("<I", end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text", SLICE):
            out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []} | ({"ids": []} if with_ids else {})
            for doc, ids in zip(rows.column(0).to_pylist(), encoder(path, most=REMEMBERED).encode(rows.column(1).to_pylist()), strict=True):
                ids += tail
                for k, first in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[first : first + 4 * capacity]
                    for name, value in zip(out, (doc, k, first // 4, len(part) // 4, zlib.crc32(part), part), strict=False):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, pa.schema([(n, kinds[n]) for n in out]))

    kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "ids": pa.binary()}
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def configurations(sizes: np.ndarray, counts: np.ndarray, capacity: int, steps: int = STEPS) -> list[tuple[np.ndarray, int]]:
    """(how many of each size, how often) of combinations that fill sequences: the linear program of the fewest sequences
    that hold all counts, by column generation (Gilmore and Gomory, 1961), rounded down.

    Sizes are few, so the basis is small. Each step finds the combination that is worth the most at the present prices
    by a knapsack over the capacity, all sizes at once, and pivots it in. Stopped early, the result is no worse than where it began:
    sequences of one size each."""
    k = len(sizes)
    most = capacity // int(sizes.min())
    columns = np.diag(capacity // sizes).astype(float)
    inverse, cost, x = np.diag(1 / columns.diagonal()), np.ones(k), counts / columns.diagonal()
    for _ in range(steps):
        price = cost @ inverse
        column = _worth_most(sizes, price, capacity, most)
        enter = 1.0
        if column @ price <= 1 + 1e-9:
            low = int(price.argmin())
            if price[low] >= -1e-9:
                break
            column, enter = -np.eye(k)[low], 0.0  # more of a size than needed
        move = inverse @ column
        ratio = np.divide(x, move, out=np.full(k, np.inf), where=move > 1e-9)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        x = np.maximum(x - ratio[out] * move, 0)
        x[out] = ratio[out]
        row = inverse[out] / move[out]
        inverse -= np.outer(move, row)
        inverse[out] = row
        columns[:, out], cost[out] = column, enter
    found = [(columns[:, j].astype(int), int(x[j] + 1e-6)) for j in range(k) if cost[j]]
    return [(c, n) for c, n in found if n]


def _worth_most(sizes: np.ndarray, price: np.ndarray, capacity: int, most: int) -> np.ndarray:
    """The combination of at most `most` pieces of these sizes that is worth the most at these prices within the capacity."""
    value, choice = np.zeros(capacity + 1), []
    room = np.arange(capacity + 1)[None, :] - sizes[:, None]
    for _ in range(most):
        more = np.where(room >= 0, np.maximum(price, 0)[:, None] + value[np.maximum(room, 0)], -1.0)
        best = more.argmax(0)
        new = more[best, np.arange(capacity + 1)]
        choice.append(np.where(new > value + 1e-12, best, -1))
        value = np.maximum(new, value)
    out, left = np.zeros(len(sizes)), capacity
    for taken in reversed(choice):
        if taken[left] >= 0:
            out[taken[left]] += 1
            left -= int(sizes[taken[left]])
    return out


class Plan:
    """Where the i-th piece of each length goes, made from the counts of lengths alone.

    1. Linear grouping: large pieces, longest first, fall into groups of equal cardinality, and each
       counts as long as its group's longest. 2. Configurations: with so few sizes, a linear program over the combinations
       that fit into a sequence finds the fewest sequences; it is rounded down. 3. Substitution: actual pieces take the
       places of their groups' size, the last of a sequence the one that fills its true room the most. 4. Best fit: the few large pieces that rounding
       left, then small ones, longest first, go where the least room is left that holds them, else into new sequences.

    Pieces of equal length are told apart by nothing: the i-th ones are placed. runs: (length, from, to, first sequence, pieces
    per sequence): piece i of that length, from <= i < to, goes to first + (i - from) // per. Their number is bounded by
    capacity, groups and configurations, not by the number of pieces."""

    def __init__(self, counts: dict[int, int], capacity: int, large: float = LARGE, groups: int = GROUPS):
        self.capacity, self.runs, self.sequences = capacity, [], 0
        self.used = dict.fromkeys(counts, 0)
        self.rooms: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, how many)
        big = sorted((s for s in counts if s > capacity * large), reverse=True)
        left = self._configure([[s, counts[s]] for s in big], groups)
        self.order = sorted(self.rooms)
        for s, n in left + [(s, counts[s]) for s in sorted((s for s in counts if s not in set(big)), reverse=True)]:
            self._fit(s, n)

    @staticmethod
    def _groups(big: list[list[int]], groups: int) -> list[tuple[int, int]]:
        """(size, count) of each group; groups of one size become one."""
        each = -(-sum(n for _, n in big) // groups) if big else 0
        out: list[tuple[int, int]] = []
        room = 0
        for length, n in big:
            while n:
                if not room:
                    room = each
                    if not out or out[-1][0] != length:
                        out.append((length, 0))
                take = min(n, room)
                out[-1] = (out[-1][0], out[-1][1] + take)
                n, room = n - take, room - take
        return out

    def _configure(self, big: list[list[int]], groups: int) -> list[tuple[int, int]]:
        """Fill the program's configurations; (length, count) of what is left, longest first."""
        sizes = self._groups(big, groups)
        if not sizes:
            return []
        self.here = dict(big)
        self.lengths = sorted(self.here)
        rounded = np.array([s for s, _ in sizes])
        for config, often in configurations(rounded, np.array([float(n) for _, n in sizes]), self.capacity):
            slots = np.repeat(rounded, config).tolist()  # the longest first
            while often and self.lengths:
                often -= self._substitute(slots, often)
        return [(length, self.here[length]) for length in reversed(self.lengths)]

    def _substitute(self, slots: list[int], times: int) -> int:
        """Open up to `times` equal sequences for a configuration; how many.

        Each slot but the last takes the longest piece there is of its size or less, and the room left the longest that it holds,
        again and again. A piece taken in place of a planned, shorter one leaves that one for its own place, so the
        remaining pieces never outgrow the remaining slots."""
        taken: dict[int, int] = {}
        room = self.capacity
        for limit in [*slots[:-1], *[room] * (self.capacity // self.lengths[0])]:
            k = bisect.bisect_right(self.lengths, min(limit, room)) - 1
            while k >= 0 and self.here[self.lengths[k]] <= taken.get(self.lengths[k], 0):
                k -= 1
            if k >= 0:
                taken[self.lengths[k]] = taken.get(self.lengths[k], 0) + 1
                room -= self.lengths[k]
        times = min([times, *(self.here[length] // n for length, n in taken.items())])
        for length, n in taken.items():
            self._run(length, n * times, self.sequences, n)
            self.here[length] -= n * times
            if not self.here[length]:
                self.lengths.remove(length)
        if room:
            self.rooms.setdefault(room, []).append((self.sequences, times))
        self.sequences += times
        return times

    def _run(self, length: int, n: int, first: int, per: int) -> None:
        self.runs.append((length, self.used[length], self.used[length] + n, first, per))
        self.used[length] += n

    def _fit(self, size: int, n: int) -> None:
        while n:
            k = bisect.bisect_left(self.order, size)
            if k == len(self.order):
                new = -(-n // (self.capacity // size))
                self._open(self.capacity, self.sequences, new)
                self.sequences += new
                continue
            room = self.order[k]
            first, many = self.rooms[room].pop()
            if not self.rooms[room]:
                del self.rooms[room]
                self.order.pop(k)
            per = min(room // size, n)
            used = min(many, n // per)
            self._run(size, used * per, first, per)
            n -= used * per
            self._open(room - per * size, first, used)
            self._open(room, first + used, many - used)

    def _open(self, room: int, first: int, many: int) -> None:
        if room and many:
            if room not in self.rooms:
                self.rooms[room] = []
                bisect.insort(self.order, room)
            self.rooms[room].append((first, many))

    def table(self) -> np.ndarray:
        """runs as columns, ordered by length and from."""
        return np.array(sorted(self.runs), np.int64).reshape(-1, 5).T


def packed(parts: DataFrame, capacity: int) -> DataFrame:
    """parts (doc_id, piece, length, ids_crc32, ...) with sequence_id and offset.

    Counts of lengths (at most `capacity` numbers) go to the driver, the plan's runs (bounded likewise) to the
    executors; pieces are numbered within their length by slices, and only the pieces of one sequence meet in a
    window. parts is read three times: write it first. An empty table stays empty."""
    counts = {r.length: r.n for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
    table = Plan(counts, capacity).table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, low, _, first, per = table
        keys = length << 44 | low
        for batch in batches:
            at = {n: batch.column(n).to_numpy() for n in ("length", "_i")}
            k = np.searchsorted(keys, at["length"] << 44 | at["_i"], "right") - 1
            home = first[k] + (at["_i"] - low[k]) // per[k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home)], schema=batch.schema.append(pa.field("sequence_id", pa.int64())))

    ranked = gapless(parts, ["length"], ["doc_id", "piece", "ids_crc32"], "_i")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema)
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "piece", "_i").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranked.mapInArrow(run, f"{kinds}, sequence_id long")
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("_i")


def packed_documents(docs: DataFrame, path: str | None = None, end: int = 1, capacity: int = 4096, with_ids: bool = False) -> DataFrame:
    """One row per piece of `docs` (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids].

    Null and empty texts are one piece of the end id; documents over the capacity are cut; repeated
    rows are packed each; other columns are ignored; an empty table gives an empty result."""
    parts = written(pieces(docs, path or default_path(), end, capacity, with_ids), "pieces")
    return packed(parts, capacity)


def sequences(rows: DataFrame) -> DataFrame:
    """(sequence_id, length, ids: 32-bit little-endian) of packed_documents(with_ids=True): the training rows."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda out, x: F.concat(out, x["ids"]))
    return rows.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


def op4_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return packed_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
