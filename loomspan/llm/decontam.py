"""Operator 2: benchmark decontamination as a prefix-filtered set join on rare shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm.store import written
from loomspan.llm.words import ALNUM, Words, slices

#: Words in a window and in a shingle, and how many windows one block of the benchmark may hold.
WINDOW, SHINGLE, BLOCK = 13, 5, 500_000


class Block:
    """The distinct windows of some benchmark items, each with its shingles and, later, its rarest.

    A window of L words needs all its shingles in a document that holds it, so by the prefix principle one is
    enough to find it, and the rarest makes the fewest candidates. Its size is bounded by BLOCK windows."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW, shingle: int = SHINGLE):
        self.window, self.texts, owners = window, [], []
        seen: dict[tuple[bytes, ...], int] = {}
        words = Words(pa.array([t for _, t in items], pa.string()), ALNUM)
        for row, (item, _) in enumerate(items):
            own = [words.word(i) for i in range(words.first[row], words.first[row + 1])]
            size = min(window, len(own))
            for k in range(len(own) - size + 1 if own else 0):
                text = tuple(own[k : k + size])
                at = seen.setdefault(text, len(seen))
                if at == len(self.texts):
                    self.texts.append(text)
                    owners.append(set())
                owners[at].add(item)
        self.items = [tuple(sorted(x)) for x in owners]
        # one "document" per window, so its hashes are those that documents will have
        lines = Words(pa.array([b" ".join(t).decode() for t in self.texts], pa.string()), ALNUM)
        self.sizes = np.diff(lines.first)
        self.hashes = np.zeros(len(self.texts), np.uint64)
        self.shingles: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # words -> (hash, window, place)
        for size in np.unique(self.sizes).tolist():
            which = np.flatnonzero(self.sizes == size)
            self.hashes[which] = lines.runs(size)[lines.first[which]]
            k = min(shingle, size)
            place = np.arange(size - k + 1)
            at = (lines.first[which][:, None] + place).ravel()
            new = (lines.runs(k)[at], np.repeat(which, len(place)), np.tile(place, len(which)))
            old = self.shingles.get(k)
            self.shingles[k] = tuple(np.concatenate(x) for x in zip(old, new, strict=True)) if old else new
        self.distinct = {k: np.unique(x[0]) for k, x in self.shingles.items()}

    def choose(self, seen: dict[int, np.ndarray]) -> None:
        """Keep each window's rarest shingle by the counts over all documents; ties: the first one."""
        self.prefix = {}
        for k, (hashes, which, place) in self.shingles.items():
            rank = seen[k][np.searchsorted(self.distinct[k], hashes)]
            order = np.lexsort((place, rank, which))
            best = order[np.flatnonzero(np.diff(which[order], prepend=-1))]
            best = best[np.argsort(hashes[best], kind="stable")]
            self.prefix[k] = (hashes[best], which[best], place[best])
        del self.shingles, self.distinct


class Filter:
    """A look-up of hashes in a sorted array, behind a bitmap that turns most away."""

    def __init__(self, hashes: np.ndarray):
        self.hashes, self.map = hashes, np.zeros(1 << 20, bool)
        self.map[hashes & np.uint64(0xFFFFF)] = True

    def find(self, runs: np.ndarray) -> np.ndarray:
        """Where in runs a hash stands that the array has."""
        maybe = np.flatnonzero(self.map[runs & np.uint64(0xFFFFF)])
        if not len(maybe) or not len(self.hashes):
            return maybe[:0]
        k = np.minimum(np.searchsorted(self.hashes, runs[maybe]), len(self.hashes) - 1)
        return maybe[self.hashes[k] == runs[maybe]]


def shingle_counts(docs: DataFrame, block: Block) -> dict[int, np.ndarray]:
    """How often each of the block's shingles occurs in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(block.distinct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = {k: Filter(v) for k, v in shared.value.items()}
        total = {k: np.zeros(len(v), np.int64) for k, v in shared.value.items()}
        for rows in slices(batches, "text"):
            words = Words(rows.column("text"), ALNUM)
            for k, wanted in ready.items():
                runs = words.runs(k)
                at = wanted.find(runs)
                at = at[words.inside(k)[at]]
                total[k] += np.bincount(np.searchsorted(wanted.hashes, runs[at]), minlength=len(wanted.hashes))
        for k, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at), pa.array(n[at])], ["k", "at", "n"])

    out = {k: np.zeros(len(v), np.int64) for k, v in block.distinct.items()}
    found = docs.select("text").mapInArrow(run, "k int, at long, n long").groupBy("k", "at").agg(F.sum("n").alias("n"))
    table = found.toArrow()  # no more rows than the block has shingles
    k, at, n = (table[c].to_numpy() for c in ("k", "at", "n"))
    for size in out:
        own = k == size
        out[size][at[own]] = n[own]
    return out


def _hits(words: Words, block: Block, ready: dict[int, Filter]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, words, window) of every verified occurrence."""
    found = []
    rows = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    whole: dict[int, np.ndarray] = {}
    for k, (hashes, which, place) in block.prefix.items():
        runs = words.runs(k)
        at = ready[k].find(runs)
        low, high = np.searchsorted(hashes, runs[at], "left"), np.searchsorted(hashes, runs[at], "right")
        many = high - low
        pick = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        begin, window = np.repeat(at, many) - place[pick], which[pick]
        size = block.sizes[window]
        # length and positional bounds: the whole window must fit into the document, around the shingle
        fits = (begin >= 0) & (begin + size <= len(words.start))
        begin, window, size = begin[fits], window[fits], size[fits]
        fits = rows[begin] == rows[begin + size - 1]
        begin, window, size = begin[fits], window[fits], size[fits]
        same = np.zeros(len(begin), bool)
        for s in np.unique(size).tolist():
            if s not in whole:
                whole[s] = words.runs(s)
            own = size == s
            same[own] = whole[s][begin[own]] == block.hashes[window[own]]
        found.append((begin[same], size[same], window[same]))
    begin, size, window = (np.concatenate(x) for x in zip(*found, strict=True))
    exact = [tuple(words.word(i) for i in range(b, b + s)) == block.texts[w] for b, s, w in zip(begin.tolist(), size.tolist(), window.tolist(), strict=True)]
    exact = np.array(exact, bool)
    return begin[exact], size[exact], window[exact]


def occurrences(docs: DataFrame, block: Block | None, last: bool) -> DataFrame:
    """docs (text, hits, items, ...) with n_words, and with the block's hits and items added; text goes if last.

    hits are disjoint [a, b) runs of words, in order."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    others = [c for c in docs.columns if c not in ("hits", "items") and not (last and c == "text")]
    hit = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))

    def fused(runs: list[dict]) -> list[dict]:
        out: list[dict] = []
        for x in sorted(runs, key=lambda x: x["a"]):
            if out and x["a"] <= out[-1]["b"]:
                out[-1]["b"] = max(x["b"], out[-1]["b"])
            else:
                out.append(x)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        ready = {k: Filter(v[0]) for k, v in block.prefix.items()} if block else {}
        for rows in slices(batches, "text"):
            words = Words(rows.column("text"), ALNUM)
            hits, items = rows.column("hits").to_pylist(), [set(x) for x in rows.column("items").to_pylist()]
            touched = set()
            if ready:
                begin, size, window = _hits(words, block, ready)
                row = np.searchsorted(words.first, begin, "right") - 1
                for r, a, n, w in zip(row.tolist(), (begin - words.first[row]).tolist(), size.tolist(), window.tolist(), strict=True):
                    hits[r].append({"a": a, "b": a + n})
                    items[r].update(block.items[w])
                    touched.add(r)
            for r in touched:
                hits[r] = fused(hits[r])
            columns = [rows.column(c) for c in others]
            columns += [pa.array(np.diff(words.first)), pa.array(hits, hit), pa.array([sorted(x) for x in items], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, [*others, "n_words", "hits", "items"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others)
    return docs.mapInArrow(run, f"{kinds}, n_words long, hits array<struct<a: bigint, b: bigint>>, items array<string>")


def blocks(benchmark: DataFrame, most: int = BLOCK) -> Iterator[Block]:
    """The benchmark in blocks of at most `most` windows (or one item), streamed to the driver in turn.

    An item has no more windows than words, counted by Spark, and counts as many as eighths of its bytes at least, so a block is bounded
    in bytes too."""
    words = F.size(F.split("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    n = F.greatest(F.when(F.col("text").isNotNull(), words).otherwise(0), F.ceil(F.octet_length(F.coalesce("text", F.lit(""))) / 8).cast("int"))
    items, held = [], 0
    slim = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text", n.alias("n")).where("item_id is not null")
    for row in slim.toLocalIterator():
        if items and held + row.n > most:
            yield Block(items)
            items, held = [], 0
        items.append((row.item_id, row.text))
        held += row.n
    if items:
        yield Block(items)


def contaminated(docs: DataFrame, benchmark: DataFrame, share: int = 20, most: int = BLOCK, keep_text: bool = False) -> DataFrame:
    """docs (without text unless keep_text), with n_words, n_hit, n_items, items, items_sha256 and contaminated.

    A window is 13 consecutive words of an item, or all words of a shorter one; words inside any occurrence are
    hit; a document is contaminated when hit words are at least 1 in `share` of its words. docs keeps its other
    columns (those of the names above are replaced). Null and empty texts have no words; null items and
    empty benchmarks match nothing; repeated rows are judged each. A benchmark of more than `most` windows is
    joined in blocks, each a pass over the documents that keeps the runs found so far, so what is broadcast
    never grows beyond a block."""
    added = ["n_words", "hits", "items", "n_hit", "n_items", "items_sha256", "contaminated"]
    docs = docs.drop(*added)
    nothing = {"hits": F.array().cast("array<struct<a: bigint, b: bigint>>"), "items": F.array().cast("array<string>")}
    out, waiting = docs.withColumns(nothing), None
    for block in blocks(benchmark, most):
        if not block.texts:
            continue
        block.choose(shingle_counts(docs, block))
        if waiting is not None:
            out = written(occurrences(out, waiting, False).drop("n_words"), "hits")
        waiting = block
    out = occurrences(out, waiting, not keep_text)
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["b"] - x["a"])
    return (
        out.withColumn("n_hit", hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
        .drop("hits")
    )


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
