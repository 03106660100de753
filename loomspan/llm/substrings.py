"""Operator 3: substring dedup by content-defined chunks with a gear rolling hash."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm.store import swept, written
from loomspan.llm.words import slices, utf8

#: A cut falls where the top BITS bits of the gear hash of WINDOW bytes are 0, if no such place lies in the NEAR bytes
#: before it; a chunk of over FAR bytes is cut every FAR bytes.
BITS, WINDOW, NEAR, FAR = 5, 32, 16, 128
#: A repeated passage counts from so many words on.
LEAST = 20
#: Code points that are compared before a run. 48 bytes into a passage the cuts agree, and a stretch of 464 more without a cut has a
#: chance of 4e-7.
REACH = 512
#: Code points that are compared behind a run: its tiny last chunks, and one chunk more.
BEHIND = 2 * FAR
_WORD = re.compile(r"[^ \t-\r]+")
_GEAR = np.random.default_rng(64206).integers(0, 2**32, 256, dtype=np.uint64).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """h[i] = sum over k < 32 of G[data[i - k]] << k: the gear hash, doubled up from one byte to WINDOW."""
    h, step = _GEAR[data], 1
    while step < WINDOW:
        more = h.copy()
        more[step:] += h[:-step] << np.uint32(step)
        h, step = more, step * 2
    return h


def cuts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the chunks of texts that begin at `at` (one more: the end), none across two texts.

    Whether a place is cut depends on the WINDOW + NEAR bytes before it alone, so an insertion moves no cut
    further on; only the even cuts within a stretch of over FAR bytes without a place shift, up to its end."""
    inside = np.repeat(np.arange(len(at) - 1), np.diff(at))
    head = (data & 0xC0) != 0x80
    place = np.flatnonzero(gear(data) >> np.uint32(32 - BITS) == 0) + 1
    place = place[place < len(data)]
    own = inside[place - 1]
    place = place[(place - at[own] >= WINDOW) & (place < at[own + 1]) & head[place]]
    own = inside[place - 1]
    fresh = np.ones(len(place), bool)
    fresh[1:] = (np.diff(place) > NEAR) | (np.diff(own) > 0)
    starts = np.unique(np.concatenate([at[:-1][np.diff(at) > 0], place[fresh]]))
    if not len(starts):
        return starts, starts
    long = np.diff(np.append(starts, len(data)))
    times = (long - 1) // FAR + 1
    even = np.repeat(starts, times) + FAR * (np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times))
    for _ in range(3):  # to the next character's first byte
        even += ~head[np.minimum(even, len(data) - 1)] & (even < len(data))
    starts = np.unique(even[even < len(data)])
    return starts, np.append(starts[1:], len(data))


def chunks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, a, size, d0, d1) of every chunk of whole texts: its first code point, how many it has, 128-bit digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            data, at = utf8(rows.column("text"))
            start, end = cuts(data, at)
            row = np.searchsorted(at, start, "right") - 1
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            raw = data.tobytes()
            digests = b"".join([hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), end.tolist(), strict=True)])
            digests = np.frombuffer(digests, "<i8").reshape(-1, 2)
            first = points[at[row]]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("key").take(pa.array(row)),
                    *map(pa.array, ((points[start] - first).astype(np.int32), (points[end] - points[start]).astype(np.int16), digests[:, 0], digests[:, 1])),
                ],
                ["key", "a", "size", "d0", "d1"],
            )

    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = slim.schema["key"].dataType.simpleString()
    return slim.mapInArrow(run, f"key {kind}, a int, size short, d0 long, d1 long")


def _lists(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, parts: sorted array of (a, b, extra, other)) of the documents with repeated chunks.

    A chunk repeats if its digest occurs again anywhere in the table; extra says that it is not the table's first of its digest (the
    smallest key, then place), other is that first one's (key, a), and the last one's for the first. A digest that a third of all
    chunks share is counted map-side; in the join back it has one row on the one side, so the other can be split."""
    parts = chunks(docs, key, text).where("key is not null")
    place = F.struct("key", "a")
    known = parts.groupBy("d0", "d1").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    extra = place != F.col("first")
    other = F.when(extra, F.col("first")).otherwise(F.col("last"))
    end = (F.col("a") + F.col("size")).alias("b")
    hit = parts.join(known, ["d0", "d1"]).select("key", "a", end, extra.alias("extra"), other.alias("other"))
    return hit.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("a", "b", "extra", "other"))).alias("parts"))


def _runs(parts: list[dict]) -> list[dict]:
    """Runs of neighbouring chunks: their spans, cut where extra changes, and the outermost chunks that are not tiny.

    A tiny chunk, of under NEAR code points, can occur elsewhere by chance: beside a first occurrence it stays too."""
    groups: list[list[dict]] = []
    end = -1
    for part in parts:
        if part["a"] > end:
            groups.append([])
        groups[-1].append(part)
        end = max(part["b"], end)
    out: list[dict] = []
    for group in groups:
        solid = [part for part in group if part["b"] - part["a"] >= NEAR] or group
        spans: list[dict] = []
        for k, part in enumerate(group):
            extra = part["extra"]
            if extra and part["b"] - part["a"] < NEAR:
                extra = all(x["extra"] for x in group[max(k - 1, 0) : k + 2])
            if spans and (extra == spans[-1]["extra"] or part["b"] <= spans[-1]["b"]):
                spans[-1]["b"] = max(part["b"], spans[-1]["b"])
            else:
                spans.append({"a": part["a"], "b": part["b"], "extra": extra})
        out.append({"spans": spans, "ends": (solid[0], solid[-1])})
    return out


def _beside(docs: DataFrame, lists: DataFrame, key: str, text: str) -> DataFrame:
    """(key, beside: array of (a, side, near, sum)): the text beside the other occurrence of the chunks at runs' ends.

    near is what lies before it (side 0, up to REACH code points) or behind it (side 1), sum a checksum of the chunk itself. The
    next cut depends on the text before it alone, so behind a run no more than one chunk can be alike."""
    kind = docs.schema[key].dataType.simpleString()

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = batch.slice(at, 200)
                out: list[tuple] = []
                own = rows.column(0).to_pylist()
                for name, parts in zip(own, rows.column(1).to_pylist(), strict=True):
                    runs = _runs(parts)
                    for k, run in enumerate(runs):
                        low, high = run["ends"]
                        before = low["a"] - (runs[k - 1]["spans"][-1]["b"] if k else 0)
                        if run["spans"][0]["a"] > (runs[k - 1]["spans"][-1]["b"] if k else 0):
                            out.append((name, low["a"], 0, low["b"] - low["a"], min(before, REACH), low["other"]["key"], low["other"]["a"]))
                        behind = runs[k + 1]["spans"][0]["a"] - high["b"] if k + 1 < len(runs) else BEHIND
                        out.append((name, high["a"], 1, high["b"] - high["a"], min(behind, BEHIND), high["other"]["key"], high["other"]["a"]))
                types = [batch.column(0).type, *[pa.int64()] * 4, batch.column(0).type, pa.int64()]
                columns = list(zip(*out, strict=True)) or [()] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["key", "a", "side", "size", "n", "at_key", "at"])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            out: list[tuple] = []
            want = rows.column("want")
            for k in np.flatnonzero(want.is_valid().to_numpy(zero_copy_only=False)).tolist():
                name, line = rows.column("key")[k].as_py(), rows.column("text")[k].as_py() or ""
                for w in want[k].as_py():
                    a, b = w["at"], w["at"] + w["size"]
                    if b > len(line):
                        continue
                    near = line[b : b + BEHIND] if w["side"] else line[max(0, a - REACH) : a]
                    out.append((name, a, w["side"], w["size"], near, zlib.crc32(line[a:b].encode())))
            types = [rows.column("key").type, *[pa.int64()] * 3, pa.string(), pa.int64()]
            columns = list(zip(*out, strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["at_key", "at", "side", "size", "near", "sum"])

    wanted = lists.mapInArrow(ends, f"key {kind}, a long, side long, size long, n long, at_key {kind}, at long")
    asked = wanted.groupBy(F.col("at_key").alias(key)).agg(F.collect_set(F.struct("at", "side", "size")).alias("want"))
    held = docs.select(key, text).join(asked, key).select(F.col(key).alias("key"), F.col(text).alias("text"), "want")
    near = held.mapInArrow(texts, f"at_key {kind}, at long, side long, size long, near string, sum long")
    met = wanted.join(near, ["at_key", "at", "side", "size"])
    cut = F.when(F.col("side") == 1, F.expr("left(near, int(n))")).otherwise(F.expr("right(near, int(n))"))
    return met.groupBy("key").agg(F.collect_set(F.struct("a", "side", cut.alias("near"), "sum")).alias("beside"))


def _alike(text: str, at: int, near: str, side: int) -> int:
    """How many code points of text from `at` on (side 1), or before it, are those of near."""
    most, n = min(len(near), len(text) - at if side else at), 0
    if side:
        while n < most and text[at + n] == near[n]:
            n += 1
    else:
        while n < most and text[at - 1 - n] == near[-1 - n]:
            n += 1
    return n


def _begun(text: str, a: int, b: int) -> int:
    return len(_WORD.findall(text[max(a - 1, 0) : b])) - (a > 0 and bool(_WORD.match(text[a - 1 : a])))


def _grown(text: str, parts: list[dict], beside: list[dict], least: int) -> list[dict]:
    """Spans (a, b, extra) of the runs of at least `least` words, each grown as far as the text is that of the other occurrence."""
    runs = _runs(parts)
    near: dict[tuple, list[dict]] = {}
    for row in beside:
        near.setdefault((row["a"], row["side"]), []).append(row)
    bounds = []
    for k, run in enumerate(runs):
        a, b = run["spans"][0]["a"], run["spans"][-1]["b"]
        grown = [0, 0]
        for side, part in enumerate(run["ends"]):
            for row in near.get((part["a"], side), ()):
                # under a repeated key the place can be another text's
                if part["b"] <= len(text) and zlib.crc32(text[part["a"] : part["b"]].encode()) == row["sum"]:
                    inside = b - part["b"] if side else part["a"] - a
                    grown[side] = max(grown[side], _alike(text, part["b"] if side else part["a"], row["near"], side) - inside)
        before = runs[k - 1]["spans"][-1]["b"] if k else 0
        behind = runs[k + 1]["spans"][0]["a"] if k + 1 < len(runs) else b + grown[1]
        bounds.append([max(a - grown[0], before), min(b + grown[1], behind)])
    for k in range(1, len(runs)):  # what both reach for is removed if either would
        if bounds[k][0] < bounds[k - 1][1]:
            if runs[k]["spans"][0]["extra"] and not runs[k - 1]["spans"][-1]["extra"]:
                bounds[k - 1][1] = bounds[k][0]
            else:
                bounds[k][0] = bounds[k - 1][1]
    out: list[dict] = []
    passage: list[dict] = []
    for (a, b), run in zip([*bounds, (None, None)], [*runs, None], strict=True):
        if run is None or (passage and a > passage[-1]["b"]):
            if sum(_begun(text, s["a"], s["b"]) for s in passage) >= least:
                out += passage
            passage = []
        if run is None:
            break
        run["spans"][0]["a"], run["spans"][-1]["b"] = a, b
        if passage and passage[-1]["extra"] == run["spans"][0]["extra"]:
            passage[-1]["b"] = run["spans"][0]["b"]
            passage += run["spans"][1:]
        else:
            passage += run["spans"]
    return out


def deduplicated(docs: DataFrame, least: int = LEAST, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with n_repeated, repeated_spans, n_removed and removed_spans, and with removed spans cut from the text.

    Spans are start:end in code points, end exclusive, comma-joined; n_ counts their code points. The first
    occurrence of each chunk stays, and of what a run grows by to both sides. Null and empty texts have no chunks and stay as they are; rows that
    repeat a key share what either repeats; a null key is never changed; such added columns are replaced."""
    added = ["n_repeated", "repeated_spans", "n_removed", "removed_spans", "_parts", "_beside", "_spans"]
    docs = docs.drop(*added)
    lists = written(_lists(docs, key, text), "lists")
    swept(docs.sparkSession)  # the chunks' shuffles take more disk than all that follows
    beside = written(_beside(docs, lists, key, text), "beside")
    swept(docs.sparkSession)
    beside = beside.select(F.col("key").alias(key), F.col("beside").alias("_beside"))
    rows = docs.join(lists.select(F.col("key").alias(key), F.col("parts").alias("_parts")), key, "left").join(beside, key, "left")

    @F.arrow_udf("array<struct<a: bigint, b: bigint, extra: boolean>>")
    def grown(texts: pa.Array, parts: pa.Array, beside: pa.Array) -> pa.Array:
        out: list = [None] * len(texts)
        for k in np.flatnonzero(parts.is_valid().to_numpy(zero_copy_only=False)).tolist():
            out[k] = _grown(texts[k].as_py() or "", parts[k].as_py(), beside[k].as_py() or [], least)
        return pa.array(out, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("extra", pa.bool_())])))

    rows = rows.withColumn("_spans", grown(text, "_parts", "_beside")).drop("_parts", "_beside")
    extra = F.filter("_spans", lambda s: s["extra"])
    width = lambda spans: F.coalesce(F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"]), F.lit(0))
    line = lambda spans: F.coalesce(F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["a"], s["b"])), ","), F.lit(""))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("text"))
    rest = lambda a, b: F.substring(F.col(text), (a + 1).cast("int"), (b - a).cast("int"))
    kept = F.aggregate(extra, start, lambda out, s: F.struct(s["b"].alias("at"), F.concat(out["text"], rest(out["at"], s["a"])).alias("text")))
    cut = F.concat(kept["text"], rest(kept["at"], F.length(text).cast("long")))
    values = {"n_repeated": width(F.col("_spans")), "repeated_spans": line(F.col("_spans")), "n_removed": width(extra), "removed_spans": line(extra)}
    return rows.withColumns(values).withColumn(text, F.when(F.col("n_removed") > 0, cut).otherwise(F.col(text))).drop("_spans")


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = deduplicated(docs)
    return out.select("doc_id", "n_repeated", "repeated_spans", "n_removed", "removed_spans", F.crc32(F.col("text").cast("binary")).alias("kept_crc32"))
