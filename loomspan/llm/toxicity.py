"""Operator 7: toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.llm.memory import release
from loomspan.llm.store import dropped, written
from loomspan.llm.words import mix, slices

#: n of the n-grams, and bits of their hash: 2 ** BITS features.
SIZES, BITS = (3, 4, 5), 18
#: About how many labelled rows the counts and the linear model are fitted on at most.
COUNTED, FITTED = 40_000, 4_000
#: Occurrences below which an n-gram's ratio is 0; scale of inputs, steps and step size of the fit.
LEAST, SCALE, STEPS, RATE, DECAY = 5, 100.0, 60, 0.3, 1e-6
_Q = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(feature, row) of every character n-gram of whole lower-cased texts, a blank at either end."""
    texts = [f" {(t or '').lower()} " for t in texts]
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    long = np.array([len(t) for t in texts], np.int64)
    row = np.repeat(np.arange(len(texts), dtype=np.int32), long)
    left = np.repeat(np.cumsum(long), long) - np.arange(len(chars))
    total, features, rows = np.zeros(len(chars), np.uint64), [], []
    for n in range(1, max(SIZES) + 1):
        m = max(0, len(chars) - n + 1)
        total = total[:m] + chars[n - 1 : n - 1 + m] * _Q[n - 1]
        if n in SIZES:
            own = left[:m] >= n
            features.append((mix(total[own] + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int32))
            rows.append(row[:m][own])
    return np.concatenate(features), np.concatenate(rows)


def shares(counts: dict[int, int], most: int) -> dict[int, float]:
    """The share of each class to take so that about `most` rows come together: half of them from each, or more where the other
    has fewer. So a class of up to half the bound is taken whole, however rare it is."""
    return {k: min(1.0, max(most / 2, most - counts[1 - k]) / max(counts[k], 1)) for k in (0, 1)}


def _taken(shares: dict[int, float], word: str) -> Column:
    """Whether a row (doc_id, toxic) is in the sample: by a hash, so that it needs no sort and no single task."""
    bound = F.when(F.col("toxic") == 1, int(shares[1] * (1 << 30))).otherwise(int(shares[0] * (1 << 30)))
    return F.pmod(F.xxhash64("doc_id", F.lit(word)), F.lit(1 << 30)) < bound


def _classes(rows: DataFrame) -> dict[int, int]:
    n, toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    return {0: n - toxic, 1: toxic}


def labelled(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(doc_id, text, toxic, weight) of the documents with a label, of about `most` labels at most; weight is one over the class's share.

    The sample is bounded and so broadcast. A document with several labels is toxic if one says so; null labels say nothing."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    share = shares(_classes(known), most)
    known = known.where(_taken(share, "sample")).withColumn("weight", F.when(F.col("toxic") == 1, 1 / share[1]).otherwise(1 / share[0]))
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")


def log_count_ratios(train: DataFrame) -> np.ndarray:
    """log of (1 + count in toxic texts) over (1 + count in others), each by its class's total."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        counts = np.zeros((2, 1 << BITS), np.int64)
        for rows in slices(batches, "text"):
            features, row = grams(rows.column("text").to_pylist())
            toxic = rows.column("toxic").to_numpy()[row] > 0
            for k in (0, 1):
                counts[k] += np.bincount(features[toxic == k], minlength=1 << BITS)
        at = np.flatnonzero(counts.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[0][at]), pa.array(counts[1][at])], ["f", "n", "p"])

    found = train.select("text", "toxic").mapInArrow(run, "f long, n long, p long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    counts = np.zeros((2, 1 << BITS))
    table = found.toArrow()  # a row per feature at most
    counts[:, table["f"].to_numpy()] = table["n"].to_numpy(), table["p"].to_numpy()
    ratio = np.log((counts[1] + 1) / (counts[1].sum() + 1)) - np.log((counts[0] + 1) / (counts[0].sum() + 1))
    ratio[counts.sum(0) < LEAST] = 0
    return ratio


def inputs(texts: list[str | None], ratio: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(n-grams, frequency times ratio times SCALE) of each text, of the n-grams whose ratio isn't 0."""
    f, r = grams(texts)
    pair, n = np.unique(r.astype(np.int64) << BITS | f, return_counts=True)
    row, f = pair >> BITS, (pair & (1 << BITS) - 1).astype(np.int32)
    value = (n * ratio[f] * SCALE / np.bincount(row, weights=n, minlength=len(texts))[row]).astype(np.float32)
    row, f, value = row[value != 0], f[value != 0], value[value != 0]
    at = np.searchsorted(row, np.arange(1, len(texts)))
    return np.split(f, at), np.split(value, at)


def fitted(feature: np.ndarray, value: np.ndarray, row: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression of weighted rows on their inputs; (coefficient of each n-gram, bias)."""
    part = weight / weight.sum()
    slopes, share = np.zeros(1 << BITS), float(part @ toxic)
    bias, state = float(np.log(share / (1 - share))), [np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 0.0]
    for step in range(1, STEPS + 1):  # Adam on the full sample
        z = np.bincount(row, weights=value * slopes[feature], minlength=len(toxic)) + bias
        error = (1 / (1 + np.exp(-z)) - toxic) * part
        slope = np.bincount(feature, weights=value * error[row], minlength=1 << BITS) + DECAY * slopes
        state[0], state[1] = 0.9 * state[0] + 0.1 * slope, 0.99 * state[1] + 0.01 * slope**2
        state[2], state[3] = 0.9 * state[2] + 0.1 * error.sum(), 0.99 * state[3] + 0.01 * error.sum() ** 2
        c, d = 1 - 0.9**step, 1 - 0.99**step
        slopes -= RATE * (state[0] / c) / (np.sqrt(state[1] / d) + 1e-8)
        bias -= RATE * (state[2] / c) / (np.sqrt(state[3] / d) + 1e-8)
    return slopes, bias


def train(docs: DataFrame, labels: DataFrame, counted: int = COUNTED, fit_on: int = FITTED) -> tuple[np.ndarray, float]:
    """(weight of each n-gram's frequency, bias) from labelled rows outside the held-out fold.

    Ratios are counted on about `counted` rows, the linear model is fitted on about `fit_on` of these; both samples take each class by
    its own share, and rows weigh one over it in the fit. Without any toxic, or any other, training row there is nothing to tell
    apart: the weights are 0 and the bias is the smoothed share."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    rows = written(labelled(docs, labels.where(fold != 0), counted), "train")
    counts = _classes(rows)
    if not all(counts.values()):
        return np.zeros(1 << BITS), float(np.log((counts[1] + 1) / (counts[0] + 1)))
    ratio = docs.sparkSession.sparkContext.broadcast(log_count_ratios(rows))
    share = shares(counts, fit_on)
    some = rows.where(_taken(share, "fit")).withColumn("weight", F.col("weight") / F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for part in slices(batches, "text"):
            feature, value = inputs(part.column("text").to_pylist(), ratio.value)
            lists = [pa.array(feature, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays([*part.select(["doc_id", "toxic", "weight"]).columns, *lists], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        table = pa.Table.from_batches(list(batches))
        long = pc.list_value_length(table["feature"]).to_numpy()
        row = np.repeat(np.arange(len(long), dtype=np.int32), long)
        flat = [np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table[n].chunks]) for n in ("feature", "value")]
        slopes, bias = fitted(*flat, row, table["toxic"].to_numpy().astype(float), table["weight"].to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array([*(slopes * ratio.value * SCALE).tolist(), bias])], ["w"])

    names = ["doc_id", "toxic", "weight", "feature", "value"]
    key = rows.schema["doc_id"].dataType.simpleString()
    ready = written(some.mapInArrow(extract, f"doc_id {key}, toxic int, weight double, feature array<int>, value array<float>"), "inputs")
    # a bounded sample's inputs, so one task
    model = ready.repartition(1).sortWithinPartitions("doc_id").mapInArrow(run, "w double").toArrow()["w"].to_numpy()
    dropped(ready)
    dropped(rows)
    return model[:-1], float(model[-1])


def scored(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """docs with held_out, score (0 to 1) and predicted (such columns are replaced).

    The score reads the text alone: null and empty texts get the bias's score, repeated texts the same
    one, long ones are read whole. A null doc_id is never held out."""
    docs = docs.drop("held_out", "score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast((model[0].astype(np.float32), model[1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        weight, bias = shared.value
        for rows in slices(batches, "text", 1 << 20):
            features, row = grams(rows.column("text").to_pylist())
            size = np.bincount(row, minlength=rows.num_rows)
            z = np.bincount(row, weights=weight[features], minlength=rows.num_rows) / np.maximum(size, 1) + bias
            score = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(score)], schema=rows.schema.append(pa.field("score", pa.float64())))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    out = docs.mapInArrow(run, f"{kinds}, score double")
    return out.withColumns({"held_out": fold, "predicted": (F.col("score") >= 0.5).cast("int")})


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    return scored(docs, model).select("doc_id", "held_out", "score", "predicted")
