"""Operator 12: k-means on an integer grid, with Ptolemaic lower bounds from cached pivot distances."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm.store import dropped, written

#: Relative room for rounding: each bound takes fewer than twenty operations of 2**-53 each.
ROOM = 1e-13
#: Cells up to this size keep squared distances of vectors of 64 cells within 63 bits.
MOST = 1 << 27
#: Vectors measured at a time.
STRIP = 4096


def squared(cells: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of 64-bit cells to a point, or to a point each."""
    apart = cells - point
    return np.einsum("ij,ij->i", apart, apart)


class Pivots:
    """Fixed points in pairs. For any x and y, Ptolemy's inequality gives
    d(x, y) >= |d(x, p) d(y, s) - d(x, s) d(y, p)| / d(p, s) for each pair (p, s)."""

    def __init__(self, points: np.ndarray):
        self.points, self.pairs = points, []
        for p in range(len(points)):
            for s in range(p + 1, len(points)):
                gap = float(np.sqrt(np.float64(squared(points[p : p + 1], points[s])[0])))
                if gap and (p ^ 1) == s:  # each pivot is of one pair, equal ones of none
                    self.pairs.append((p, s, gap))

    def distances(self, cells: np.ndarray) -> np.ndarray:
        return np.sqrt(np.stack([squared(cells, p) for p in self.points], 1).astype(np.float64))

    def below(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Bounds, rounded down, on the squared distances between all rows of x and of y, given by their distances to the pivots."""
        out = np.zeros((len(x), len(y)))
        for p, s, gap in self.pairs:
            one, two = np.outer(x[:, p], y[:, s]), np.outer(x[:, s], y[:, p])
            both = one + two
            one -= two
            np.maximum(out, (np.abs(one) - ROOM * both) / gap, out=out)
        return out * out * (1 - 8 * ROOM)


def nearest(cells: np.ndarray, cached: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, its exact squared distance, how many distances were computed).

    The centroid of the least bound is measured first; another one only where its bound does not exceed that distance. Of equally
    near centroids the smaller number wins: bounds that equal the distance are no reason to leave one out."""
    bound = pivots.below(cached, pivots.distances(centroids))
    guess = bound.argmin(1)
    label, best = guess.copy(), squared(cells, centroids[guess])
    measured = len(cells)
    for c in range(len(centroids)):
        at = np.flatnonzero((guess != c) & (bound[:, c] <= best.astype(np.float64) * (1 + 8 * ROOM)))
        if len(at):
            found = squared(cells[at], centroids[c])
            nearer = (found < best[at]) | ((found == best[at]) & (c < label[at]))
            label[at[nearer]], best[at[nearer]] = c, found[nearer]
            measured += len(at)
    return label, best, measured


def on_grid(vectors: np.ndarray, scale: int) -> np.ndarray:
    wide = np.floor(vectors.astype(np.float64) * scale)
    if wide.size and np.abs(wide).max() > MOST:
        raise ValueError(f"a component times {scale} exceeds {MOST}: squared distances would not fit a long")
    return wide.astype(np.int64)


def _strips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, STRIP):
            yield batch.slice(at, STRIP)


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def clustered(
    vectors: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, seed: int = 3, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per clustered vector: key, cluster, distance (squared), cluster_inertia, inertia and centroid (array of longs).

    Vectors of `size` finite components become integers floor(scale * x); others (null, of other lengths, with null, NaN or infinite
    components) are left out. The first centroids are the k vectors of the smallest sha256 of "seed:key", equal hashes in the order of
    their components; a null key is clustered but never one of them. Each round assigns all vectors and replaces
    non-empty centroids by exact means, rounded down. Repeated rows count each; fewer than k vectors make fewer centroids; an empty
    table, or one of null keys alone, gives an empty result. Other columns are dropped. A component of 2**27 / scale or more raises ValueError.

    The first centroids are the pivots. Cells and pivot distances are written once; a round reads them, and what a task returns is k
    sums, added up by Spark, so that only k * (size + 1) numbers reach the driver."""
    found = F.col(vector)
    odd = F.exists(found, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.coalesce((F.size(found) == size) & ~odd, F.lit(False))).select(F.col(key).alias("key"), found.cast("array<double>").alias("vector"))
    named = rows.where("key is not null").withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256))
    first = [r.vector for r in named.orderBy("h", "vector").select("vector").limit(k).collect()]
    spark, kind = vectors.sparkSession, rows.schema["key"].dataType.simpleString()
    out = f"key {kind}, cluster int, distance long"
    if not first:
        spec = f"`{key}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
        return spark.createDataFrame([], spec)
    centroids = on_grid(np.array(first), scale)
    pivots = Pivots(centroids)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _strips(batches):
            flat = part.column("vector").flatten().to_numpy(zero_copy_only=False)
            grid = on_grid(flat.reshape(part.num_rows, size), scale)
            far = pivots.distances(grid)
            made = [pa.array([x.tobytes() for x in m], pa.binary()) for m in (grid.astype("<i4"), far.astype("<f8"))]
            yield pa.RecordBatch.from_arrays([part.column("key"), *made], ["key", "cells", "far"])

    table = written(rows.mapInArrow(cells, f"key {kind}, cells binary, far binary"), "cells")

    def assigned(part: pa.RecordBatch, now: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        grid = _matrix(part.column("cells"), "<i4", size).astype(np.int64)
        return grid, *nearest(grid, _matrix(part.column("far"), "<f8", len(pivots.points)), now, pivots)[:2]

    def moved(now: np.ndarray) -> np.ndarray:
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(now), size + 1), np.int64)
            for part in _strips(batches):
                grid, label, _ = assigned(part, now)
                total[:, size] += np.bincount(label, minlength=len(now))
                for c in np.unique(label):
                    total[c, :size] += grid[label == c].sum(0)
            c, place = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(place, pa.int32()), pa.array(total[c, place])], ["c", "place", "total"])

        parts = table.select("cells", "far").mapInArrow(sums, "c int, place int, total long")
        got = parts.groupBy("c", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
        sums_of = {(r.c, r.place): int(r.total) for r in got}
        new = now.copy()
        for c in range(len(now)):
            if n := sums_of.get((c, size)):
                new[c] = [sums_of.get((c, j), 0) // n for j in range(size)]
        return new

    for _ in range(rounds):
        centroids = moved(centroids)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _strips(batches):
            _, label, best = assigned(part, centroids)
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(label, pa.int32()), pa.array(best)], ["key", "cluster", "distance"])

    done = written(table.mapInArrow(last, out), "assigned")
    dropped(table)
    inertia = {r.cluster: int(r.total) for r in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    few = [(c, inertia[c], sum(inertia.values()), centroids[c].tolist()) for c in inertia]
    sides = spark.createDataFrame(few, "cluster int, cluster_inertia long, inertia long, centroid array<long>")  # k rows
    out = done.join(F.broadcast(sides), "cluster")
    return out.select(F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def op12_centroids(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    out = clustered(vectors)
    return out.withColumn("centroid_sha256", F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)).drop("centroid")


def _sql(k: int = 8, rounds: int = 10, size: int = 64) -> str:
    """The rounds, one after the other, as common tables."""
    apart = f"list_sum(list_transform(range(1, {size + 1}), lambda i: (v.g[i] - c.g[i]) * (v.g[i] - c.g[i])))"
    steps = [
        f"""v AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS g FROM embeddings
    WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: isfinite(x))) = {size}
)""",
        f"""c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k, g FROM v WHERE vec_id IS NOT NULL ORDER BY k LIMIT {k}
)""",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} AS MATERIALIZED (
    SELECT vec_id, g, near.d AS d, near.k AS k
    FROM (SELECT v.vec_id, v.g, min(struct_pack(d := CAST({apart} AS BIGINT), k := c.k)) AS near FROM v, c{r} c GROUP BY v.vec_id, v.g)
)"""
        )
        if r < rounds:
            steps.append(
                f"""c{r + 1} AS MATERIALIZED (
    SELECT c.k, coalesce(m.g, c.g) AS g FROM c{r} c LEFT JOIN (
        SELECT k, list(mean ORDER BY i) AS g FROM (
            SELECT k, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS mean
            FROM (SELECT k, unnest(g) AS x, unnest(range(1, {size + 1})) AS i FROM a{r}) GROUP BY k, i
        ) GROUP BY k
    ) m ON c.k = m.k
)"""
            )
    return f"""WITH {", ".join(steps)}
SELECT a.vec_id, CAST(a.k AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
    CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.g, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.k = c.k"""


SQL = _sql()
