"""Operator 1: near-duplicate embeddings by int8 tile products with rigorous error bounds."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm.ranks import components
from loomspan.llm.store import dropped, file_system, put_once, shared_dir, written

#: Vectors in a block (a tile multiplies two blocks), rows multiplied at a time, terms of cosines recomputed at a time, and up to how
#: many vectors of a block are read one by one.
BLOCK, STRIP, TERMS, FEW = 4096, 512, 1 << 22, 16
#: Room for rounding in the bounds themselves.
SLACK = 1e-9


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return wide / np.sqrt((wide * wide).sum(1, keepdims=True))


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(unit vectors, int8 codes, scale, error norm): |unit - scale * code| is the error norm, per vector."""
    unit = _unit(vectors)
    scale = np.abs(unit).max(1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.sqrt(((unit - codes * scale[:, None]) ** 2).sum(1))
    return unit, codes, scale, error


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 codes: sums of up to 1024 terms of at most 127 * 127 are exact in float32."""
    out = a[:, :1024].astype(np.float32) @ b[:, :1024].astype(np.float32).T
    for k in range(1024, a.shape[1], 1024):
        out = out.astype(np.float64) + a[:, k : k + 1024].astype(np.float32) @ b[:, k : k + 1024].astype(np.float32).T
    return out


def hook(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Unite the trees of u and v in a forest of labels, each tree labelled by its smallest node."""
    while len(u):
        a, b = label[u], label[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


class Side:
    """A packed block: ids, how many rows each vector stands for, codes, scales and error norms; vectors are read when asked for."""

    def __init__(self, row: dict):
        self.ids, self.rows = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["rows"], np.int64)
        self.codes = np.frombuffer(row["codes"], np.int8).reshape(len(self.ids), -1)
        self.scale, self.error = np.frombuffer(row["scale"], np.float64), np.frombuffer(row["error"], np.float64)
        self.path, self.kind, self.held = row["path"], np.dtype(row["kind"]), None

    def unit(self, which: np.ndarray) -> np.ndarray:
        """Unit vectors of some rows in double precision: a few are read by place, many with their block."""
        need, back = np.unique(which, return_inverse=True)
        if self.held is None:
            store, name = file_system(self.path)
            wide = self.codes.shape[1] * self.kind.itemsize
            with store.open_input_file(name) as f:
                if len(need) <= FEW:
                    raw = b"".join(f.read_at(wide, int(k) * wide) for k in need)
                    return _unit(np.frombuffer(raw, self.kind).reshape(len(need), -1))[back]
                self.held = np.frombuffer(f.read(), self.kind).reshape(len(self.ids), -1)
        return _unit(self.held[need])[back]


def packed(ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, folder: str) -> dict:
    """What a Side is made of; the vectors themselves go to a file."""
    path = f"{folder}/{uuid.uuid4().hex}.raw"
    put_once(path, [vectors.tobytes()])
    _, codes, scale, error = quantised(vectors)
    raw = {"ids": ids.astype(np.int64), "rows": rows.astype(np.int64), "codes": codes, "scale": scale, "error": error}
    return {"kind": vectors.dtype.str, "path": path} | {k: v.tobytes() for k, v in raw.items()}


def tile(a: Side, b: Side | None, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, links, root id) of the tile's linked vectors; b None: a with itself.

    |cos - sx sy qx.qy| <= ex + (1 + ex) ey for error norms ex and ey, so a pair whose int8 estimate is
    further below `least` cannot link, one further above must, and only those between are recomputed in double precision."""
    same, b = b is None, a if b is None else b
    n, m = len(a.ids), len(b.ids)
    links = np.zeros(n + (0 if same else m), np.int64)
    label = np.arange(len(links))
    shift = 0 if same else n
    for at in range(0, n, STRIP):
        rows = slice(at, min(at + STRIP, n))
        product = _product(a.codes[rows], b.codes)
        # a bound per row lets most pairs go in one comparison
        low = (least - a.error[rows] - (1 + a.error[rows]) * b.error.max() - SLACK) / (a.scale[rows] * b.scale.max())
        i, j = np.nonzero(product >= np.where(low > 0, low, -np.inf)[:, None].astype(product.dtype) * np.float32(1 - 1e-6))
        value, i = product[i, j].astype(np.float64), i + at
        if same:
            up = i < j
            i, j, value = i[up], j[up], value[up]
        value *= a.scale[i] * b.scale[j]
        bound = a.error[i] + (1 + a.error[i]) * b.error[j] + SLACK
        linked = value - bound >= least
        doubt = np.flatnonzero(~linked & (value + bound >= least))
        step = max(1, TERMS // a.codes.shape[1])
        for part in (doubt[k : k + step] for k in range(0, len(doubt), step)):
            linked[part] = np.einsum("ij,ij->i", a.unit(i[part]), b.unit(j[part])) >= least
        i, j = i[linked], j[linked]
        links += np.bincount(i, weights=b.rows[j], minlength=len(links)).astype(np.int64)
        links += np.bincount(j + shift, weights=a.rows[i], minlength=len(links)).astype(np.int64)
        hook(label, i, j + shift)
    ids = a.ids if same else np.concatenate([a.ids, b.ids])
    root = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(root, label, ids)
    at = np.flatnonzero(links)
    return ids[at], links[at], root[label[at]]


def near_duplicates(vectors: DataFrame, least: float = 0.9, key: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept.

    Vectors link when their cosine is at least `least` (over 0). Equal vectors are one node with a row count before any
    product, so a group of copies costs nothing; a group of near copies leaves a tile as counts and one tree, never
    as pairs. Tiles get int8 codes, scales and error norms; vectors stay in files of their blocks, from which a tile reads those
    of its doubtful pairs. Null, zero and odd (null, NaN or infinite components) vectors link with nothing and stay; vectors
    of other lengths are compared among themselves. Each row that repeats a key has its own vector's links, and all
    are in one component; a null key links with nothing and is not kept. Other columns are dropped. An empty table gives an empty
    result. Tiles grow with the square of the distinct vectors: that is the method's cost."""
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = F.col("key").isNotNull() & F.col("vector").isNotNull() & ~odd & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    # a vector's 128-bit name, so that only names meet its rows again
    named = rows.where("sound").select("key", F.xxhash64("vector").alias("d0"), F.xxhash64(F.lit("vector"), "vector").alias("d1"), "vector")
    distinct = named.groupBy("d0", "d1", "vector").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("rows"))
    distinct = written(distinct.withColumns({"size": F.size("vector"), "rep": F.monotonically_increasing_id()}), "distinct")
    kind = "<f4" if "float" in rows.schema["vector"].dataType.simpleString() else "<f8"
    counts = {r["size"]: r["n"] for r in distinct.groupBy("size").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
    if not counts:
        return rows.select(F.col("key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"), F.col("key").isNotNull().alias("kept"))
    many = F.create_map(*[F.lit(int(x)) for s, n in counts.items() for x in (s, -(-n // block))])
    folder = f"{shared_dir(vectors.sparkSession)}/vectors"

    def pack(group: pa.Table) -> pa.Table:
        flat = group["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind)
        one = packed(group["rep"].to_numpy(), group["rows"].to_numpy(), flat.reshape(group.num_rows, -1), folder)
        return pa.Table.from_pylist([one | {n: group[n][0].as_py() for n in whole}], schema)

    whole, text, raw = ["size", "block", "blocks"], ["kind", "path"], ["ids", "rows", "codes", "scale", "error"]
    schema = pa.schema([(n, pa.int32()) for n in whole] + [(n, pa.string()) for n in text] + [(n, pa.binary()) for n in raw])
    blocks = distinct.withColumn("blocks", F.element_at(many, F.col("size")))
    blocks = blocks.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    spec = ", ".join([f"{n} int" for n in whole] + [f"{n} string" for n in text] + [f"{n} binary" for n in raw])
    sides = written(blocks.groupBy("size", "block").applyInArrow(pack, spec), "blocks")

    # each unordered pair of blocks once, dealt evenly: a block is the first of the tiles with the next half of the ring
    ring = F.expr("filter(sequence(0, blocks div 2), d -> not (2 * d = blocks and block >= d))")
    first = sides.withColumn("d", F.explode(ring)).selectExpr("size", "block as i", "(block + d) % blocks as j", "block", *text, *raw)
    ring = F.expr("filter(sequence(1, greatest(1, blocks div 2)), d -> blocks > 1 and not (2 * d = blocks and (block - d + blocks) % blocks >= d))")
    second = sides.withColumn("d", F.explode(ring)).selectExpr("size", "(block - d + blocks) % blocks as i", "block as j", "block", *text, *raw)

    def multiply(group: pa.Table) -> pa.Table:
        two = {r["block"]: Side(r) for r in group.to_pylist()}
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        if i in two and j in two:
            found = tile(two[i], None if i == j else two[j], least)
        else:  # the other block got no vector
            found = (np.zeros(0, np.int64),) * 3
        return pa.table(dict(zip(("rep", "links", "root"), map(pa.array, found), strict=True)))

    spec = "rep long, links long, root long"
    found = written(first.unionByName(second).groupBy("size", "i", "j").applyInArrow(multiply, spec), "links")
    dropped(sides)
    totals = found.groupBy("rep").agg(F.sum("links").alias("links"))
    nodes = named.select("key", "d0", "d1").join(distinct.select("d0", "d1", "rep", "rows", "least"), ["d0", "d1"])
    # rows that repeat a key with other vectors are in one component
    again = nodes.groupBy("key").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("key", "a")
    again = nodes.select("key", F.col("rep").alias("b")).join(again, "key").where("a < b").select("a", "b")
    edges = found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(again)
    parts = components(edges).withColumnRenamed("node", "rep")
    classes = distinct.select("d0", "d1", "rep", "rows", "least").join(totals, "rep", "left").join(parts, "rep", "left")
    classes = written(classes.withColumn("component", F.coalesce("component", "rep")).drop("rep"), "classes")
    lead = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = classes.join(lead, "component").select("d0", "d1", (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links"), "component_id")
    out = named.select("key", "d0", "d1").join(classes, ["d0", "d1"]).select("key", "n_links", "component_id")
    rest = rows.where("not sound").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    out = out.unionByName(rest).withColumn("kept", F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)))
    return out.withColumnRenamed("key", key)


def op1_near_duplicates(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return near_duplicates(vectors)
