"""Gapless numbering within hot groups, and connected components, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspan.llm.store import dropped, written


#: Rows of one key beyond which spread() cuts it up, where that is more than a HOT-th of all rows.
CUT, HOT = 512, 4096


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that df has no column of."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in have:
            name = f"_{name}"
        out.append(name)
    return out


def gapless(df: DataFrame, group: list[str], by: list[str], out: str, parts: int | None = None) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in an order that the columns `by` fix.

    A group may hold most rows: each is dealt into `parts` slices (by default 256, or as many as a shuffle has) by a hash of `by`,
    slices are counted (map-side combined; groups x parts rows), their running totals are the slices' first
    numbers, and rows are only sorted within a slice. Rows equal in all of `by` are told apart
    by nothing and get neighbouring numbers. df is read twice and must give the same rows. Columns of any other name are kept."""
    parts = parts or max(256, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    part, n, first, row = fresh(df, "_slice", "_n", "_first", "_row")
    dealt = df.withColumn(part, F.pmod(F.xxhash64(*by), F.lit(parts)).cast("int"))
    sizes = dealt.groupBy(*group, part).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(*group, part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(first))
    inner = Window.partitionBy(*group, part).orderBy(*by)
    placed = dealt.withColumn(row, F.row_number().over(inner)).join(firsts, [*group, part])
    return placed.withColumn(out, F.col(first) + F.col(row) - 1).select(*[c for c in df.columns if c != out], out)


def hot_keys(sizes: DataFrame, key: str, n: str, cut: int = CUT) -> DataFrame:
    """(key, parts) of the keys with more rows than `cut` and than a HOT-th of all, so of fewer than HOT keys; sizes: (key, n)."""
    total = sizes.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    least = max(cut, total // HOT)
    return sizes.where(F.col(n) > least).select(key, F.ceil(F.col(n) / least).alias("parts"))


def spread(rows: DataFrame, table: DataFrame, key: str, by: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """rows joined with a table of one row per key, though a key may hold a third of all rows: those of the hot ones, whose list is
    bounded and so broadcast, are dealt by the column `by`, and the table has each as often."""
    parts, cut = fresh(rows, "_parts", "_cut")
    few = F.broadcast(hot.select(key, F.col("parts").alias(parts)))
    x = rows.join(few, key, "left").withColumn(cut, F.pmod(F.xxhash64(by), F.coalesce(parts, F.lit(1))).cast("long")).drop(parts)
    y = table.join(few, key, "left").withColumn(cut, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(parts, F.lit(1)) - 1))).drop(parts)
    return x.join(y, [key, cut], how).drop(cut)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of undirected edges (a, b): component is the smallest node reachable.

    Alternates large-star and small-star steps (Kiveris et al., 2014) until nothing changes: each is one minimum per
    node, combined map-side, and one equi-join, so a hub with a third of all edges is split as
    any skewed join is. Nodes without an edge are not returned."""
    now, seen, state = written(_down(edges.select("a", "b")), "edges"), None, ()
    while state != seen:
        new = written(_small(_large(now)), "edges")
        seen, state = state, new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        dropped(now)
        now = new
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _down(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "u")
    moved = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.where("m < u").select(F.col("u").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(own).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    moved = edges.join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(own).where("a <> b").distinct()
