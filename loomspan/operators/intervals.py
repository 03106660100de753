"""Interval joins by breakpoints, band joins by bins, and runs of touching intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.operators.breakpoints import TILE, overlap_sums, overlapping


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    a: tuple[str, str] = ("start", "end"),
    b: tuple[str, str] = ("f_start", "f_end"),
    tile: int = TILE,
    how: str = "inner",
) -> DataFrame:
    """Rows whose closed intervals share a coordinate and whose `on` columns are equal; no other names may clash.

    Right's intervals are indexed by breakpoints, left's look them up; each pair comes out once. Intervals of any length are copied once per
    `tile` coordinates, and crowded tiles are dealt out. `how` is inner, left_semi or left_anti; these two count and make no pairs."""
    if how != "inner":
        met = overlap_sums(left, right, on, a, b, {"_n": F.lit(1)}).where("_n > 0").drop("_n")
        return left.join(met, [*on, *a], how)
    return overlapping(left, right, on, a, b, tile)


def band_join(left: DataFrame, right: DataFrame, on: Sequence[str], at: str, other: str, low: float, high: float) -> DataFrame:
    """Pairs with equal `on` and at + low < other <= at + high: each left row meets the few bins of its band."""
    width = high - low
    x = left.withColumn("_low", F.floor((F.col(at) + low) / width))
    x = x.withColumn("_bin", F.explode(F.sequence(F.col("_low"), F.floor((F.col(at) + high) / width)))).drop("_low")
    y = right.withColumn("_bin", F.floor(F.col(other) / width))
    near = (F.col(other) > F.col(at) + low) & (F.col(other) <= F.col(at) + high)
    return x.join(y, [*on, "_bin"]).where(near).drop("_bin")


def islands(df: DataFrame, on: Sequence[str], start: str = "start", end: str = "end", gap: int = 0, tile: int = 1 << 20) -> DataFrame:
    """(on, start, end, n): closed intervals of a key that overlap, or lie at most gap + 1 apart for gap > 0, as one.

    Rows are put in order within tiles of a key's coordinates; how far the tiles before reach is one more row per tile, without a start. The
    last row of a run tells all of it, so a task holds its rows once, in one sort. Runs within a tile are final, but for the one that goes on
    from before and the last one: these two per tile meet again, in order of tiles."""
    late = [*on, "_tile"]
    rows = df.select(*on, start, end).where(F.col(start).isNotNull()).withColumn("_tile", F.floor(F.col(start) / tile))
    before = Window.partitionBy(*on).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    reach = rows.groupBy(*late).agg(F.max(end).alias("_far")).select(*late, F.max("_far").over(before).alias(end)).where(F.col(end).isNotNull())
    rows = rows.unionByName(reach.withColumn(start, F.lit(None).cast(df.schema[start].dataType)))
    order = Window.partitionBy(*late).orderBy(start, end)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    far = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.col(start).isNotNull() & (F.col("_far").isNull() | (F.col(start) > F.col("_far") + gap))
    runs = rows.withColumn("_far", far).withColumns({"_new": new, "_k": F.row_number().over(order)})
    runs = runs.withColumns(
        {
            "_run": F.count_if("_new").over(upto),
            "_first": F.last(F.when(F.col("_new"), F.struct(F.col(start).alias("start"), F.col("_k").alias("k"))), ignorenulls=True).over(upto),
            "_ends": F.coalesce(F.lead("_new").over(order), F.lit(True)),
            "_last": F.lead("_k").over(order).isNull(),
        }
    ).withColumn("_end", F.max(F.when(F.col(start).isNotNull(), F.struct("_run", F.col(end).alias("end")))).over(upto)["end"])
    # a run that goes on from before comes after the row of the reach
    n = F.col("_k") - F.coalesce("_first.k", F.lit(2)) + 1
    edge = (F.col("_run") == 0) | F.col("_last")
    runs = runs.where(F.col("_ends") & F.col(start).isNotNull()).select(
        *late, F.col("_first.start").alias(start), F.col("_end").alias(end), n.cast("long").alias("n"), "_run", F.when(~edge, F.col("_tile")).alias("_part")
    )  # a tile's inner runs stay among themselves
    chain_order = Window.partitionBy(*on, "_part").orderBy("_tile", "_run")
    chain = chain_order.rowsBetween(Window.unboundedPreceding, 0)
    runs = runs.withColumns(
        {"_id": F.count(start).over(chain), "_sum": F.sum("n").over(chain), "_ends": F.coalesce(F.lead(F.col(start).isNotNull()).over(chain_order), F.lit(True))}
    )
    begun = F.last(F.when(F.col(start).isNotNull(), F.struct(F.col(start).alias("start"), (F.col("_sum") - F.col("n")).alias("n"))), ignorenulls=True).over(chain)
    runs = runs.withColumns({"_first": begun, "_end": F.max(F.struct("_id", F.col(end).alias("end"))).over(chain)["end"]}).where("_ends")
    return runs.select(*on, F.col("_first.start").alias(start), F.col("_end").alias(end), (F.col("_sum") - F.col("_first.n")).alias("n"))


def _runs(df: DataFrame, on: Sequence[str], start: str, end: str, gap: int, weight: Column) -> DataFrame:
    order = Window.partitionBy(*on).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = (reach.isNull() | (F.col(start) > reach + gap)).cast("int")
    run = df.withColumn("_n", weight).withColumn("_new", fresh).withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    out = run.groupBy(*on, "_run").agg(F.min(start).alias(start), F.max(end).alias(end), F.sum("_n").alias("n"))
    return out.drop("_run")


def contained_removed(df: DataFrame, on: Sequence[str], start: str = "start", end: str = "end", apart: int = 35) -> DataFrame:
    """Intervals less those that hold two others whose gap is `apart` or more."""
    inner = df.select(*on, F.col(start).alias("_s"), F.col(end).alias("_e")).distinct()
    held = overlap_join(df.select(*on, start, end).distinct(), inner, on, (start, end), ("_s", "_e"))
    held = held.where((F.col("_s") >= F.col(start)) & (F.col("_e") <= F.col(end)) & ((F.col("_s") != F.col(start)) | (F.col("_e") != F.col(end))))
    bad = held.groupBy(*on, start, end).agg(F.min("_e").alias("_low"), F.max("_s").alias("_high")).where(F.col("_high") - F.col("_low") >= apart)
    return df.join(bad.select(*on, start, end), [*on, start, end], "left_anti")
