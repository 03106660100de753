"""Coverage as a sweep over starts and ends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.operators.breakpoints import overlap_sums, overlapping


def sweep(df: DataFrame, on: Sequence[str], start: str = "start", end: str = "end", weight: Column | None = None, tile: int = 1 << 16) -> DataFrame:
    """(on, start, end, cov): the sum of weights over each half-open stretch where it isn't 0; input is half-open too.

    Starts add and ends take off, summed per place with map-side combining. A key's places are swept in tiles: the
    tiles' sums give each tile what lies open before it and where the next change is, as two rows beside its own, so one
    chromosome that holds most rows is no single task, and a task holds its rows once, in one sort."""
    w = F.lit(1) if weight is None else weight
    ends = F.explode(F.array(F.struct(F.col(start).alias("pos"), w.alias("d")), F.struct(F.col(end).alias("pos"), (-w).alias("d"))))
    changes = df.select(*on, ends.alias("x")).select(*on, "x.pos", "x.d").groupBy(*on, "pos").agg(F.sum("d").alias("d")).where("d <> 0")
    changes = changes.withColumn("_tile", F.floor(F.col("pos") / tile))
    tiles = changes.groupBy(*on, "_tile").agg(F.sum("d").alias("_d"), F.min("pos").alias("_first"))
    order = Window.partitionBy(*on).orderBy("_tile")
    tiles = tiles.select(
        *on,
        "_tile",
        F.coalesce(F.sum("_d").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_open"),
        F.lead("_first").over(order).alias("_next"),
    )
    kind = {f.name: f.dataType for f in changes.schema}
    carry = lambda pos, d: F.struct(pos.cast(kind["pos"]).alias("pos"), d.cast(kind["d"]).alias("d"))
    both = F.array(carry(F.lit(None), F.col("_open")), carry(F.col("_next"), F.lit(0)))
    carried = tiles.select(*on, "_tile", F.explode(F.filter(both, lambda x: (x["d"] != 0) | x["pos"].isNotNull())).alias("x")).select(*on, "x.pos", "x.d", "_tile")
    own = Window.partitionBy(*on, "_tile").orderBy("pos")  # what lies open comes first, without a place
    out = changes.unionByName(carried).select(
        *on, F.col("pos").alias("start"), F.lead("pos").over(own).alias("end"), F.sum("d").over(own.rowsBetween(Window.unboundedPreceding, 0)).alias("cov")
    )
    return out.where("cov <> 0 and start is not null and end is not null")


def of_spans(alignments: DataFrame, chromosome: str = "chr", spans: str = "spans") -> DataFrame:
    """Coverage of alignments with 1-based closed spans as half-open runs (bedGraph's convention)."""
    blocks = alignments.select(chromosome, F.explode(spans).alias("s")).select(chromosome, (F.col("s.start") - 1).alias("start"), F.col("s.end").alias("end"))
    return sweep(blocks, [chromosome])


def merged(coverages: Sequence[DataFrame], on: Sequence[str] = ("chr",)) -> DataFrame:
    """The sum of coverage tables (on, start, end, cov); neighbouring runs of equal coverage are one."""
    every = coverages[0]
    for other in coverages[1:]:
        every = every.unionByName(other)
    return sweep(every, on, weight=F.col("cov"))


def footprint(coverage: DataFrame) -> DataFrame:
    """One row, footprint: covered bases."""
    return coverage.where("cov > 0").agg(F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0)).cast("long").alias("footprint"))


def normalized(coverage: DataFrame, per: float = 1e9, per_base: bool = False, closed: bool = False) -> DataFrame:
    """Coverage over (all covered bases times coverage / per), to four digits, truncated.

    The total is one row, so its broadcast is bounded. per_base gives a row per base; closed input has its last base within."""
    width = F.col("end") - F.col("start") + (1 if closed else 0)
    total = coverage.agg((F.sum(width * F.col("cov")) / per).alias("_total"))
    out = coverage.crossJoin(F.broadcast(total)).withColumn("cov", F.floor(F.col("cov") / F.col("_total") * 10000) / 10000).drop("_total")
    if not per_base:
        return out
    base = F.explode(F.sequence(F.col("start"), F.col("end") - (0 if closed else 1)))
    return out.withColumn("_b", base).withColumns({"start": F.col("_b"), "end": F.col("_b") + (0 if closed else 1)}).drop("_b")


def footprint_share(coverage: DataFrame, size: DataFrame) -> DataFrame:
    """One row: footprint, genome_size and the percent of it that is covered, cut to two digits. size: one row (genome_size)."""
    out = footprint(coverage).crossJoin(F.broadcast(size))  # one row each
    return out.withColumn("percent", F.floor(F.col("footprint") / F.col("genome_size") * 10000) / 100)


def validated(coverage: DataFrame, on: Sequence[str] = ("chr",), tile: int = 1 << 20) -> DataFrame:
    """Rows that are empty or overlap the row before: none in a sound table.

    Rows are put in order within tiles; the last row of the tile before, one per tile, tells where the first one's neighbour ends."""
    late = [*on, "_tile"]
    rows = coverage.withColumn("_tile", F.floor(F.col("start") / tile))
    last = rows.groupBy(*late).agg(F.max(F.struct("start", "end")).alias("_x"))
    last = last.select(*late, F.lag("_x.end").over(Window.partitionBy(*on).orderBy("_tile")).alias("_far"))
    near = F.lag("end").over(Window.partitionBy(*late).orderBy("start", "end"))
    out = rows.withColumn("_near", near).join(last, late)
    return out.where((F.col("end") <= F.col("start")) | (F.coalesce("_near", "_far") > F.col("start"))).select(*coverage.columns)


def over_spans(spans: DataFrame, coverage: DataFrame, on: Sequence[str] = ("chr",), cutoff: int = 1) -> DataFrame:
    """(on, start, end, covered_sum, below): of each distinct half-open span, the sum of coverage and the bases below `cutoff`.

    Bases that no run covers count as coverage 0. A span costs two look-ups of running totals, however long it is or how many runs it holds."""
    runs = coverage.select(*on, F.col("start").alias("c_start"), (F.col("end") - 1).alias("c_end"), "cov")
    closed = spans.select(*on, "start", (F.col("end") - 1).alias("_last"))
    sums = {"covered_sum": F.col("cov"), "_at_least": (F.col("cov") >= cutoff).cast("int")}
    out = overlap_sums(closed, runs, on, ("start", "_last"), ("c_start", "c_end"), sums, bases=True)
    size = F.col("_last") + 1 - F.col("start")
    below = size - F.col("_at_least") if cutoff > 0 else F.lit(0).cast("long")
    return out.select(*on, "start", (F.col("_last") + 1).alias("end"), "covered_sum", below.alias("below"))


def over_shared_spans(spans: DataFrame, groups: DataFrame, coverage: DataFrame, link: str, on: str = "chr", cutoff: int = 1, together: int = 1024) -> DataFrame:
    """over_spans where each span (link, start, end) lies on every `on` of groups (link, on): a row per distinct span and `on`.

    Most such rows meet no run, so only those that do are summed. A span gets the sums of `together` of its group's members at most as one
    map and is spread over these where it is put out: rows of spans and runs are shuffled, the product never is."""
    number = F.row_number().over(Window.partitionBy(link).orderBy(on))
    parts = groups.select(link, on).where(F.col(link).isNotNull() & F.col(on).isNotNull()).distinct().withColumn("_part", F.floor((number - 1) / together))
    every = spans.select(link, "start", "end").where("start < end").distinct()
    closed = every.select(link, F.col("start").alias("_s"), (F.col("end") - 1).alias("_e"))
    runs = coverage.join(parts, on).select(link, "_part", on, F.col("start").alias("_a"), (F.col("end") - 1).alias("_b"), "cov")
    shared = F.least("_e", "_b") - F.greatest("_s", "_a") + 1
    met = overlapping(runs, closed, [link], ("_a", "_b"), ("_s", "_e")).groupBy(link, "_part", "_s", "_e", on)
    met = met.agg(F.sum(shared * F.col("cov")).alias("covered_sum"), F.sum(F.when(F.col("cov") >= cutoff, shared).otherwise(0)).alias("_at_least"))
    key = [link, "_part", "start", "end"]
    sums = met.groupBy(link, "_part", F.col("_s").alias("start"), (F.col("_e") + 1).alias("end"))
    sums = sums.agg(F.map_from_entries(F.collect_list(F.struct(on, F.struct("covered_sum", "_at_least")))).alias("_sums"))
    members = parts.groupBy(link, "_part").agg(F.collect_list(on).alias("_members"))
    out = every.join(members.select(link, "_part"), link).join(sums, key, "left").join(members, [link, "_part"])
    out = out.select("start", "end", "_sums", F.explode("_members").alias(on)).withColumn("_x", F.try_element_at("_sums", F.col(on)))
    size = F.col("end") - F.col("start")
    below = size - F.coalesce("_x._at_least", F.lit(0)) if cutoff > 0 else F.lit(0).cast("long")
    return out.select(on, "start", "end", F.coalesce("_x.covered_sum", F.lit(0)).cast("long").alias("covered_sum"), below.cast("long").alias("below"))
