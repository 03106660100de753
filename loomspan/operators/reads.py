"""Operators on alignments by read: multiplicity, ambiguity, mates, set operations, counts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions import fragments as R
from loomspan.functions import spans as S


def excluded(rows: DataFrame, ambiguous: DataFrame, on: Sequence[str] = ("seqnum",)) -> DataFrame:
    """Rows whose id isn't among the ambiguous ones."""
    return rows.join(ambiguous.select(*on).distinct(), list(on), "left_anti")


def limited(rows: DataFrame, n: int, read: str = "seqnum", forward: Column | None = None, reverse: Column | None = None) -> DataFrame:
    """All rows of reads that have at most n forward and at most n reverse rows; a joined row counts as both.

    Counts are made with map-side combining and joined back, so no read is a window of its own."""
    a = F.col("mate").isin("a", "") if forward is None else forward
    b = F.col("mate").isin("b", "") if reverse is None else reverse
    counts = rows.groupBy(read).agg(F.sum(a.cast("int")).alias("_a"), F.sum(b.cast("int")).alias("_b"))
    return rows.join(counts.where((F.col("_a") <= n) & (F.col("_b") <= n)).select(read), read, "left_semi")


def separated(rows: DataFrame, entry: Sequence[str], read: str = "seqnum") -> DataFrame:
    """Distinct entries per read with is_unique: whether the read has one only."""
    distinct = rows.select(read, *entry).distinct()
    return distinct.join(distinct.groupBy(read).agg((F.count(F.lit(1)) == 1).alias("is_unique")), read)


def unmapped(reads: DataFrame, unique: DataFrame, ambiguous: DataFrame, wanted: int = 2, read: str = "seqnum", weight: Column | None = None) -> DataFrame:
    """Reads with no ambiguous and fewer than `wanted` unique hits; weight counts a joined hit twice, say."""
    hits = unique.groupBy(read).agg(F.sum(F.lit(1) if weight is None else weight).alias("_hits"))
    left = excluded(reads, ambiguous, [read]).join(hits, read, "left")
    return left.where(F.coalesce("_hits", F.lit(0)) < wanted).drop("_hits")


def paired(forward: DataFrame, reverse: DataFrame, on: Sequence[str], a: tuple[str, str], b: tuple[str, str], distance: int = 500_000) -> DataFrame:
    """Pairs of a read's mates on one chromosome (`on`), in order and at most `distance` apart, with their gap.

    a and b name (start, end) of the forward and the reverse mate on the plus strand; for the minus strand swap the sides."""
    joined = forward.join(reverse, list(on))
    gap = F.col(b[0]) - F.col(a[1])
    return joined.where((F.col(a[0]) <= F.col(b[0])) & (gap < distance)).withColumn("gap", gap)


def classified(
    hits: DataFrame,
    read: str = "seqnum",
    distance: int = 500_000,
    contained: bool = True,
    repair: bool = False,
    longest: bool = False,
    crowd: int = 1_000_000,
    by_mean: bool = False,
) -> DataFrame:
    """Hits (seqnum, mate a|b, chr, spans, strand, seq) as fragments (seqnum, chr, strand, fwd, rev, joined, is_unique).

    Hits are distinct first; the strand given is the forward one. A read with hits of both mates keeps its consistent pairs: on one
    chromosome and strand, in order and at most `distance` apart; mates that touch or overlap are one alignment, joined, if
    their inner blocks agree (contained, repair: see one_of_mates), else no pair. longest: only a read's pairs of most covered bases
    count. by_mean: the upstream mate's mean coordinate must not exceed the downstream one's, too. A read with hits of one mate keeps all of them. A read with one fragment is unique. Reads of `crowd` possible pairs or
    more aren't paired: their hits are single ones, none of them unique. A read's hits meet in one task, in sorts that spill."""
    hits = hits.where(F.col("mate").isin("a", "b") & F.col(read).isNotNull())
    strand = F.when(F.col("mate") == "b", F.translate("strand", "+-", "-+")).otherwise(F.col("strand"))
    # dealt out by read once: counts and pairs go by read alone, too, so hits are not shuffled again
    hits = _distinct_by(hits.select(read, "mate", "chr", "spans", strand.alias("strand"), "seq"), read)
    each = Window.partitionBy(read)
    of = lambda m: F.count_if(F.col("mate") == m).over(each)
    hits = hits.withColumn("_many", of("a") * of("b")).withColumn("_lone", (F.col("_many") == 0) | (F.col("_many") >= crowd))
    hit = lambda m: F.when(F.col("mate") == m, F.struct("spans", "seq"))
    own = hits.where(F.col("_lone") | (F.col("mate") == "a")).select(read, "chr", "strand", "_many", "_lone", hit("a").alias("fwd"), hit("b").alias("_own"))
    place = [F.col(c).alias(f"_{c}") for c in (read, "chr", "strand")]
    other = hits.where(~F.col("_lone") & (F.col("mate") == "b")).select(*place, F.struct("spans", "seq").alias("_other"))
    # by its bounds an equal chromosome is no key of the join, which would deal all out by it; a read has less than `crowd` pairs to try
    same = [F.col(c).between(F.col(f"_{c}"), F.col(f"_{c}")) for c in ("chr", "strand")]
    rows = own.join(other, [F.col(read) == F.col(f"_{read}"), *same], "left").withColumn("rev", F.coalesce("_own", "_other"))
    plus = F.col("strand") == "+"
    up, down = F.when(plus, F.col("fwd")).otherwise(F.col("rev")), F.when(plus, F.col("rev")).otherwise(F.col("fwd"))
    gap = S.first_start(down["spans"]) - S.last_end(up["spans"])
    apart, close = (gap > 1) & (gap <= distance), (gap <= 1) & (S.first_start(up["spans"]) <= S.first_start(down["spans"]))
    kind = F.when(F.col("_lone"), "lone").when(apart, "apart").when(close, "close")
    if by_mean:
        in_order = S.mean_coordinate(up["spans"]) <= S.mean_coordinate(down["spans"])
        kind = F.when(F.col("_lone") | in_order, kind)
    rows = rows.withColumn("_kind", kind).where("_kind is not null")
    is_close = F.col("_kind") == "close"
    rows = rows.withColumn("joined", one_alignment(F.when(is_close, up), F.when(is_close, down), contained, repair))
    rows = rows.where(~is_close | F.col("joined").isNotNull())
    single = [F.when(~is_close, F.col(c)).alias(c) for c in ("fwd", "rev")]
    rows = _distinct_by(rows.select(read, "chr", "strand", *single, "joined", "_many", "_lone"), read)
    if longest:
        covered = sum((F.coalesce(S.total_length(F.col(f"{c}.spans")), F.lit(0)) for c in ("fwd", "rev", "joined")), F.lit(0))
        rows = rows.withColumn("_n", covered)
        rows = rows.withColumn("_most", F.max("_n").over(each)).where(F.col("_lone") | (F.col("_n") == F.col("_most")))
    unique = (F.count(F.lit(1)).over(each) == 1) & (F.col("_many") < crowd)
    return rows.select(read, "chr", "strand", "fwd", "rev", "joined", unique.alias("is_unique"))


def _distinct_by(rows: DataFrame, read: str) -> DataFrame:
    """Distinct rows in one shuffle and one sort, which what follows by read needs no other for."""
    same = Window.partitionBy(read, *[c for c in rows.columns if c != read]).orderBy(read)
    return rows.repartition(read).withColumn("_first", F.row_number().over(same)).where("_first = 1").drop("_first")


def _alignments(up: pa.Array, down: pa.Array, contained: bool, repair: bool) -> pa.Array:
    out: list[dict | None] = []
    for mates in zip(up.to_pylist(), down.to_pylist(), strict=True):
        found = None
        if mates[0] and mates[1]:
            two = [([(s["start"], s["end"]) for s in x["spans"]], x["seq"] or "") for x in mates]
            found = R.one_of_mates(*two, contained, repair)
        out.append({"spans": [{"start": s, "end": e} for s, e in found[0]], "seq": found[1]} if found else None)
    return pa.array(out, up.type)


def one_alignment(up: Column, down: Column, contained: bool = True, repair: bool = False) -> Column:
    """What touching or overlapping mates (spans, seq) are together; null if that is no alignment, or a mate is null."""

    def run(up: pa.Array, down: pa.Array) -> pa.Array:
        return _alignments(up, down, contained, repair)

    # as nondeterministic, so that a filter on it doesn't compute it twice
    return F.arrow_udf(run, f"spans {S.TYPE}, seq string").asNondeterministic()(up, down)


def fused(close: DataFrame, contained: bool = True, repair: bool = False) -> DataFrame:
    """close's other columns and joined of the touching or overlapping mates (up, down: spans, seq) that are one alignment."""
    out = close.withColumn("joined", one_alignment(F.col("up"), F.col("down"), contained, repair))
    return out.where("joined is not null").drop("up", "down")


def union_distinct(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for other in tables[1:]:
        out = out.unionByName(other)
    return out.distinct()


def counts_by(rows: DataFrame, key: str = "chr", read: str = "seqnum") -> DataFrame:
    """(key, n): fragments, a pair on one key being one."""
    return rows.groupBy(key, read).agg(F.lit(1).alias("_1")).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def merged_counts(tables: Sequence[DataFrame], key: str, n: str = "n") -> DataFrame:
    out = tables[0]
    for other in tables[1:]:
        out = out.unionByName(other)
    return out.groupBy(key).agg(F.sum(n).alias(n))


def multiplicity_histogram(rows: DataFrame, read: str = "seqnum") -> DataFrame:
    """(num_locs, num_reads): reads by how many places they have. With a column mate, a pair's two rows are one place: a read has as
    many as joined rows and rows of its more frequent mate."""
    n = F.count(F.lit(1))
    if "mate" in rows.columns:
        of = lambda m: F.count_if(F.col("mate") == m)
        n = of("") + F.greatest(of("a"), of("b"))
    return rows.groupBy(read).agg(n.alias("num_locs")).groupBy("num_locs").agg(F.count(F.lit(1)).alias("num_reads"))


def numbered(rows: DataFrame, read: str, order: Sequence[str | Column]) -> DataFrame:
    """Rows with ih, the read's rows, and hi, the row's number among them from 1."""
    each = Window.partitionBy(read)
    return rows.withColumns({"ih": F.count(F.lit(1)).over(each), "hi": F.row_number().over(each.orderBy(*order))})


def top_hits(rows: DataFrame, read: str, order: Sequence[str | Column], k: int) -> DataFrame:
    """The first k rows of each read; Spark drops later ones before the shuffle."""
    ranked = rows.withColumn("_k", F.row_number().over(Window.partitionBy(read).orderBy(*order)))
    return ranked.where(F.col("_k") <= k).drop("_k")


def near_best(rows: DataFrame, read: Sequence[str], score: str, within: float, mismatches: str | None = None, more: int = 2) -> DataFrame:
    """Rows whose score is over the read's best less `within`, with at most `more` mismatches over the best row's."""
    agg = [F.max(score).alias("_best")]
    if mismatches:
        agg.append(F.min_by(mismatches, F.struct(-F.col(score), F.col(mismatches))).alias("_mm"))
    out = rows.join(rows.groupBy(*read).agg(*agg), list(read)).where(F.col(score) > F.col("_best") - within)
    if mismatches:
        out = out.where(F.col(mismatches) <= F.col("_mm") + more)
    return out.drop("_best", "_mm")


def read_length(rows: DataFrame) -> DataFrame:
    """One row, read_length: the most bases that an alignment covers."""
    return rows.agg(F.max(S.total_length(F.col("spans"))).alias("read_length"))


def grouped(hits: DataFrame, read: str = "seqnum") -> DataFrame:
    """(read, forward, reverse): each read's hits (chr, spans, strand, seq) by mate."""
    hit = F.struct("chr", "spans", "strand", "seq")
    of = lambda m: F.array_sort(F.collect_list(F.when(F.col("mate") == m, hit)))
    return hits.groupBy(read).agg(of("a").alias("forward"), of("b").alias("reverse"))


def mapping_statistics(unique: DataFrame, ambiguous: DataFrame, total: int | None = None, read: str = "seqnum", together: Sequence[str] = ()) -> DataFrame:
    """One row: reads by how their mates map, uniquely and ambiguously, and shares of `total` (default: the span of ids).

    Rows have mate a, b or "" (joined). together: columns that two mates must have in common to be both, as chr and strand; reads
    whose mates never have are in no class, but mapped. Shares are percents cut to two digits."""

    def flags(rows: DataFrame, tag: str) -> DataFrame:
        has = lambda m: F.max((F.col("mate") == m).cast("int"))
        each = rows.groupBy(read, *together).agg(has("").alias("j"), has("a").alias("a"), has("b").alias("b")).withColumn("p", F.col("a") * F.col("b"))
        if together:
            each = each.groupBy(read).agg(*[F.max(c).alias(c) for c in "jabp"])
        n = lambda c: F.coalesce(F.sum(F.expr(c).cast("long")), F.lit(0)).alias
        return each.agg(
            n("j = 1")(f"{tag}_joined"),
            n("j = 0 and p = 1")(f"{tag}_both"),
            n("j = 0 and a = 1 and b = 0")(f"{tag}_forward_only"),
            n("j = 0 and a = 0 and b = 1")(f"{tag}_reverse_only"),
            *([n("j = 0 and a = 1 and b = 1 and p = 0")(f"{tag}_apart")] if together else []),
        )

    span = unique.select(read).unionByName(ambiguous.select(read)).agg((F.max(read) - F.min(read) + 1).alias("total"))
    span = span if total is None else span.select(F.lit(total).cast("long").alias("total"))
    row = flags(unique, "unique").crossJoin(flags(ambiguous, "ambiguous")).crossJoin(span)  # one row each
    mapped = sum((F.col(f"{t}_{k}") for t in ("unique", "ambiguous") for k in ("joined", "both", "forward_only", "reverse_only", *(["apart"] if together else []))), F.lit(0))
    return row.withColumn("mapped", mapped).withColumn("mapped_percent", F.floor(F.col("mapped") / F.col("total") * 10000) / 100)
