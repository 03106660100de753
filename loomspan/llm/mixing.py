"""Operator 11: mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.llm.store import dropped, written

#: Words in a block; slots looked up or ranked together.
BLOCK, TILE = 256, 1 << 16
#: Points of a schedule at most, as their products must fit 63 bits; larger blocks make fewer.
POINTS = 1 << 41


class Mix(NamedTuple):
    """What mixed() returns.

    documents: one row per document: key, source, size, source_size, target, first (its first word's place in its source's stream).
    schedule: the mix in the order of slot: slot, source, key, first, pass, first_word (within the document), words."""

    documents: DataFrame
    schedule: DataFrame


def words_in(text: str) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text, 0 of a null one."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _numbered(df: DataFrame, value: str, out: str) -> DataFrame:
    """df with the sum of `value` over all rows before, in the order (slice, place); there are as many slices as a shuffle has."""
    totals = df.groupBy("slice").agg(F.sum(value).alias("_total"))
    # as many rows as slices
    before = totals.withColumn("_before", F.coalesce(F.sum("_total").over(Window.partitionBy(F.lit(0)).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inner = Window.partitionBy("slice").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return df.join(before.drop("_total"), "slice").withColumn(out, F.col("_before") + F.coalesce(F.sum(value).over(inner), F.lit(0))).drop("_before")


def _levelled(sources: DataFrame, share: float, most: float) -> DataFrame:
    """sources with target: weights share `share` of all words, no source gets more than `most` times its size.

    A target is the smaller of that cap and level * weight. The level only rises from step to step, as closed sources
    leave their excess to the others, until no more of them close."""
    rows = sources.withColumn("cap", F.col("source_size") * most)
    total, weights = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0)) * share, F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    level, closed = (total / weights if weights else 0.0), 0
    while True:
        shut = F.col("weight") * level > F.col("cap")
        n, full, rest = rows.agg(
            F.count_if(shut), F.coalesce(F.sum(F.when(shut, F.col("cap"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~shut, F.col("weight"))), F.lit(0.0))
        ).first()
        if n == closed:
            break
        closed, level = n, (total - full) / rest if rest else level
    target = F.when(F.col("weight") * level > F.col("cap"), F.col("cap")).otherwise(F.col("weight") * level)
    return rows.withColumn("target", target).drop("cap")


def _lattice(n: int) -> tuple[int, int]:
    """(points, step): the smallest Fibonacci number of at least n points and the one before it, whose ratio is the golden one."""
    before, points = 1, 1
    while points < n:
        before, points = points, before + points
    return points, before


def slots(sources: DataFrame, n: int) -> DataFrame:
    """(slot, no, rank) of a schedule of n slots; sources: (no, until, slots), source `no` owning the places until - slots to until - 1 of n.

    Slot t is the point t * step mod points of a Fibonacci lattice, the golden-ratio sequence on whole numbers: it takes every place once, so each
    source gets exactly its slots, and evenly in time. Places of n and more are skipped. A place's source is the last one that begins
    at or before it, found within tiles of places; slots are ranked within tiles of time whose counts are summed first."""
    points, step = _lattice(n)
    if points > POINTS:
        raise ValueError("too many slots: take a larger block")
    spark, half = sources.sparkSession, 1 << 21
    time = spark.range(0, points, 1, max(spark.sparkContext.defaultParallelism, points >> 20)).withColumnRenamed("id", "slot")
    place = (F.col("slot") * (step // half) % points * half + F.col("slot") * (step % half)) % points
    time = time.withColumn("place", place).where(F.col("place") < n).withColumn("tile", F.expr(f"place div {TILE}"))
    owned = sources.where("slots > 0").selectExpr("no", "until - slots as begin", "until - 1 as end")
    marks = owned.withColumn("tile", F.explode(F.expr(f"sequence(begin div {TILE}, end div {TILE})")))
    marks = marks.select("tile", F.greatest("begin", F.col("tile") * TILE).alias("place"), F.lit(None).cast("long").alias("slot"), "no")
    both = marks.unionByName(time.withColumn("no", F.lit(None).cast("long")))
    at = Window.partitionBy("tile").orderBy("place", F.col("slot").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("no", F.last("no", ignorenulls=True).over(at)).where("slot is not null").select("slot", "no", F.expr(f"slot div {TILE}").alias("era"))
    eras = found.groupBy("no", "era").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("no").orderBy("era").rowsBetween(Window.unboundedPreceding, -1)
    eras = eras.select("no", "era", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = found.withColumn("row", F.row_number().over(Window.partitionBy("no", "era").orderBy("slot"))).join(eras, ["no", "era"])
    return ranked.select("slot", "no", (F.col("before") + F.col("row") - 1).alias("rank"))


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    block: int = BLOCK,
    seed: int = 11,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> Mix:
    """The mix of all sources: of `share` times all words, dealt by weights in turn over the sources in code-point order, null last.

    A source's documents, shuffled by sha256("seed:key"), are one stream of words, read as often as its target asks
    (a second pass has the same order, so repeats are a pass apart) and cut into blocks of `block` words; its last block may be shorter. The
    r-th slot that the schedule gives a source takes its r-th block. A source takes the whole words of its target. Null and empty texts have size 0
    and are never taken; a null key is shuffled as the word null; rows that repeat a key are documents of their own; equal rows lie next to each
    other. Clashing names don't matter, other columns are dropped. An empty table gives an empty mix.

    A source may hold most rows: streams are laid out by slices of the shuffled order, and no task gets a whole source. Rows of
    one key lie in one slice."""
    spark = docs.sparkSession
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = 1 << max(8, (few - 1).bit_length())
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null"))), 256), 1, 15), 16, 10).cast("long")
    rows = docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), F.col(source).isNull().alias("no_source"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("name"),
        words_in(text).alias("size"), h.alias("h"), F.xxhash64(text).alias("mark"),
    )
    rows = written(rows.withColumn("slice", F.expr(f"int(h div {(1 << 60) // parts})")), "sizes")
    pieces = rows.groupBy("no_source", "name", "slice").agg(F.sum("size").alias("words"))
    names = pieces.groupBy("no_source", "name").agg(F.sum("words").alias("source_size"))
    names = names.repartitionByRange(few, "no_source", "name").select(F.spark_partition_id().alias("slice"), F.struct("no_source", "name").alias("place"), "source_size", F.lit(1).cast("long").alias("one"))
    order = written(names, "names")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = _numbered(order, "one", "no").withColumn("weight", F.get(cycle, F.col("no") % len(weights)))
    levels = written(_levelled(ranked, share, most).withColumn("take", F.floor("target")), "targets")
    dropped(order)
    sources = _numbered(levels.withColumn("slots", F.ceil(F.col("take") / block)), "slots", "begin")
    sources = sources.select("no", "place.no_source", "place.name", "source_size", "target", "take", "slots", (F.col("begin") + F.col("slots")).alias("until"))
    sources = written(sources, "sources")
    dropped(levels)
    n = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]

    # a document's place in its source's stream: words of the slices before, then of the documents before in its slice
    before = Window.partitionBy("no_source", "name").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = pieces.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    firsts = firsts.join(sources, ["no_source", "name"])
    inner = Window.partitionBy("no_source", "name", "slice").orderBy("h", "mark", "size").rowsBetween(Window.unboundedPreceding, -1)
    laid = rows.withColumn("within", F.coalesce(F.sum("size").over(inner), F.lit(0))).join(firsts, ["no_source", "name", "slice"])
    laid = written(laid.select("key", "source", "size", "source_size", "target", (F.col("before") + F.col("within")).alias("first"), "no", "take"), "laid")
    dropped(rows)

    # the blocks that a document's words fall into, in each pass over its source
    read = laid.where("size > 0 and first < take").withColumn("pass", F.explode(F.expr("sequence(0, (take - 1 - first) div source_size)")))
    read = read.withColumn("at", F.col("pass") * F.col("source_size") + F.col("first")).withColumn("end", F.least(F.col("at") + F.col("size"), "take"))
    read = read.withColumn("rank", F.explode(F.expr(f"sequence(at div {block}, (end - 1) div {block})")))
    begin = F.greatest("at", F.col("rank") * block)
    cut = read.select("no", "rank", "source", "key", "first", "pass", (begin - F.col("at")).alias("first_word"), (F.least("end", (F.col("rank") + 1) * block) - begin).alias("words"))
    schedule = cut.join(slots(sources, n), ["no", "rank"]).select("slot", F.col("source").alias(source), F.col("key").alias(key), "no", "first", "pass", "first_word", "words")
    documents = laid.select(F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", "no", "first")
    return Mix(documents, schedule)


def op11_mixture(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    mix = mixed(docs)
    taken = mix.schedule.groupBy("no", "first").agg(F.sum("words").alias("taken")).withColumn("some", F.lit(True))
    out = mix.documents.withColumn("some", F.col("size") > 0).join(taken, ["no", "first", "some"], "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


SQL = r"""
WITH d AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
        ('0x' || substr(sha256('11:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15))::BIGINT AS h
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM d GROUP BY source
), w AS (
    SELECT *, CAST([3, 1, 2][no % 3 + 1] AS DOUBLE) AS weight, source_size * 2.0::DOUBLE AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM s
), steps AS (  -- sources close in the order of cap / weight; the level after each of them
    SELECT *, (total - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM w WINDOW before AS (ORDER BY cap / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), best AS (
    SELECT arg_min(level, (cap / weight, no)) FILTER (level * weight <= cap) AS level FROM steps
), t AS (
    SELECT source, source_size, CASE WHEN weight * best.level > cap THEN cap ELSE weight * best.level END AS target FROM w, best
), laid AS (
    SELECT d.doc_id, d.size, t.source_size, t.target,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    CAST(greatest(0, least(size, floor(target) - first)) + greatest(0, least(size, floor(target) - source_size - first)) AS BIGINT) AS taken
FROM laid
"""
