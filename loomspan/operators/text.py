"""Positions of strings, and times of logged steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions.sequence import error_of


def position_quality(rows: DataFrame, qual: str = "qual", offset: int = 33, most: int | None = None) -> DataFrame:
    """(pos, n, mean, error): the mean score of each position of quality strings, and the error probability it stands for.

    Characters outside ASCII are no scores. most: positions looked at."""
    column = F.col(qual) if most is None else F.substring(qual, 1, most)
    each = rows.select(F.posexplode(F.split(column, "")).alias("k", "c")).where(F.length("c") > 0)
    scores = each.select((F.col("k") + 1).alias("pos"), (F.ascii("c") - offset).alias("q")).where(F.col("q") < 128 - offset)
    out = scores.groupBy("pos").agg(F.count(F.lit(1)).alias("n"), F.avg("q").alias("mean"))
    return out.withColumn("error", error_of(F.col("mean")))


def step_times(events: DataFrame, step: Sequence[str], at: str = "ts", order: str = "event_id", kind: str | None = None) -> DataFrame:
    """(step, begun, ended, seconds): every odd event of a step begins it, the next one ends it.

    With kind, a column of START and FINISH, every START that a FINISH follows next is a run; others are none."""
    w = Window.partitionBy(*step).orderBy(at, order)
    rows = events.withColumn("ended", F.lead(at).over(w))
    if kind is None:
        rows = rows.withColumn("_k", F.row_number().over(w)).where(F.col("_k") % 2 == 1)
    else:
        rows = rows.withColumn("_k", F.lead(kind).over(w)).where((F.col(kind) == "START") & (F.col("_k") == "FINISH"))
    rows = rows.where(F.col("ended").isNotNull())
    return rows.select(*step, F.col(at).alias("begun"), "ended", (F.unix_timestamp("ended") - F.unix_timestamp(at)).alias("seconds"))


def step_statistics(times: DataFrame, step: str = "step") -> DataFrame:
    return times.groupBy(step).agg(
        F.count(F.lit(1)).alias("runs"), F.sum("seconds").alias("total"), F.avg("seconds").alias("mean"), F.percentile("seconds", 0.5).alias("median")
    )


def invalid_reads(reads: DataFrame) -> DataFrame:
    """Reads whose quality is of another length, or whose bases are none."""
    return reads.where((F.length("seq") != F.length("qual")) | ~F.col("seq").rlike("^[ACGTN.]*$"))


def filtered_reads(reads: DataFrame) -> DataFrame:
    """Reads that the sequencer marked as filtered: a name with :Y: in its second word."""
    return reads.where(F.col("name").rlike(r"^\S+\s+\d+:Y:"))


def without_mate(reads: DataFrame) -> DataFrame:
    """(seqnum, mates) of reads (seqnum, mate, ...) that haven't exactly one row of each mate: none if both files are of equal length."""
    each = reads.groupBy("seqnum").agg(F.count(F.lit(1)).alias("mates"), F.count_distinct("mate").alias("_d"))
    return each.where("mates <> 2 or _d <> 2").drop("_d")


def length_range(reads: DataFrame) -> DataFrame:
    return reads.agg(F.min(F.length("seq")).alias("shortest"), F.max(F.length("seq")).alias("longest"))
