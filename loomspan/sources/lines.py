"""Numbered lines of text files, and records of several lines, without sorting the files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line, value): line counts from 0 within each file; gzip files work too.

    Spark reads a file in blocks; lines are consecutive within one, so a line's number is its place in its block plus
    the lines of the blocks before, of which there is one row each."""
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), "value", F.monotonically_increasing_id().alias("_id")
    )
    blocks = rows.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_low"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    firsts = blocks.select("file", "_block", "_low", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    placed = rows.join(firsts, ["file", "_block"])
    return placed.select("file", (F.col("_first") + F.col("_id") - F.col("_low")).alias("line"), "value")


def records(lines: DataFrame, period: int, names: dict[int, str], skip: int = 0) -> DataFrame:
    """(file, record, names...): every `period` lines after `skip` are one record, names take some of its lines."""
    at = lines.where(F.col("line") >= skip).select("file", F.floor((F.col("line") - skip) / period).alias("record"), ((F.col("line") - skip) % period).alias("_k"), "value")
    return at.groupBy("file", "record").agg(*[F.max(F.when(F.col("_k") == k, F.col("value"))).alias(n) for k, n in names.items()])


def inferred_layout(spark: SparkSession, path: str) -> tuple[int, int]:
    """(first sequence line, period) of an unknown layout, from the first 20,000 lines."""
    head = [r.value for r in spark.read.text(path).limit(20_000).collect()]
    like = [bool(x) and set(x.upper()) <= set("ACGTN.") for x in head]
    for first in range(10):
        for period in range(1, 11):
            rows = like[first::period]
            if rows and all(rows):
                return first, period
    raise ValueError(f"{path}: no lines that look like sequence at even distances")


def sniffed(spark: SparkSession, path: str) -> str:
    """fastq, fasta or other, from the first 40 lines."""
    head = [r.value for r in spark.read.text(path).limit(40).collect()]
    base = set("ACGTN.acgtn")
    if head and all(x.startswith("@") for x in head[0::4]) and all(set(x) <= base for x in head[1::4]) and all(x.startswith("+") for x in head[2::4]):
        return "fastq"
    if head and all(x.startswith(">") for x in head[0::2]) and all(set(x) <= base for x in head[1::2]):
        return "fasta"
    return "other"
