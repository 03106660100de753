"""Building the tables that other steps look things up in: genome, chunks, gene models, exons, introns, gene sequences."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.functions import spans as S
from loomspan.functions.chromosomes import by_location
from loomspan.operators import genes
from loomspan.operators.regions import renamed_header
from loomspan.operators.sam import with_genome
from loomspan.sources import lines, readers


@dataclass
class Index:
    """An organism's tables."""

    lengths: DataFrame
    chunks: DataFrame
    models: DataFrame
    exons: DataFrame
    introns: DataFrame
    gene_sequences: DataFrame
    size: DataFrame


def built(spark: SparkSession, fasta: str, models: DataFrame, size: int = 1 << 16) -> Index:
    """From a FASTA file and gene models (chr, strand, exons, name, type): equal models are one, overlapping exons too."""
    raw = lines.numbered_lines(spark, fasta)
    name = renamed_header(F.col("name"))
    chunks = readers.chunked(raw, size, name=name)
    ends = readers.sequence_lines(raw).groupBy(name.alias("chr")).agg(F.max(F.col("before") + F.length("value")).alias("length"))
    whole = genes.merged(genes.repaired(models), ["chr", "strand", "exons"])
    known = whole.join(ends.select("chr"), "chr", "left_semi")
    parts = genes.exons(known)
    spans = parts.withColumn("spans", F.array(S.span(F.col("start"), F.col("end"))))
    looked = with_genome(spans, chunks, ["chr", "start", "end"]).select("chr", "start", "end", F.col("genome").alias("seq"))
    size_of = ends.agg(F.sum("length").alias("genome_size"))
    return Index(ends, chunks, known, parts, genes.introns(known), genes.sequences(known, looked), size_of)


def ordered_models(models: DataFrame) -> DataFrame:
    """Models by chromosome and place, as files list them."""
    rows = models.withColumns({"start": S.first_start(F.col("exons")), "end": S.last_end(F.col("exons"))})
    return by_location(rows, then=("id",))


def save(index: Index, folder: str) -> None:
    """One Parquet table each; chunks by chromosome."""
    for name in ("lengths", "models", "exons", "introns", "gene_sequences", "size"):
        getattr(index, name).write.mode("overwrite").parquet(f"{folder}/{name}")
    index.chunks.write.mode("overwrite").partitionBy("chr").parquet(f"{folder}/chunks")


def load(spark: SparkSession, folder: str) -> Index:
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    return Index(*(read(n) for n in ("lengths", "chunks", "models", "exons", "introns", "gene_sequences", "size")))
