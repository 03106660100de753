"""Gene models: merging, ids, exons, introns and sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions import sequence as Q
from loomspan.functions import spans as S


def merged(models: DataFrame, structure: Sequence[str], name: str = "name", kind: str = "type", out: str = "id") -> DataFrame:
    """One row per structure; the names of all models that have it, name(type), in order, joined by four colons."""
    label = F.concat(F.col(name), F.lit("("), F.col(kind), F.lit(")"))
    return models.groupBy(*structure).agg(F.array_join(F.array_sort(F.collect_list(label)), "::::").alias(out))


def unique_ids(models: DataFrame, name: str = "name", kind: str = "type", order: str = "row", out: str = "id") -> DataFrame:
    """models with an id of their own: name[[j]] where a type repeats it, and .type where several types have it."""
    each = models.groupBy(name, kind).agg(F.count(F.lit(1)).alias("_n"))
    kinds = each.groupBy(name).agg(F.count(F.lit(1)).alias("_kinds"))
    rows = models.join(each, [name, kind]).join(kinds, name)
    j = F.row_number().over(Window.partitionBy(name, kind).orderBy(order))
    again = F.when(F.col("_n") > 1, F.concat(F.lit("[["), j.cast("string"), F.lit("]]"))).otherwise("")
    tail = F.when(F.col("_kinds") > 1, F.concat(F.lit("."), F.col(kind))).otherwise("")
    return rows.withColumn(out, F.concat(F.col(name), again, tail)).drop("_n", "_kinds")


def exons(models: DataFrame) -> DataFrame:
    """Distinct exons (chr, start, end)."""
    return models.select("chr", F.explode("exons").alias("s")).select("chr", "s.start", "s.end").distinct()


def introns(models: DataFrame) -> DataFrame:
    """Distinct introns (chr, start, end, strand)."""
    return models.select("chr", "strand", F.explode(S.introns(F.col("exons"))).alias("s")).select("chr", "s.start", "s.end", "strand").distinct()


def repaired(models: DataFrame) -> DataFrame:
    """Models whose exons run into each other as fewer exons: no intron is shorter than a base."""
    return models.withColumn("exons", S.fused(F.col("exons")))


def sequences(models: DataFrame, exon_seqs: DataFrame, strict: bool = False) -> DataFrame:
    """(id, seq): the exons' sequences (chr, start, end, seq) in order, reverse-complemented on the minus strand.

    A model whose exon has no sequence gets null; if strict it is an error when read."""
    parts = models.select("id", "chr", "strand", F.posexplode("exons").alias("k", "s")).select("id", "chr", "strand", "k", "s.start", "s.end")
    found = parts.join(exon_seqs, ["chr", "start", "end"], "left")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "seq"))), lambda x: x["seq"]), "")
    missing = F.raise_error(F.concat(F.lit("no sequence for an exon of "), F.first("id"))) if strict else F.lit(None).cast("string")
    out = found.groupBy("id", "strand").agg(F.when(F.count("seq") == F.count(F.lit(1)), whole).otherwise(missing).alias("seq"))
    return out.select("id", F.when(F.col("strand") == "-", Q.reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("seq"))


def annotated(rows: DataFrame, info: DataFrame, key: str = "id", value: str = "info") -> DataFrame:
    """rows with the info of the first of their synonyms (joined by :::: , with (type) or without) that has one."""
    names = F.posexplode(F.split(F.col(key), "::::"))
    each = rows.select(key).distinct().select(key, names.alias("_k", "_name"))
    each = each.withColumn("_name", F.explode(F.array_distinct(F.array("_name", F.regexp_replace("_name", r"\([^)]*\)$", "")))))
    found = each.join(info.select(F.col(key).alias("_name"), value), "_name")
    first = found.groupBy(key).agg(F.min_by(value, F.struct("_k", F.length("_name") * -1)).alias(value))
    return rows.join(first, key, "left")


def genome_size(genome: DataFrame) -> DataFrame:
    return genome.agg(F.sum(F.length("seq")).alias("genome_size"))
