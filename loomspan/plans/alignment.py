"""Whole flows: from hits to coverage, junctions, quantification and the mapping report.

What several outputs are made of is computed once and kept (session.settled), so each source is read once however many outputs are used."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.operators import coverage, genes, junctions, quantify, reads, reconcile
from loomspan.session import settled


@dataclass
class Settings:
    """What a run may change; paired and distance hold for all steps."""

    paired: bool = True
    distance: int = 500_000
    least_overlap: int | str = "v"
    most_hits: int | None = None
    long_overlap: int = 8
    longest_exon: int = 500


def reconciled(gu: DataFrame, tu: DataFrame, gnu: DataFrame, tnu: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """(unique, ambiguous) alignments of both sources; contradictions are ambiguous, reads with too many hits go."""
    columns = ["seqnum", "mate", "chr", "spans", "strand", "seq"]
    ambiguous = settled(gnu.select(*columns).unionByName(tnu.select(*columns)))
    both = settled(reconcile.genome_and_transcriptome(gu, tu, ambiguous, settings.least_overlap, settings.paired, settings.distance))
    unique = both.where("verdict = 'unique'").select(*columns)
    rest = reads.union_distinct(ambiguous, both.where("verdict <> 'unique'").select(*columns))
    if settings.most_hits:
        rest = reads.limited(rest, settings.most_hits)
    return unique, rest


def fragments(unique: DataFrame, ambiguous: DataFrame) -> DataFrame:
    """(seqnum, mate, chr, spans, strand, is_unique): each row's blocks, for junctions and counts."""
    columns = ["seqnum", "mate", "chr", "spans", "strand"]
    return unique.select(*columns, F.lit(True).alias("is_unique")).unionByName(ambiguous.select(*columns, F.lit(False).alias("is_unique")))


def report(unique: DataFrame, ambiguous: DataFrame, coverages: tuple[DataFrame, DataFrame], genome_size: DataFrame, total: int | None = None) -> DataFrame:
    """One row: reads by how their mates map, covered bases of both kinds and their share of the genome, rows per chromosome, and how many reads
    have how many ambiguous hits.

    genome_size: one row (genome_size). unique_chromosomes, ambiguous_chromosomes and multiplicity are arrays of (name, n), in order, no longer
    than the genome has sequences, or reads have different numbers of hits."""
    out = reads.mapping_statistics(unique, ambiguous, total)
    for tag, cover in zip(("unique", "ambiguous"), coverages, strict=True):
        share = coverage.footprint_share(cover, genome_size).select(F.col("footprint").alias(f"{tag}_footprint"), F.col("percent").alias(f"{tag}_percent"))
        out = out.crossJoin(F.broadcast(share))  # one row each
    listed = lambda df, name, by, n: df.agg(F.array_sort(F.collect_list(F.struct(F.col(by).alias("name"), F.col(n).alias("n")))).alias(name))
    parts = [listed(rows.groupBy("chr").agg(F.count(F.lit(1)).alias("n")), f"{tag}_chromosomes", "chr", "n") for tag, rows in (("unique", unique), ("ambiguous", ambiguous))]
    for part in [*parts, listed(reads.multiplicity_histogram(ambiguous), "multiplicity", "num_locs", "num_reads")]:
        out = out.crossJoin(F.broadcast(part))
    return out


def outputs(unique: DataFrame, ambiguous: DataFrame, models: DataFrame, chunks: DataFrame, settings: Settings | None = None) -> dict[str, DataFrame]:
    """Coverage of both kinds, junctions, inferred exons and their counts, feature counts with RPKM, statistics, histogram, the report.

    chunks: the genome in pieces (chr, chunk, size, seq), as readers.chunked makes them."""
    settings = settings or Settings()
    unique, ambiguous = settled(unique), settled(ambiguous)
    rows = fragments(unique, ambiguous)
    found = settled(junctions.called(rows, chunks, genes.introns(models), settings.long_overlap))
    cover, other = settled(coverage.of_spans(unique)), settled(coverage.of_spans(ambiguous))
    exons = settled(junctions.inferred_exons(found, cover, genes.exons(models), settings.longest_exon))
    counts = quantify.feature_counts(rows, quantify.features_of(models))
    return {
        "unique_coverage": cover,
        "ambiguous_coverage": other,
        "junctions": found,
        "inferred_exons": exons,
        "exon_counts": quantify.exon_counts(rows, exons),
        "quantification": quantify.normalised(counts, quantify.read_total(rows)),
        "statistics": reads.mapping_statistics(unique, ambiguous),
        "multiplicity": reads.multiplicity_histogram(ambiguous),
        "chromosome_counts": reads.counts_by(unique),
        "report": report(unique, ambiguous, (cover, other), chunks.agg(F.coalesce(F.sum(F.length("seq")), F.lit(0)).alias("genome_size"))),
    }
