"""Writers of the text formats: each makes one text column and lets Spark write it, partition by partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.functions import spans as S


def _lines(df: DataFrame, *columns) -> DataFrame:
    return df.select(F.concat_ws("\t", *[c if not isinstance(c, str) else F.col(c).cast("string") for c in columns]).alias("value"))


def alignment_lines(df: DataFrame, strand_last: bool = False) -> DataFrame:
    name = F.concat(F.lit("seq."), F.col("seqnum"), F.col("mate"))
    return _lines(df, name, "chr", S.render(F.col("spans")), *(("seq", "strand") if strand_last else ("strand", "seq")))


def sam_lines(df: DataFrame) -> DataFrame:
    names = ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")
    return df.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in names], "tags").alias("value"))


def bedgraph_lines(df: DataFrame) -> DataFrame:
    return _lines(df, "chr", "start", "end", "cov")


def bed_lines(df: DataFrame) -> DataFrame:
    """BED12 of junctions.to_bed."""
    return _lines(
        df, "chr", "start0", "end", "name", "score", "strand", "thick_start", "thick_end", "rgb", "block_count", "block_sizes", "block_starts"
    )


def exon_track_lines(df: DataFrame) -> DataFrame:
    """BED9 of junctions.exon_track."""
    return _lines(df, "chr", "start0", "end", "name", "score", "strand", "thick_start", "thick_end", "rgb")


def span_bed_lines(df: DataFrame, zero_based: bool = False, seqnum: bool = False) -> DataFrame:
    """A line per span; zero_based takes one off each start."""
    rows = df.select("chr", "seqnum", "strand", F.explode("spans").alias("s"))
    start = F.col("s.start") - (1 if zero_based else 0)
    name = F.concat(F.lit("seq."), F.col("seqnum")) if seqnum else F.lit(".")
    return _lines(rows, "chr", start.cast("string"), F.col("s.end").cast("string"), name, F.lit("0"), "strand")


def quant_lines(df: DataFrame) -> DataFrame:
    place = F.concat(F.col("chr"), F.lit(":"), F.col("start"), F.lit("-"), F.col("end"))
    size = (F.col("end") - F.col("start") + 1).cast("string")
    return _lines(df, "feature_type", place, "ucount", "nucount", size, "strand", "id")


def junction_lines(df: DataFrame) -> DataFrame:
    place = F.concat(F.col("chr"), F.lit(":"), F.col("start"), F.lit("-"), F.col("end"))
    names = (
        "strand score known standard_splice_signal signal_not_canonical ambiguous long_overlap_unique_reads short_overlap_unique_reads "
        "long_overlap_nu_reads short_overlap_nu_reads"
    ).split()
    return _lines(df, place, *names)


def fasta_lines(df: DataFrame) -> DataFrame:
    name = F.concat(F.lit(">seq."), F.col("seqnum"), F.col("mate"))
    return df.select(F.concat_ws("\n", name, "seq").alias("value"))


def write(lines: DataFrame, path: str, header: str | None = None, order=(), compress: bool = False) -> None:
    """Text files in a folder, in the lines' order by `order`; a header is the first line of the first file."""
    rows = lines.sortWithinPartitions(*order) if order else lines
    if header is not None:
        one = lambda batches: _headed(batches, header)
        rows = rows.mapInArrow(one, "value string")
    rows.write.text(path, compression="gzip" if compress else "none")


def _headed(batches, header: str):
    import pyarrow as pa
    from pyspark import TaskContext

    first = next(batches, None)
    schema = pa.schema([("value", pa.string())]) if first is None else first.schema
    if TaskContext.get().partitionId() == 0:
        yield pa.RecordBatch.from_arrays([pa.array([header], schema.field(0).type)], schema=schema)
    if first is not None:
        yield first
        yield from batches


def by_chromosome(df: DataFrame, path: str) -> None:
    """One folder per chromosome, so that a region reads its own only."""
    df.write.partitionBy("chr").parquet(path)
