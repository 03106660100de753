"""Readers of the text formats; coordinates become 1-based and closed here and nowhere else."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomspan.functions import spans as S
from loomspan.sources.lines import inferred_layout, numbered_lines, records


def _clean(seq: Column) -> Column:
    return F.translate(F.upper(F.trim(seq)), ".", "N")


def fastq(spark: SparkSession, forward: str, reverse: str | None = None) -> DataFrame:
    """(seqnum, mate, name, seq, qual) of four-line records, numbered from 1; mates share a number.

    Bases other than ACGTN and the full stop, which counts as N, are an error when read."""
    return _mates(spark, forward, reverse, 4, {0: "name", 1: "seq", 3: "qual"})


def fasta(spark: SparkSession, forward: str, reverse: str | None = None) -> DataFrame:
    """(seqnum, mate, name, seq, qual null) of two-line records."""
    return _mates(spark, forward, reverse, 2, {0: "name", 1: "seq"}).withColumn("qual", F.lit(None).cast("string"))


def any_layout(spark: SparkSession, path: str) -> DataFrame:
    """(seqnum, seq) of a file whose sequence lines come at even distances."""
    first, period = inferred_layout(spark, path)
    rows = records(numbered_lines(spark, path), period, {0: "seq"}, skip=first)
    return rows.select((F.col("record") + 1).alias("seqnum"), _clean(F.col("seq")).alias("seq"))


def _mates(spark: SparkSession, forward: str, reverse: str | None, period: int, names: dict[int, str]) -> DataFrame:
    out = None
    for path, mate in ((forward, "a"), (reverse, "b")):
        if path is None:
            continue
        seq = _clean(F.col("seq"))
        checked = F.when(seq.rlike("^[ACGTN]*$"), seq).otherwise(F.raise_error(F.concat(F.lit("not a sequence: "), F.coalesce("seq", F.lit("")))))
        rows = records(numbered_lines(spark, path), period, names).select(
            (F.col("record") + 1).alias("seqnum"),
            F.lit(mate).alias("mate"),
            F.regexp_replace("name", "^[@>]", "").alias("name"),
            checked.alias("seq"),
            *(["qual"] if "qual" in names.values() else []),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def _table(spark: SparkSession, path: str | list[str], names: list[str], comment: str | None = None) -> DataFrame:
    schema = ", ".join(f"{n} string" for n in names)
    options = {"sep": "\t", "quote": "", "escape": "", "header": "false"} | ({"comment": comment} if comment else {})
    return spark.read.options(**options).schema(schema).csv(path)


def alignments(spark: SparkSession, path: str | list[str], strand_last: bool = False) -> DataFrame:
    """(seqnum, mate, chr, spans, strand, seq) of lines id, chr, spans, strand, seq (or seq, strand)."""
    names = ["id", "chr", "text", "seq", "strand"] if strand_last else ["id", "chr", "text", "strand", "seq"]
    rows = _table(spark, path, names)
    return rows.select(
        F.regexp_extract("id", r"(\d+)[ab]?$", 1).cast("long").alias("seqnum"),
        F.regexp_extract("id", r"([ab]?)$", 1).alias("mate"),
        "chr",
        S.parse(F.col("text")).alias("spans"),
        "strand",
        "seq",
    )


def short_hits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(seqnum, mate, strand, target, start, seq) of ungapped hits: id, strand, target, 0-based place, sequence."""
    rows = _table(spark, path, ["id", "strand", "target", "pos", "seq"])
    number, mate = F.regexp_extract("id", r"(\d+)[ab]?$", 1).cast("long"), F.regexp_extract("id", r"([ab]?)$", 1)
    return rows.select(number.alias("seqnum"), mate.alias("mate"), "strand", "target", (F.col("pos").cast("long") + 1).alias("start"), "seq")


_PSL = (
    "matches mismatches rep_matches n_count q_gap_count q_gap_bases t_gap_count t_gap_bases strand q_name q_size q_start q_end "
    "t_name t_size t_start t_end block_count block_sizes q_starts t_starts"
).split()


def psl(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """PSL rows, counts as long, block columns as arrays; a header is skipped."""
    rows = _table(spark, path, _PSL).where(F.col("matches").rlike(r"^\d+$") & F.col("t_starts").isNotNull())
    numbers = [c for c in _PSL if c not in ("strand", "q_name", "t_name", "block_sizes", "q_starts", "t_starts")]
    lists = {c: F.filter(F.split(c, ","), lambda x: x != "").cast("array<bigint>") for c in ("block_sizes", "q_starts", "t_starts")}
    return rows.withColumns({c: F.col(c).cast("long") for c in numbers} | lists)


def kept_psl(rows: DataFrame, low: DataFrame | None = None, least: int = 0, most_gaps: int = 1, most_blocks: int = 500) -> DataFrame:
    """PSL rows that match enough: aligned bases less mismatches over `least` plus the read's masked bases, at most two under its length.

    low: (q_name, n_masked), see masked_counts; a read masked by more than half may have three blocks at most. Rows with a gap in the read
    are kept only for one short insertion between blocks of eight bases or more, if no gap of the target is shorter than 32 bases or
    lies at the same place."""
    rows = rows.withColumn("n_masked", F.lit(0)) if low is None else rows.join(low, "q_name", "left").na.fill(0, ["n_masked"])
    matched = F.aggregate("block_sizes", F.lit(0).cast("bigint"), lambda n, x: n + x) - F.col("mismatches")
    enough = matched > F.least(least + F.col("n_masked"), F.col("q_size") - 2)
    blocks = F.col("block_count") <= F.when(F.col("n_masked") * 2 > F.col("q_size"), F.least(F.lit(3), F.lit(most_blocks))).otherwise(most_blocks)
    borders = F.sequence(F.lit(0), F.size("block_sizes") - 2)
    at = lambda c, k: F.get(c, k)
    gap = lambda c, k: at(c, k + 1) - at(c, k) - at("block_sizes", k)
    short = F.exists(borders, lambda k: gap("t_starts", k).between(1, 31))
    thin = F.exists(borders, lambda k: (gap("q_starts", k) > 0) & (F.least(at("block_sizes", k), at("block_sizes", k + 1)) < 8))
    inserted = (
        (F.col("mismatches") <= 2) & (F.col("q_end") >= 0.85 * F.col("q_size")) & (F.col("t_gap_count") <= 1) & (F.col("q_gap_bases") <= 3)
        & (F.size("block_sizes") > F.col("q_gap_count") + F.col("t_gap_count")) & ~short & ~thin
    )
    return rows.where(enough & blocks & (F.col("q_gap_count") <= most_gaps) & ((F.col("q_gap_count") == 0) | inserted))


def masked_counts(spark: SparkSession, path: str | list[str], letter: str = "N") -> DataFrame:
    """(q_name, n_masked) of a masked FASTA file, whose sequences may have several lines."""
    bases = sequence_lines(numbered_lines(spark, path))
    count = F.sum(F.length("value") - F.length(F.replace("value", F.lit(letter), F.lit(""))))
    return bases.groupBy(F.regexp_extract("name", r"^(\S*)", 1).alias("q_name")).agg(count.alias("n_masked"))


def sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SAM rows with typed columns and tags array<string>; header lines are skipped."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("@")).select(parts.alias("p"))
    text = dict(zip(("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"), range(11), strict=True))
    whole = {"flag": "int", "pos": "long", "mapq": "int", "pnext": "long", "tlen": "long"}
    return rows.select(*[F.get("p", k).cast(whole.get(c, "string")).alias(c) for c, k in text.items()], F.slice("p", F.lit(12), F.greatest(F.size("p") - 11, F.lit(0))).alias("tags"))


def genes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(chr, strand, exons, id) of chr, strand, start, end, count, starts, ends, name; starts in the file are 0-based."""
    rows = _table(spark, path, ["chr", "strand", "tx_start", "tx_end", "exon_count", "starts", "ends", "id"])
    numbers = lambda c: F.filter(F.split(c, ","), lambda x: x.rlike(r"^\d+$")).cast("array<bigint>")
    exons = S.zipped(F.transform(numbers("starts"), lambda x: x + 1), numbers("ends"))
    return rows.where(F.col("tx_start").rlike(r"^\d+$")).select("chr", "strand", exons.alias("exons"), "id")


def gtf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(chr, strand, exons, id) of a GTF's exon lines, by gene name and transcript; gaps between sorted, distinct exons."""
    rows = _table(spark, path, ["chr", "source", "kind", "start", "end", "score", "strand", "frame", "info"], comment="#").where("kind = 'exon'")
    name = lambda k: F.regexp_extract("info", rf'{k} "([^"]*)"', 1)
    label = F.concat(F.coalesce(F.nullif(name("gene_name"), F.lit("")), name("gene_id")), F.lit("_"), name("transcript_id"))
    rows = rows.withColumn("id", label)
    return rows.groupBy("chr", "strand", "id").agg(F.array_sort(F.collect_set(S.span(F.col("start"), F.col("end")))).alias("exons")).select("chr", "strand", "exons", "id")


def bedgraph(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(chr, start, end, cov), half-open as in the file; track lines are skipped."""
    rows = _table(spark, path, ["chr", "start", "end", "cov"]).where("cov is not null")
    return rows.select("chr", F.col("start").cast("long"), F.col("end").cast("long"), F.col("cov").cast("long"))


def junctions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Junction tables, whose columns are named by their header."""
    rows = spark.read.options(sep="\t", header="true").csv(path)
    place = lambda k: F.regexp_extract("intron", r"^(.*):(\d+)-(\d+)$", k)
    rows = rows.withColumns({"chr": place(1), "start": place(2).cast("long"), "end": place(3).cast("long")})
    counts = [c for c in rows.columns if c not in ("intron", "strand", "chr", "start", "end")]
    return rows.withColumns({c: F.col(c).cast("long") for c in counts}).drop("intron")


def two_columns(spark: SparkSession, path: str | list[str], key: str = "id", value: str = "info") -> DataFrame:
    """(key, value) of tab-separated tables whose first line names the columns: mappings of ids, annotations. Of repeated keys the
    greatest value stays."""
    rows = spark.read.options(sep="\t", quote="", escape="", header="true").schema(f"`{key}` string, `{value}` string").csv(path)
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(value).alias(value))


def genome(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(chr, seq) of a FASTA file with one line per sequence (one_line makes such files)."""
    lines = numbered_lines(spark, path)
    rows = records(lines, 2, {0: "name", 1: "seq"})
    return rows.select(F.regexp_extract("name", r"^>\s*(\S+)", 1).alias("chr"), F.upper("seq").alias("seq"))


def sequence_lines(lines: DataFrame, stretch: int = 1 << 16) -> DataFrame:
    """(file, line, name, head, before, value) of a FASTA file's numbered lines: each line of bases with its sequence's name and header
    line, and the sequence's bases before it.

    Lines fall into stretches of numbers. A stretch's bases and last header, one row each, tell the next ones where they
    begin, and lines are only put in order within their stretch: neither a file nor a sequence is one task."""
    head = F.col("value").startswith(">")
    rows = lines.select("file", "line", F.floor(F.col("line") / stretch).alias("_s"), head.alias("_head"), F.trim("value").alias("value"))
    rows = rows.withColumn("_w", F.when(F.col("_head"), 0).otherwise(F.length("value")))
    order = Window.partitionBy("file").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("file", "_s").agg(F.sum("_w").alias("_all"))
    sums = sums.select("file", "_s", F.coalesce(F.sum("_all").over(order), F.lit(0)).alias("_low"))
    inner = Window.partitionBy("file", "_s").orderBy("line")
    rows = rows.join(sums, ["file", "_s"]).withColumn("_upto", F.col("_low") + F.sum("_w").over(inner) - F.col("_w"))
    title = F.struct(F.col("line").alias("line"), F.col("_upto").alias("upto"), F.expr("substring(value, 2)").alias("name"))
    rows = rows.withColumn("_own", F.max(F.when(F.col("_head"), title)).over(inner))
    last = rows.where("_head").groupBy("file", "_s").agg(F.max(title).alias("_last"))
    opened = sums.select("file", "_s").join(last, ["file", "_s"], "left").select("file", "_s", F.max("_last").over(order).alias("_open"))
    met = rows.where("not _head").join(opened, ["file", "_s"]).withColumn("_t", F.coalesce("_own", "_open")).where("_t is not null")
    before = F.col("_upto") - F.col("_t.upto")
    return met.select("file", "line", F.trim("_t.name").alias("name"), F.col("_t.line").alias("head"), before.alias("before"), "value")


def one_line(lines: DataFrame) -> DataFrame:
    """(name, seq) of numbered lines of a FASTA file with sequences over many lines: a row holds a whole sequence.

    For sequences too long for that, see chunked."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("before", "line", F.upper("value").alias("v")))), lambda x: x["v"])
    return sequence_lines(lines).groupBy("file", "head", "name").agg(F.array_join(parts, "").alias("seq")).select("name", "seq")


def chunked(lines: DataFrame, size: int = 1 << 16, over: int = 64, name: Column | None = None) -> DataFrame:
    """(chr, chunk, size, seq) of numbered lines of a FASTA file: pieces of fixed size that each run `over` bases into the next.

    Each line goes to the chunks that it reaches into, so what a task holds is a chunk and never a chromosome."""
    rows = sequence_lines(lines).withColumn("value", F.upper("value")).where(F.length("value") > 0)
    end = F.col("before") + F.length("value")
    low = F.greatest(F.floor((F.col("before") - over) / size), F.lit(0))
    rows = rows.withColumn("chunk", F.explode(F.sequence(low, F.floor((end - 1) / size))))
    first, last = F.greatest(F.col("before"), F.col("chunk") * size), F.least(end, F.col("chunk") * size + size + over)
    piece = F.substring("value", (first - F.col("before") + 1).cast("int"), (last - first).cast("int"))
    parts = F.array_sort(F.collect_list(F.struct(first.alias("at"), piece.alias("v"))))
    label = F.regexp_extract("name", r"^(\S+)", 1) if name is None else name
    whole = rows.groupBy("file", "head", label.alias("chr"), "chunk").agg(F.array_join(F.transform(parts, lambda x: x["v"]), "").alias("seq"))
    return whole.select("chr", "chunk", F.lit(size).alias("size"), "seq")
