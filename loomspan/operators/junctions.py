"""Junction tables, their merging and BED forms, and inferred exons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.functions import spans as S
from loomspan.functions.splice import signal
from loomspan.operators.coverage import over_spans
from loomspan.operators.intervals import band_join, contained_removed, overlap_join
from loomspan.operators.sam import sized

SUMMED = ("score", "long_overlap_unique_reads", "short_overlap_unique_reads", "long_overlap_nu_reads", "short_overlap_nu_reads")
#: Track colours of junctions in the BED files.
COLORS = {"weak": "255,69,0", "strong": "0,0,128", "known": "16,78,139", "novel": "0,205,102"}


def called(
    alignments: DataFrame, genome: DataFrame, known: DataFrame | None = None, long: int = 8, extra: Sequence[tuple[str, str]] = (),
    strand: str | None = None, shortest: int = 15,
) -> DataFrame:
    """A row per intron of alignments (seqnum, chr, spans, is_unique; strand and seq if there are): support, strand, signal, score.

    Gaps of `shortest` bases or more are introns; rows with an insertion beside one are left out, and with `strand` those of the other
    strand. Support is long where the read has `long` bases or more on either side. The intron's first and last two bases are looked
    up in genome chunks (chr, chunk, size, seq); a known junction keeps its strand. An intron without a signal that can as well lie one base
    further left, or right, is counted where it has one, a canonical one first, then the left; if neither place has a signal, all of them
    are rows, and ambiguous. score: long unique support where there is a signal."""
    if strand:
        alignments = alignments.where(F.col("strand") == strand)
    if "seq" in alignments.columns:
        alignments = alignments.where(~F.coalesce(F.col("seq").contains("+:") | F.col("seq").contains(":+"), F.lit(False)))
    before = lambda i: S.total_length(F.slice("spans", F.lit(1), i + 1))
    gaps = F.transform(
        S.introns(F.col("spans")),
        lambda x, i: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), F.least(before(i), S.total_length(F.col("spans")) - before(i)).alias("least")
        ),
    )
    each = alignments.select("chr", "is_unique", F.explode(gaps).alias("x")).select("chr", "is_unique", "x.start", "x.end", "x.least")
    each = each.where(F.col("end") - F.col("start") + 1 >= shortest)
    u, big = F.col("is_unique"), F.col("least") >= long
    n = lambda c: F.sum(c.cast("long"))
    counts = {
        "long_overlap_unique_reads": u & big,
        "short_overlap_unique_reads": u & ~big,
        "long_overlap_nu_reads": ~u & big,
        "short_overlap_nu_reads": ~u & ~big,
    }
    introns = each.groupBy("chr", "start", "end").agg(*[n(c).alias(k) for k, c in counts.items()])
    # the four bases around either end tell the signals of all three places, and whether a shift changes the read's bases
    rows = with_bases(with_bases(introns, genome, "start", "_x", 4, before=1), genome, "end", "_y", 4, before=2)
    at = lambda c, k, m: F.substring(c, k, m)
    place = lambda k: F.struct(F.lit(k).alias("shift"), signal(at("_x", 2 + k, 2), at("_y", 2 + k, 2), extra).alias("sig"))
    rows = rows.withColumns({"_left": place(-1), "_here": place(0), "_right": place(1)})
    free = {"_left": at("_x", 1, 1) == at("_y", 3, 1), "_right": at("_x", 2, 1) == at("_y", 4, 1)}
    free = {k: F.coalesce(v & (F.length("_x") == 4) & (F.length("_y") == 4), F.lit(False)) for k, v in free.items()}
    good = {k: v & F.col(f"{k}.sig").isNotNull() for k, v in free.items()}
    doubt = lambda k, on: F.struct(F.col(f"{k}.shift").alias("shift"), F.col(f"{k}.sig").alias("sig"), on.cast("int").alias("ambiguous"))
    sure = lambda k: F.array(doubt(k, F.lit(False)))
    left_first = good["_left"] & (~good["_right"] | F.col("_left.sig.canonical") | ~F.col("_right.sig.canonical"))
    every = F.array(doubt("_here", free["_left"] | free["_right"]), *[F.when(free[k], doubt(k, F.lit(True))) for k in ("_left", "_right")])
    places = (
        F.when(F.col("_here.sig").isNotNull(), sure("_here")).when(left_first, sure("_left")).when(good["_right"], sure("_right"))
        .otherwise(F.filter(every, lambda x: x.isNotNull()))
    )
    out = rows.withColumn("p", F.explode(places)).select("chr", *[(F.col(c) + F.col("p.shift")).alias(c) for c in ("start", "end")], "p.sig", "p.ambiguous", *counts)
    out = out.groupBy("chr", "start", "end").agg(F.first("sig", ignorenulls=True).alias("sig"), F.max("ambiguous").alias("ambiguous"), *[F.sum(k).alias(k) for k in counts])
    names = known.select("chr", "start", "end", F.col("strand").alias("_strand")).dropDuplicates(["chr", "start", "end"]) if known is not None else None
    out = out.join(names, ["chr", "start", "end"], "left") if names is not None else out.withColumn("_strand", F.lit(None).cast("string"))
    standard = F.col("sig").isNotNull()
    return out.select(
        "chr",
        "start",
        "end",
        F.coalesce("_strand", F.col("sig.strand"), F.lit(strand or ".")).alias("strand"),
        F.when(standard, F.col("long_overlap_unique_reads")).otherwise(0).cast("long").alias("score"),
        F.col("_strand").isNotNull().cast("int").alias("known"),
        standard.cast("int").alias("standard_splice_signal"),
        F.coalesce(~F.col("sig.canonical"), F.lit(False)).cast("int").alias("signal_not_canonical"),
        F.when(standard, 0).otherwise(F.col("ambiguous")).cast("int").alias("ambiguous"),
        *counts,
    )


def with_bases(rows: DataFrame, genome: DataFrame, at: str, out: str, n: int, before: int = 0) -> DataFrame:
    """rows with the n bases from (at - before), 1-based, looked up in genome chunks (chr, chunk, size, seq).

    A chunk's text runs n - 1 bases or more into the next one (genome_chunks does that), so one equi-join on (chr, chunk) is enough."""
    width = F.col("_size")
    keyed = sized(rows, genome).withColumn("_at", F.col(at) - before - 1).withColumn("chunk", F.floor(F.col("_at") / width))
    own = genome.select("chr", "chunk", F.col("seq").alias("_seq"))
    found = keyed.join(own, ["chr", "chunk"], "left")
    text = F.substring("_seq", (F.col("_at") - F.col("chunk") * width + 1).cast("int"), F.lit(n))
    return found.withColumn(out, F.when(F.col("_at") >= 0, text)).drop("_seq", "_at", "chunk", "_size")


def genome_chunks(genome: DataFrame, size: int = 1 << 16, over: int = 64) -> DataFrame:
    """(chr, chunk, size, seq) of (chr, seq): fixed-size pieces that each run `over` bases into the next."""
    k = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.length("seq") / size) - 1, F.lit(0))))
    cut = genome.withColumn("chunk", k)
    return cut.select("chr", "chunk", F.lit(size).alias("size"), F.substring("seq", (F.col("chunk") * size + 1).cast("int"), F.lit(size + over)).alias("seq"))


def merged(tables: Sequence[DataFrame], key: Sequence[str] = ("chr", "start", "end")) -> DataFrame:
    """Junction tables as one: support and score added, flags of doubt by their minimum, of trust by their maximum."""
    every = tables[0]
    for other in tables[1:]:
        every = every.unionByName(other)
    return every.groupBy(*key).agg(
        F.min("strand").alias("strand"),
        *[F.sum(c).alias(c) for c in SUMMED],
        *[F.min(c).alias(c) for c in ("ambiguous", "signal_not_canonical")],
        *[F.max(c).alias(c) for c in ("known", "standard_splice_signal")],
    )


def to_bed(junctions: DataFrame, high_quality: bool = False, flank: int = 50, lengths: DataFrame | None = None) -> DataFrame:
    """BED12 rows: the intron between two blocks of `flank` bases, less what would lie before the chromosome's first base or, with
    lengths (chr, length), behind its last but one.

    All junctions score their total support, and are navy with a score and red without; high-quality ones are those with a
    score, coloured by whether they are known."""
    if high_quality:
        junctions = junctions.where("score > 0")
        score, color = F.col("score"), F.when(F.col("known") == 1, COLORS["known"]).otherwise(COLORS["novel"])
    else:
        support = sum((F.col(c) for c in SUMMED[1:]), F.lit(0))
        score = F.when(F.col("score") > 0, F.col("score")).otherwise(support)
        color = F.when(F.col("score") > 0, COLORS["strong"]).otherwise(COLORS["weak"])
    low, high = F.greatest(F.col("start") - 1 - flank, F.lit(0)), F.col("end") + flank
    if lengths is not None:
        junctions = junctions.join(lengths.select("chr", F.col("length").alias("_length")), "chr", "left")
        high = F.least(high, F.col("_length") - 1)
    return junctions.select(
        "chr",
        low.alias("start0"),
        high.alias("end"),
        score.alias("name"),
        score.alias("score"),
        "strand",
        low.alias("thick_start"),
        high.alias("thick_end"),
        color.alias("rgb"),
        F.lit(2).alias("block_count"),
        F.concat_ws(",", F.col("start") - 1 - low, high - F.col("end")).alias("block_sizes"),
        F.concat(F.lit("0,"), (F.col("end") - low).cast("string")).alias("block_starts"),
    )


def exon_track(exons: DataFrame) -> DataFrame:
    """BED9 rows of exons (chr, start, end, is_known), coloured by whether they are known."""
    return exons.select(
        "chr", (F.col("start") - 1).alias("start0"), "end", F.lit(".").alias("name"), F.lit(0).alias("score"), F.lit(".").alias("strand"),
        (F.col("start") - 1).alias("thick_start"), F.col("end").alias("thick_end"), F.when(F.col("is_known"), COLORS["known"]).otherwise(COLORS["novel"]).alias("rgb"),
    )


def novel_models(exons: DataFrame) -> DataFrame:
    """Gene models (chr, strand, exons, id) of one exon each, of the exons that aren't known."""
    place = F.concat(F.col("chr"), F.lit(":"), F.col("start"), F.lit("-"), F.col("end"))
    return exons.where(~F.col("is_known")).select("chr", F.lit("+").alias("strand"), F.array(S.span(F.col("start"), F.col("end"))).alias("exons"), place.alias("id"))


def best_ends(junctions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The best score of each junction start, and of each end."""
    return tuple(junctions.groupBy("chr", c).agg(F.max("score").alias(f"best_{c}")) for c in ("start", "end"))


def trusted(junctions: DataFrame, weak: int = 3, strong: int = 20) -> DataFrame:
    """Junctions less the weak, unknown ones that overlap a strong one with which they share no end."""
    heavy = junctions.where(F.col("score") >= strong).select("chr", F.col("start").alias("f_start"), F.col("end").alias("f_end")).distinct()
    doubt = junctions.where((F.col("score") <= weak) & (F.col("known") == 0))
    for mine, theirs in (("start", "f_start"), ("end", "f_end")):
        doubt = doubt.join(heavy.select("chr", F.col(theirs).alias(mine)).distinct(), ["chr", mine], "left_anti")
    bad = overlap_join(doubt.select("chr", "start", "end"), heavy, ["chr"], how="left_semi")
    return junctions.join(bad.distinct(), ["chr", "start", "end"], "left_anti")


def inferred_exons(junctions: DataFrame, coverage: DataFrame, known: DataFrame, longest: int = 500, cutoff: int = 1, gaps: int = 0) -> DataFrame:
    """(chr, start, end, is_known): stretches between a junction's end and a later one's start that coverage fills.

    At most `gaps` bases may lie under `cutoff`; exons that hold two others far apart go."""
    sure = trusted(junctions)
    ends = sure.select("chr", F.col("end").alias("_je")).distinct()
    starts = sure.select("chr", F.col("start").alias("_js")).distinct()
    exons = band_join(ends, starts, ["chr"], "_je", "_js", 0, longest).select("chr", (F.col("_je") + 1).alias("start"), (F.col("_js") - 1).alias("end"))
    exons = exons.where("end >= start").distinct()
    half_open = exons.select("chr", (F.col("start") - 1).alias("start"), "end")
    full = over_spans(half_open, coverage, ["chr"], cutoff).where(F.col("below") <= gaps).select("chr", (F.col("start") + 1).alias("start"), "end")
    annotated = known.select("chr", "start", "end").distinct().withColumn("is_known", F.lit(True))
    slim = contained_removed(full, ["chr"])
    return slim.join(annotated, ["chr", "start", "end"], "left").na.fill(False, ["is_known"])


def consensus(rows: DataFrame, on: Sequence[str], base: str = "base", order: str = "ACGTN") -> DataFrame:
    """(on, base, n): the most frequent base; ties go to the one earlier in `order`."""
    counts = rows.groupBy(*on, base).agg(F.count(F.lit(1)).alias("n"))
    rank = F.instr(F.lit(order), F.col(base))
    rank = F.when(rank == 0, len(order) + 1).otherwise(rank)
    best = counts.groupBy(*on).agg(F.max_by(F.struct(base, "n"), F.struct("n", -rank)).alias("best"))
    return best.select(*on, F.col(f"best.{base}").alias(base), F.col("best.n").alias("n"))
