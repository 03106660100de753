"""Feature quantification, comparison of samples, and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions import flags
from loomspan.functions import sequence as Q
from loomspan.functions import spans as S
from loomspan.operators import breakpoints
from loomspan.operators.breakpoints import overlap_counts


def features_of(genes: DataFrame) -> DataFrame:
    """(feature_type, chr, start, end, strand, id, ordinal) of genes (chr, strand, exons, id): a transcript, its exons and introns.

    Exons and introns are numbered in the direction of transcription."""
    whole = genes.select(
        F.lit("transcript").alias("feature_type"),
        "chr",
        F.element_at("exons", 1)["start"].alias("start"),
        F.element_at("exons", -1)["end"].alias("end"),
        "strand",
        "id",
        F.lit(0).alias("ordinal"),
    )
    n = F.size("exons")
    exons = genes.select("chr", "strand", "id", n.alias("n"), F.posexplode("exons").alias("k", "s")).select(
        F.lit("exon").alias("feature_type"), "chr", "s.start", "s.end", "strand", "id", _turn(F.col("k"), F.col("n")).alias("ordinal")
    )
    gaps = F.transform(
        F.slice("exons", 2, F.greatest(n - 1, F.lit(0))),
        lambda x, i: F.struct((F.get("exons", i)["end"] + 1).alias("start"), (x["start"] - 1).alias("end")),
    )
    introns = genes.select("chr", "strand", "id", n.alias("n"), F.posexplode(gaps).alias("k", "s")).select(
        F.lit("intron").alias("feature_type"), "chr", "s.start", "s.end", "strand", "id", _turn(F.col("k"), F.col("n") - 1).alias("ordinal")
    )
    return whole.unionByName(exons).unionByName(introns)


def _turn(k: Column, n: Column) -> Column:
    return F.when(F.col("strand") == "-", n - k).otherwise(k + 1).cast("int")


def feature_counts(
    fragments: DataFrame, features: DataFrame, read: str = "seqnum", strand: str | None = None, anti: bool = False
) -> DataFrame:
    """features with ucount and nucount: unique and ambiguous reads of which a block overlaps, each counted once per feature.

    fragments have (read, chr, spans, strand, is_unique). With strand + or -, features of that strand are counted from
    reads of the same strand, or of the other one with anti. Features without reads stay with 0."""
    if strand:
        features = features.where(F.col("strand") == strand)
        fragments = fragments.where(F.col("strand") != strand if anti else F.col("strand") == strand)
    return _counted(fragments, features, read, {"ucount": F.col("is_unique"), "nucount": ~F.col("is_unique")})


def sense_counts(fragments: DataFrame, features: DataFrame, read: str = "seqnum") -> DataFrame:
    """features of strand + or - with sense and anti: unique reads of their own and of the other strand of which a block overlaps, by one pass.

    fragments have (read, chr, spans, strand, is_unique); those without + or - are on neither strand."""
    on = lambda s: F.col("is_unique") & (F.col("strand") == s)
    counts = _counted(fragments, features.where(F.col("strand").isin("+", "-")), read, {"_plus": on("+"), "_minus": on("-")})
    turned = lambda a, b: F.when(F.col("strand") == "+", F.col(a)).otherwise(F.col(b))
    return counts.withColumns({"sense": turned("_plus", "_minus"), "anti": turned("_minus", "_plus")}).drop("_plus", "_minus")


def _counted(fragments: DataFrame, features: DataFrame, read: str, kinds: dict[str, Column]) -> DataFrame:
    """features with a count for each of `kinds`, conditions that exclude each other: such reads of which a block overlaps, each once per feature.

    A read meets a feature first with the block whose reach, the end of the read's blocks before it in order of start, is left of the feature;
    only that meeting counts, so pairs of reads and features need not be made distinct."""
    kind = F.coalesce(*[F.when(c, k) for k, c in enumerate(kinds.values())])
    blocks = fragments.select(F.col(read).alias("_read"), "chr", kind.alias("_kind"), F.explode("spans").alias("_s")).where("_kind is not null and chr is not null")
    blocks = blocks.select("_read", "chr", "_kind", F.col("_s.start").alias("_a"), F.col("_s.end").alias("_b")).where("_a <= _b")
    before = Window.partitionBy("_read", "chr", "_kind").orderBy("_a", "_b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_reach", F.max("_b").over(before))
    places = features.select("chr", F.col("start").alias("f_start"), F.col("end").alias("f_end")).distinct()
    sums = overlap_counts(blocks, places, ["chr"], ("_a", "_b"), ("f_start", "f_end"), "_reach", "_kind", list(kinds))
    sums = sums.withColumnsRenamed({"f_start": "start", "f_end": "end"})
    return features.join(sums, ["chr", "start", "end"], "left").na.fill(0, list(kinds))


def read_total(fragments: DataFrame, read: str = "seqnum") -> DataFrame:
    """One row, num_reads: unique fragments and distinct ambiguous reads. With a column mate, both mates of a unique read are one."""
    sure = F.count_distinct(F.when(F.col("is_unique"), F.col(read))) if "mate" in fragments.columns else F.count_if(F.col("is_unique"))
    unique = sure + F.count_distinct(F.when(~F.col("is_unique"), F.col(read)))
    return fragments.agg(unique.alias("num_reads"))


def normalised(counts: DataFrame, total: DataFrame, length: Column | None = None) -> DataFrame:
    """counts with min and max: RPKM of unique reads, and of all. total is one row (num_reads)."""
    size = F.col("end") - F.col("start") + 1 if length is None else length
    out = counts.crossJoin(F.broadcast(total))  # one row
    low = Q.rpkm(F.col("ucount"), size, F.col("num_reads"))
    return out.withColumns({"min": low, "max": Q.rpkm(F.col("ucount") + F.col("nucount"), size, F.col("num_reads"))}).drop("num_reads")


def positive(counts: DataFrame) -> DataFrame:
    """Features with any read."""
    return counts.where(F.col("ucount") + F.col("nucount") > 0)


def separate(counts: DataFrame, total: DataFrame, length: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(of unique reads, of all reads): counts with count, average (per kilobase, to four digits) and rpkm instead of ucount and nucount."""
    size = F.col("end") - F.col("start") + 1 if length is None else length
    whole = counts.crossJoin(F.broadcast(total))  # one row
    each = []
    for n in (F.col("ucount"), F.col("ucount") + F.col("nucount")):
        average = F.when(size > 0, Q.truncated(n / (size / 1000))).otherwise(F.lit(0.0))
        rows = whole.withColumns({"count": n, "average": average, "rpkm": Q.rpkm(n, size, F.col("num_reads"))})
        each.append(rows.drop("ucount", "nucount", "num_reads"))
    return each[0], each[1]


def merged(tables: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Counts of parts added up by feature."""
    out = tables[0]
    for other in tables[1:]:
        out = out.unionByName(other)
    return out.groupBy(*key).agg(F.sum("ucount").alias("ucount"), F.sum("nucount").alias("nucount"))


def fold_change(a: DataFrame, b: DataFrame, key: str, value: str, least: float = 0.0) -> DataFrame:
    """(key, x, y, ratio, up): ratio of a's to b's value, each plus a twentieth of the sum of both means, turned to be 1 at least.

    Features whose larger value is under `least` go; means are over all features that both have."""
    x, y = a.select(key, F.col(value).alias("x")), b.select(key, F.col(value).alias("y"))
    joined = x.join(y, key)
    raf = joined.agg(((F.avg("x") + F.avg("y")) / 20).alias("raf")).withColumn("raf", F.when(F.col("raf") > 0, F.col("raf")).otherwise(1e-7))
    out = joined.crossJoin(F.broadcast(raf)).where(F.greatest("x", "y") >= least)  # one row
    ratio = (F.col("x") + F.col("raf")) / (F.col("y") + F.col("raf"))
    return out.select(key, "x", "y", F.when(ratio < 1, 1 / ratio).otherwise(ratio).alias("ratio"), (ratio >= 1).cast("int").alias("up"))


def profiles(quants: DataFrame, feature: Sequence[str], sample: str, samples: Sequence[str], values: Sequence[str]) -> DataFrame:
    """A row per feature with sample_value columns: one pass, as the samples are named."""
    return quants.groupBy(*feature).pivot(sample, list(samples)).agg(*[F.first(v, ignorenulls=True).alias(v) for v in values])


def profile_matrix(
    quants: DataFrame, feature: Sequence[str], sample: str, samples: Sequence[str], low: str = "min", high: str = "max", info: DataFrame | None = None
) -> DataFrame:
    """A row per feature with min_, max_ and diff_ (max less min) of each sample, 0 where a sample hasn't it, and the feature's
    information from info (feature..., info) if given."""
    names = list(samples)
    wide = profiles(quants, feature, sample, names, [low, high])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    cells = [zero(f"{n}_{low}").alias(f"min_{n}") for n in names] + [zero(f"{n}_{high}").alias(f"max_{n}") for n in names]
    cells += [(zero(f"{n}_{high}") - zero(f"{n}_{low}")).alias(f"diff_{n}") for n in names]
    out = wide.select(*feature, *cells)
    return out if info is None else out.join(info, list(feature), "left")


def strand_specific(sense: DataFrame, anti: DataFrame, key: Sequence[str], strand: str = "strand") -> DataFrame:
    """(key, strand, sense, antisense) of counts (key, strand, plus, minus): a minus feature's sense reads are the minus ones."""
    own = lambda df, name: df.select(*key, strand, F.when(F.col(strand) == "-", F.col("minus")).otherwise(F.col("plus")).alias(name))
    other = lambda df, name: df.select(*key, F.when(F.col(strand) == "-", F.col("plus")).otherwise(F.col("minus")).alias(name))
    return own(sense, "sense").join(other(anti, "antisense"), list(key))


def _units(fragments: DataFrame, read: str) -> DataFrame:
    """(_read, chr, is_unique, spans, _side, _limit): fragments with the mates of a read told apart.

    _side 1 and 2: the upstream and downstream of two mates that don't overlap, _limit where the other begins or ends. Mates that
    overlap are one row of fused spans. Where a read has more rows on a chromosome, which belong together isn't known; each is alone."""
    rows = fragments.select(F.col(read).alias("_read"), "chr", "is_unique", "spans", *(["mate"] if "mate" in fragments.columns else []))
    alone = (F.lit(0).alias("_side"), F.lit(None).cast("long").alias("_limit"))
    if "mate" not in fragments.columns:
        return rows.select("*", *alone)
    key = ["_read", "chr", "is_unique"]
    of = lambda m: F.first(F.when(F.col("mate") == m, F.col("spans")), ignorenulls=True).alias(m)
    pairs = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), of("a"), of("b")).where("n = 2 and a is not null and b is not null")
    forward = F.col("a")[0]["start"] <= F.col("b")[0]["start"]
    up, down = F.when(forward, F.col("a")).otherwise(F.col("b")), F.when(forward, F.col("b")).otherwise(F.col("a"))
    pairs = pairs.select(*key, up.alias("up"), down.alias("down"))
    ends, begins = F.element_at("up", -1)["end"].cast("long"), F.col("down")[0]["start"].cast("long")
    unit = lambda s, side, limit: F.struct(s.alias("spans"), F.lit(side).alias("_side"), limit.alias("_limit"))
    apart = F.array(unit(F.col("up"), 1, begins), unit(F.col("down"), 2, ends))
    over = F.array(unit(S.fused(F.array_sort(F.concat("up", "down"))), 0, F.lit(None).cast("long")))
    paired = pairs.select(*key, F.explode(F.when(ends < begins, apart).otherwise(over)).alias("u")).select(*key, "u.*")
    return rows.join(pairs.select(*key), key, "left_anti").select(*key, "spans", *alone).unionByName(paired)


def uniqueness(rows: DataFrame, policy: str = "tags", read: str = "seqnum") -> DataFrame:
    """SAM rows (read, flag, cigar, hits) with is_unique, by one of three policies; hits is the IH or, without it, the NH tag.

    tags: a read is unique unless a row of it tells more than one hit; rows without the tag tell nothing.
    counted, for tables without tags: a mate is unique if it has one mapped row; where its mate is mapped too, both must be.
    primary: rows that aren't marked secondary are unique, others aren't.
    The first two cost one aggregation by read, joined back; null reads and rows without a flag are of no read and not unique."""
    if policy == "primary":
        return rows.withColumn("is_unique", F.coalesce(~flags.has(F.col("flag"), "secondary"), F.lit(False)))
    if policy == "tags":
        many = rows.groupBy(read).agg((F.coalesce(F.max("hits"), F.lit(1)) <= 1).alias("is_unique"))
        out = rows.drop("is_unique").join(many, read, "left")
    elif policy == "counted":
        mapped = ~flags.has(F.col("flag"), "unmapped") & (F.col("cigar") != "*")
        of = lambda m: F.count_if(mapped & flags.has(F.col("flag"), m))
        counts = rows.groupBy(read).agg(of("first").alias("_a"), of("last").alias("_b"), F.count_if(mapped & ~flags.has(F.col("flag"), "paired")).alias("_s"))
        first, last = flags.has(F.col("flag"), "first"), flags.has(F.col("flag"), "last")
        own = F.when(first, F.col("_a")).when(last, F.col("_b")).otherwise(F.col("_s"))
        other = F.when(flags.has(F.col("flag"), "mate_unmapped"), 0).when(first, F.col("_b")).when(last, F.col("_a")).otherwise(0)
        out = rows.drop("is_unique").join(counts, read, "left").withColumn("is_unique", (own == 1) & (other <= 1)).drop("_a", "_b", "_s")
    else:
        raise ValueError(f"no policy {policy}")
    return out.withColumn("is_unique", F.coalesce(F.col("is_unique") & F.col("flag").isNotNull() & F.col(read).isNotNull(), F.lit(False))).select(*[c for c in rows.columns if c != "is_unique"], "is_unique")


def exon_counts(fragments: DataFrame, exons: DataFrame, read: str = "seqnum", once: bool = False) -> DataFrame:
    """exons (chr, start, end) with ucount, nucount of reads compatible with them.

    A read's inner block boundaries must be the exon's own; its outer ends must lie within the exon. With a column mate, two mates
    that don't overlap count by the blocks that face each other only if both fit, or if one fits and the other mate
    doesn't reach the exon. Each read counts once. once: exons have no other columns, and equal ones come out as one."""
    n, mates = F.size("spans"), "mate" in fragments.columns
    blocks = _units(fragments, read).where("is_unique is not null").select("_read", "chr", "is_unique", "_side", "_limit", n.alias("_n"), F.posexplode("spans").alias("_k", "_s"))
    asks = {
        breakpoints.BEGINS: F.col("_k") > 0,
        breakpoints.ENDS: F.col("_k") < F.col("_n") - 1,
        breakpoints.SECOND: ~F.col("is_unique"),
        breakpoints.UP: (F.col("_side") == 1) & (F.col("_k") == F.col("_n") - 1),
        breakpoints.DOWN: (F.col("_side") == 2) & (F.col("_k") == 0),
    }
    kind = sum((F.when(c, k).otherwise(0) for k, c in asks.items()), F.lit(0))
    blocks = blocks.select("_read", "chr", F.col("_s.start").alias("_a"), F.col("_s.end").alias("_b"), kind.alias("_kind"), *(["_limit"] if mates else []))
    places = exons.select("chr", "start", "end")
    counts = ("ucount", "nucount")
    sums = breakpoints.compatible_counts(blocks, places, ["chr"], ("_a", "_b"), ("start", "end"), "_read", "_kind", counts, "_limit" if mates else None)
    if not once:
        return exons.join(sums.where("ucount + nucount > 0"), ["chr", "start", "end"], "left").na.fill(0, list(counts))
    odd = places.where("chr is null or start is null or end is null or start > end").distinct()
    return sums.unionByName(odd.withColumns({c: F.lit(0).cast("long") for c in counts}))


def ordinals(df: DataFrame, group: Sequence[str], at: str, backwards: Column) -> DataFrame:
    """df with ordinal: 1, 2, ... by place within the group, from the far end where `backwards` holds."""
    order = F.when(backwards, -F.col(at)).otherwise(F.col(at))
    return df.withColumn("ordinal", F.row_number().over(Window.partitionBy(*group).orderBy(order)))
