"""Alignments to SAM columns and back, and final cleanup against the genome."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions import flags as B
from loomspan.functions import fragments as R
from loomspan.functions import sequence as Q
from loomspan.functions import spans as S
from loomspan.operators.hits import mates_of_joined
from loomspan.operators.reads import fused


def sized(rows: DataFrame, genome: DataFrame) -> DataFrame:
    """rows with _size, the chunks' size: one row, so its broadcast is bounded."""
    return rows.crossJoin(F.broadcast(genome.select("size").limit(1).agg(F.max("size").alias("_size"))))


def with_genome(rows: DataFrame, genome: DataFrame, key: list[str], spans: str = "spans") -> DataFrame:
    """rows with genome: the bases under their spans, from genome chunks (chr, chunk, size, seq).

    A span is cut at the chunks' borders, each part is one equi-join on (chr, chunk), and the parts meet by `key`."""
    size = F.col("_size")
    parts = sized(rows, genome).select("_size", *dict.fromkeys([*key, "chr"]), F.explode(spans).alias("s")).select(
        "_size", *key, F.col("chr").alias("_chr"), F.col("s.start").alias("_s"), F.col("s.end").alias("_e")
    )
    low, high = F.floor((F.col("_s") - 1) / size), F.floor((F.col("_e") - 1) / size)
    parts = parts.withColumn("chunk", F.explode(F.sequence(low, high)))
    parts = parts.withColumn("_a", F.greatest(F.col("_s") - 1, F.col("chunk") * size)).withColumn("_b", F.least(F.col("_e"), (F.col("chunk") + 1) * size))
    found = parts.join(genome.select(F.col("chr").alias("_chr"), "chunk", "seq"), ["_chr", "chunk"])
    text = F.substring("seq", (F.col("_a") - F.col("chunk") * size + 1).cast("int"), (F.col("_b") - F.col("_a")).cast("int"))
    whole = found.select(*key, "_a", text.alias("_t")).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_a", "_t"))).alias("_p"))
    return rows.join(whole.select(*key, F.array_join(F.transform("_p", lambda x: x["_t"]), "").alias("genome")), key, "left")


def cleaned(rows: DataFrame, genome: DataFrame, least: int) -> DataFrame:
    """Alignments with mismatched ends cut off, less the short, the upside-down and those off the genome.

    Rows have seqnum, mate, chr, spans, strand, seq; the shortest allowed match holds before and after."""
    key = ["seqnum", "mate", "chr", "spans"]
    size = lambda: S.total_length(F.col("spans"))
    sound = rows.where((size() >= least) & ~F.exists("spans", lambda x: x["end"] < x["start"]))
    looked = with_genome(sound.dropDuplicates(key), genome, key).where(F.length("genome") == size())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                spans = [(s["start"], s["end"]) for s in row["spans"]]
                spans, seq = R.trimmed(spans, R.plain(row["seq"]), row["genome"])
                row["spans"], row["seq"] = [{"start": s, "end": e} for s, e in spans], R.marked(seq, spans)
            yield pa.RecordBatch.from_pylist(rows, batch.schema)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in looked.schema)
    # insertions have no place in the genome, so such rows are left as they are
    plain, odd = looked.where(~F.col("seq").contains("+")), looked.where(F.col("seq").contains("+"))
    return plain.mapInArrow(run, kinds).unionByName(odd).where(size() >= least).drop("genome")


def _mate_flag(mate: str, mapped: Column, other: Column, strand: Column, other_strand: Column) -> Column:
    first, reverse = mate == "a", lambda s, m: s != ("+" if m == "a" else "-")
    bit = lambda name, on: F.when(on, 1 << B.BITS.index(name)).otherwise(0)
    return (
        F.lit(1)
        + bit("proper_pair", mapped & other)
        + bit("unmapped", ~mapped)
        + bit("mate_unmapped", ~other)
        + bit("reverse", mapped & reverse(strand, mate))
        + bit("mate_reverse", other & reverse(other_strand, "b" if first else "a"))
        + F.lit(64 if first else 128)
    )


_HIT = f"struct<chr: string, spans: {S.TYPE}, strand: string, seq: string, left: bigint, right: bigint>"


def fragments(reads: DataFrame, alignments: DataFrame, distance: int = 500_000) -> DataFrame:
    """(seqnum, a, b, overlap, hi, ih): the alignments (seqnum, mate a|b|"", chr, spans, strand, seq) of each read as fragments, numbered by
    place. reads: (seqnum, a_seq, b_seq).

    A joined alignment is cut into its mates. Of other rows, a forward and a reverse one are a pair if they are consistent (one
    chromosome and strand, in order, at most `distance` apart) and each is the nearest that the other has."""
    whole = alignments.select("seqnum", "mate", "chr", "spans", "strand", "seq").distinct()
    none = F.lit(None).cast(_HIT)

    def side(m: str, name: str) -> DataFrame:
        rows = whole.where(F.col("mate") == m)
        if f"{m}_seq" in reads.columns:
            rows = rows.join(reads.select("seqnum", F.col(f"{m}_seq").alias("_read")), "seqnum", "left")
        else:
            rows = rows.withColumn("_read", F.lit(None).cast("string"))
        turned = F.col("strand") != ("+" if m == "a" else "-")
        text = F.when(turned, Q.reverse_complement(F.col("_read"))).otherwise(F.col("_read"))
        bare = F.translate("seq", ":+", "")
        left = F.greatest(F.instr(text, bare) - 1, F.lit(0)).cast("long")
        right = F.greatest(F.length(text) - F.length(bare) - left, F.lit(0)).cast("long")
        return rows.select("seqnum", "chr", "strand", F.struct("chr", "spans", "strand", "seq", F.coalesce(left, F.lit(0)).alias("left"), F.coalesce(right, F.lit(0)).alias("right")).cast(_HIT).alias(name))

    fwd, rev = side("a", "a"), side("b", "b")
    up, down = (F.when(F.col("a.strand") == "+", F.col(x)).otherwise(F.col(y)) for x, y in (("a", "b"), ("b", "a")))
    gap = S.first_start(down["spans"]) - S.last_end(up["spans"])
    met = fwd.join(rev, ["seqnum", "chr", "strand"])
    met = met.where((S.first_start(up["spans"]) <= S.first_start(down["spans"])) & (gap <= distance)).withColumn("_gap", F.abs(gap))
    nearest = lambda x, y: F.row_number().over(Window.partitionBy("seqnum", "chr", "strand", x).orderBy("_gap", y))
    pairs = met.withColumns({"_ka": nearest("a", "b"), "_kb": nearest("b", "a")}).where("_ka = 1 and _kb = 1").select("seqnum", "a", "b")
    over = S.overlap(F.col("a.spans"), F.col("b.spans"))
    out = pairs.withColumn("overlap", over)
    out = out.unionByName(fwd.join(pairs, ["seqnum", "a"], "left_anti").select("seqnum", "a", none.alias("b"), F.lit(False).alias("overlap")))
    out = out.unionByName(rev.join(pairs, ["seqnum", "b"], "left_anti").select("seqnum", none.alias("a"), "b", F.lit(False).alias("overlap")))
    if "b_seq" in reads.columns:
        cut = mates_of_joined(whole.where("mate = ''"), reads.where("a_seq is not null and b_seq is not null"))
        hit = F.struct("chr", "spans", "strand", "seq", "left", "right").cast(_HIT)
        of = lambda m: F.max(F.when(F.col("mate") == m, hit)).alias(m)
        out = out.unionByName(cut.groupBy("seqnum", "chr", "strand", "whole").agg(of("a"), of("b")).select("seqnum", "a", "b", F.lit(True).alias("overlap")))
    each = Window.partitionBy("seqnum")
    first = F.least(S.first_start(F.col("a.spans")), S.first_start(F.col("b.spans")))
    order = each.orderBy(F.coalesce("a.chr", "b.chr"), first, "a", "b")
    return out.withColumns({"hi": F.row_number().over(order), "ih": F.count(F.lit(1)).over(each)})


def to_sam(reads: DataFrame, alignments: DataFrame, genome: DataFrame | None = None, unmapped: bool = True, distance: int = 500_000) -> DataFrame:
    """SAM rows of reads (seqnum, a_seq and, of pairs, b_seq; a_qual, b_qual, a_name, b_name if there are) and their alignments.

    Alignments (seqnum, mate, chr, spans, strand, seq) become fragments first, so a pair's rows have one HI; strand is the forward mate's.
    MAPQ is 25 where a read has one fragment, else 0. Tags: XO whether the mates overlap, IH, HI, and with genome chunks (chr, chunk, size,
    seq) MD, NM and XS, the strand that all the row's introns with a signal tell. Reads without any alignment are unmapped rows, if asked."""
    two = "b_seq" in reads.columns
    whole = reads if two else reads.withColumn("b_seq", F.lit(None).cast("string"))
    for c in ("a_qual", "b_qual", "a_name", "b_name"):
        whole = whole if c in whole.columns else whole.withColumn(c, F.lit(None).cast("string"))
    found = fragments(reads, alignments, distance)
    rows = whole.join(found, "seqnum", "left" if unmapped else "inner")
    own = lambda m, o: F.struct(
        F.lit(m).alias("mate"), F.col(m).alias("x"), F.col(o).alias("o"),
        *[F.coalesce(*[F.col(f"{p}_{c}") for p in ((m, o) if c == "name" else (m,))]).alias(c) for c in ("seq", "qual", "name")],
    )
    rows = rows.select("seqnum", F.coalesce("hi", F.lit(1)).alias("hi"), "ih", "overlap", F.explode(F.array(own("a", "b"), *([own("b", "a")] if two else []))).alias("s"))
    rows = rows.select("seqnum", "hi", "ih", "overlap", "s.*").withColumn("chr", F.col("x.chr"))
    gaps = S.fused(F.col("x.spans"), 14)
    ends = lambda i, x: F.array(S.span(F.get(gaps, i - 1)["end"] + 1, F.get(gaps, i - 1)["end"] + 2), S.span(x["start"] - 2, x["start"] - 1), x)
    places = F.flatten(F.transform(gaps, lambda x, i: F.when(i == 0, F.array(x)).otherwise(ends(i, x))))
    if genome is None:
        rows = rows.withColumn("genome", F.lit(None).cast("string"))
    else:
        rows = with_genome(rows.withColumn("_places", places), genome, ["seqnum", "hi", "mate"], "_places").drop("_places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, text in zip(batch.column("x").to_pylist(), batch.column("genome").to_pylist(), strict=True):
                spans = [(s["start"], s["end"]) for s in x["spans"]] if x else []
                out.append(R.sam_fields(spans, x["seq"], x["left"], x["right"], text) if x else ("*", None, None, None))
            new = [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "cigar", "md", "nm", "xs"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    rows = rows.mapInArrow(run, f"{kinds}, cigar string, md string, nm long, xs string")
    mapped, other = F.col("x").isNotNull(), F.col("o").isNotNull()
    start, low = S.first_start(F.col("x.spans")), S.first_start(F.col("o.spans"))
    end, high = S.last_end(F.col("x.spans")), S.last_end(F.col("o.spans"))
    width = F.greatest(end, high) - F.least(start, low) + 1
    ahead = (start < low) | ((start == low) & (F.col("mate") == "a"))
    turned = mapped & (F.col("x.strand") != F.when(F.col("mate") == "a", "+").otherwise("-"))
    flag = F.when(F.col("mate") == "a", _mate_flag("a", mapped, other, F.col("x.strand"), F.col("o.strand"))).otherwise(
        _mate_flag("b", mapped, other, F.col("x.strand"), F.col("o.strand"))
    )
    bit = lambda name, on: F.when(on, 1 << B.BITS.index(name)).otherwise(0)
    flag = flag if two else bit("unmapped", ~mapped) + bit("reverse", turned)
    tag = lambda name, value: F.when(mapped & value.isNotNull(), F.concat(F.lit(name), value.cast("string")))
    tags = [tag("XO:A:", F.when(F.col("overlap"), "T").otherwise("F")), tag("MD:Z:", F.col("md")), tag("NM:i:", F.col("nm")), tag("IH:i:", F.col("ih"))]
    tags += [tag("HI:i:", F.col("hi")), tag("XS:A:", F.col("xs"))]
    return rows.select(
        F.coalesce("name", F.concat(F.lit("seq."), F.col("seqnum"))).alias("qname"),
        flag.cast("int").alias("flag"),
        F.coalesce("x.chr", "o.chr", F.lit("*")).alias("rname"),
        F.coalesce(start, low, F.lit(0)).alias("pos"),
        F.when(mapped & (F.col("ih") == 1), 25).otherwise(0).alias("mapq"),
        "cigar",
        F.lit("=" if two else "*").alias("rnext"),
        F.coalesce(low, start, F.lit(0)).alias("pnext") if two else F.lit(0).cast("long").alias("pnext"),
        F.when(mapped & other, F.when(ahead, width).otherwise(-width)).otherwise(0).alias("tlen"),
        F.when(turned, Q.reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("seq"),
        F.coalesce(F.when(turned, F.reverse("qual")).otherwise(F.col("qual")), F.lit("*")).alias("qual"),
        F.filter(F.array(*tags), lambda x: x.isNotNull()).alias("tags"),
    )


def from_sam(sam: DataFrame, fuse: bool = False) -> DataFrame:
    """Alignments (seqnum, mate, chr, spans, strand, seq, is_unique) of mapped SAM rows; unique by IH or NH, else by number of rows.

    Insertions and clips leave the sequence; strand is the forward mate's. fuse: mates of one HI that touch or overlap, and whose inner
    blocks agree, are one row without a mate."""
    rows = sam.where(~B.has(F.col("flag"), "unmapped"))
    mate = F.when(~B.has(F.col("flag"), "paired"), "a").when(B.has(F.col("flag"), "last"), "b").otherwise("a")
    number = F.regexp_extract("qname", r"(\d+)[ab]?$", 1).cast("long")
    strand = F.when(B.has(F.col("flag"), "reverse"), "-").otherwise("+")
    tag = F.regexp_extract(F.array_join("tags", "\t"), r"(?:^|\t)(?:IH|NH):i:(\d+)", 1)
    rows = rows.select(
        number.alias("seqnum"),
        mate.alias("mate"),
        F.col("rname").alias("chr"),
        S.cigar_spans(F.col("pos"), F.col("cigar")).alias("spans"),
        Q.flipped(strand, mate == "b").alias("strand"),
        _aligned(F.col("seq"), F.col("cigar")).alias("seq"),
        F.when(tag != "", tag.cast("long")).alias("_ih"),
        F.regexp_extract(F.array_join("tags", "\t"), r"(?:^|\t)HI:i:(\d+)", 1).alias("_hi"),
    )
    each = rows.groupBy("seqnum", "mate").agg(F.count(F.lit(1)).alias("_rows"))
    out = rows.join(each, ["seqnum", "mate"])
    out = out.withColumn("is_unique", F.coalesce("_ih", "_rows") == 1).drop("_ih", "_rows")
    if not fuse:
        return out.drop("_hi")
    key = ["seqnum", "_hi", "chr", "strand", "is_unique"]
    side = lambda m: out.where(F.col("mate") == m).select(*key, F.struct("spans", "seq").alias(m))
    up, down = (F.when(F.col("strand") == "+", F.col(x)).otherwise(F.col(y)) for x, y in (("a", "b"), ("b", "a")))
    pairs = side("a").join(side("b"), key).where(F.col("_hi") != "").select(*key, up.alias("up"), down.alias("down"))
    near = (S.first_start(F.col("up.spans")) <= S.first_start(F.col("down.spans"))) & (S.first_start(F.col("down.spans")) - S.last_end(F.col("up.spans")) <= 1)
    joined = fused(pairs.where(near)).select(*key, "joined.spans", "joined.seq", F.lit("").alias("mate"))
    return out.join(joined.select(*key), key, "left_anti").unionByName(joined).drop("_hi")


def _aligned(seq: Column, cigar: Column) -> Column:
    """The read's bases that matches cover."""
    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))

    def step(state: Column, x: Column) -> Column:
        takes, covers = x["op"].isin("M", "=", "X", "I", "S"), x["op"].isin("M", "=", "X")
        return F.struct(
            F.when(takes, state["at"] + x["len"]).otherwise(state["at"]).alias("at"),
            F.when(covers, F.concat(state["out"], F.substring(seq, state["at"], x["len"]))).otherwise(state["out"]).alias("out"),
        )

    return F.aggregate(S.cigar_ops(cigar), start, step)["out"]


def header(genome: DataFrame) -> DataFrame:
    """(chr, length) of @SQ lines."""
    return genome.select("chr", F.length("seq").alias("length"))


def merged_headers(*headers: DataFrame) -> DataFrame:
    out = headers[0]
    for other in headers[1:]:
        out = out.unionByName(other)
    return out.groupBy("chr").agg(F.max("length").alias("length"))


def suppressed(sam: DataFrame, needed: str = "any") -> DataFrame:
    """SAM rows whose read has any mapped segment, `this` one mapped, or `both` mapped."""
    this, other = ~B.has(F.col("flag"), "unmapped"), ~B.has(F.col("flag"), "mate_unmapped") & B.has(F.col("flag"), "paired")
    return sam.where({"any": this | other, "this": this, "both": this & other}[needed])


def mismatch_tagged(rows: DataFrame, genome: DataFrame) -> DataFrame:
    """Alignments with md and nm: also of inserted bases and of gaps under 15 bases, which are deletions."""
    key = ["seqnum", "mate", "chr", "spans"]
    gaps = S.fused(F.col("spans"), 14)
    looked = with_genome(rows.withColumn("_gaps", gaps), genome, key, "_gaps").drop("_gaps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                spans, text = [(s["start"], s["end"]) for s in r["spans"]], r["genome"]
                if text is not None:  # no intron's ends are looked up: leave room for them
                    at, parts = 0, []
                    for k, (s, e) in enumerate(spans):
                        gap = s - spans[k - 1][1] - 1 if k else 0
                        if gap >= 15:
                            parts.append("NNNN")
                        n = e - s + 1 + (gap if gap < 15 else 0)
                        parts.append(text[at : at + n])
                        at += n
                    text = "".join(parts)
                out.append(R.sam_fields(spans, r["seq"], 0, 0, text)[1:3])
            new = [pa.array([t[0] for t in out], pa.string()), pa.array([t[1] for t in out], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "md", "nm"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in looked.schema)
    return looked.mapInArrow(run, f"{kinds}, md string, nm long").drop("genome")
