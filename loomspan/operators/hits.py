"""Aligners' raw hits as alignments, and their classification into unique and ambiguous ones."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.functions import fragments as R
from loomspan.functions import sequence as Q
from loomspan.functions import spans as S
from loomspan.operators import reads
from loomspan.session import settled


def genome_hits(hits: DataFrame) -> DataFrame:
    """(seqnum, mate, chr, spans, strand, seq) of ungapped hits (seqnum, mate, strand, target, start, seq); Ns at the ends go."""
    body = Q.trim_n(F.col("seq"), F.col("start"))
    rows = hits.withColumn("_b", body).where(F.length("_b.seq") > 0)
    return rows.select("seqnum", "mate", F.col("target").alias("chr"), F.array(S.span(F.col("_b.start"), F.col("_b.end"))).alias("spans"), "strand", F.col("_b.seq").alias("seq"))


def transcript_hits(hits: DataFrame, models: DataFrame) -> DataFrame:
    """The same of hits on transcripts, lifted to the genome; models (chr, strand, exons, id), target is a model's id.

    On a minus-strand model the bases and the strand are turned."""
    body = Q.trim_n(F.col("seq"), F.col("start"))
    rows = hits.withColumn("_b", body).where(F.length("_b.seq") > 0)
    met = rows.join(models.select(F.col("id").alias("target"), "chr", F.col("strand").alias("_m"), "exons"), "target")
    n = F.length("_b.seq")
    spans = S.lifted(F.col("exons"), F.col("_m"), F.col("_b.start") - 1, n)
    minus = F.col("_m") == "-"
    seq = F.when(minus, Q.reverse_complement(F.col("_b.seq"))).otherwise(F.col("_b.seq"))
    out = met.select("seqnum", "mate", "chr", spans.alias("spans"), Q.flipped(F.col("strand"), minus).alias("strand"), seq.alias("seq"))
    marked = Q.with_junctions(F.col("seq"), F.col("spans"))
    return out.where(S.total_length(F.col("spans")) == F.length("seq")).withColumn("seq", marked).distinct()


def ranked_psl(rows: DataFrame, within: int = 10, ahead: int = 2, more: int = 2) -> DataFrame:
    """Kept PSL rows near the best of their read, with lead: whether the row alone has the best score.

    The score is aligned bases less mismatches. First go rows whose score is more than `within` below the furthest base of the read that any of its
    rows reaches; then of the others those `ahead` or more below the best score, and those with over `more` mismatches above the
    best row's (of equally good ones the least). lead looks at all rows of the first pass."""
    score = F.aggregate("block_sizes", F.lit(0).cast("bigint"), lambda n, x: n + x) - F.col("mismatches")
    rows = rows.withColumn("_score", score)
    reach = F.max("q_end" if "q_end" in rows.columns else "_score")
    first = rows.join(rows.groupBy("q_name").agg(reach.alias("_reach")), "q_name").where(F.col("_score") >= F.col("_reach") - within).drop("_reach")
    best = first.groupBy("q_name").agg(
        F.max("_score").alias("_best"), F.min_by("mismatches", F.struct(-F.col("_score"), F.col("mismatches"))).alias("_mm")
    )
    many = first.groupBy("q_name", "_score").agg(F.count(F.lit(1)).alias("_n"))
    best = best.join(many.withColumnRenamed("_score", "_best"), ["q_name", "_best"])
    near = first.join(best, "q_name").where((F.col("_score") > F.col("_best") - ahead) & (F.col("mismatches") <= F.col("_mm") + more))
    return near.withColumn("lead", (F.col("_score") == F.col("_best")) & (F.col("_n") == 1)).drop("_score", "_best", "_mm", "_n")


def psl_hits(rows: DataFrame, sequences: DataFrame, within: int = 10) -> DataFrame:
    """The same of kept PSL rows near the best of their read (ranked_psl), with lead; sequences (q_name, seq) give the aligned bases.

    Blocks that touch in the genome are one span; bases of the read between two blocks are an insertion, marked by plus signs."""
    best = ranked_psl(rows, within)
    met = best.join(sequences, "q_name")
    turned = F.when(F.col("strand") == "-", Q.reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    blocks = F.arrays_zip(F.col("t_starts").alias("t"), F.col("q_starts").alias("q"), F.col("block_sizes").alias("n"))
    met = met.withColumn("_x", turned).withColumn("_blocks", blocks)
    pieces = F.transform(
        "_blocks",
        lambda b, i: F.concat(
            F.when(
                (i > 0) & (b["q"] > F.get("_blocks", i - 1)["q"] + F.get("_blocks", i - 1)["n"]),
                F.concat(
                    F.lit("+"),
                    F.substring(
                        F.col("_x"),
                        (F.get("_blocks", i - 1)["q"] + F.get("_blocks", i - 1)["n"] + 1).cast("int"),
                        (b["q"] - F.get("_blocks", i - 1)["q"] - F.get("_blocks", i - 1)["n"]).cast("int"),
                    ),
                    F.lit("+"),
                ),
            )
            .when((i > 0) & (b["t"] > F.get("_blocks", i - 1)["t"] + F.get("_blocks", i - 1)["n"]), F.lit(":"))
            .otherwise(F.lit("")),
            F.substring(F.col("_x"), (b["q"] + 1).cast("int"), b["n"].cast("int")),
        ),
    )
    spans = S.fused(F.transform("_blocks", lambda b: S.span(b["t"] + 1, b["t"] + b["n"])))
    mate = F.regexp_extract("q_name", r"([ab]?)$", 1)
    return met.select(
        F.regexp_extract("q_name", r"(\d+)[ab]?$", 1).cast("long").alias("seqnum"),
        mate.alias("mate"),
        F.col("t_name").alias("chr"),
        spans.alias("spans"),
        Q.flipped(F.col("strand"), mate == "b").alias("strand"),
        F.array_join(pieces, "").alias("seq"),
        "lead",
    ).distinct()


def split_by_uniqueness(
    hits: DataFrame, least: int, distance: int = 500_000, rescue: bool = True, one_strand: bool = False, one_mate: bool = False, **pairing
) -> tuple[DataFrame, DataFrame]:
    """(unique, ambiguous) alignments (seqnum, mate, chr, spans, strand, seq) of hits; mate is empty where the mates are one.

    Reads with one fragment (reads.classified, which gets `pairing`) are unique. With rescue, so is a read whose alternatives are all
    joined ones, all pairs or all of one mate, lie on one chromosome (one_strand: and strand) and share a region of `least` bases,
    pairs one of each mate, the two apart and at most `distance` from each other: it is reported there. one_mate: of pairs that share a region
    of one mate only, that mate alone is."""
    found = settled(reads.classified(hits, distance=distance, **pairing))
    parts = F.explode(F.array(*[F.struct(F.lit(m).alias("mate"), F.col(c).alias("x")) for m, c in (("a", "fwd"), ("b", "rev"), ("", "joined"))]))

    def rows(fragments: DataFrame) -> DataFrame:
        each = fragments.select("seqnum", "chr", "strand", parts.alias("p")).where("p.x is not null")
        return each.select("seqnum", "p.mate", "chr", "p.x.spans", "strand", "p.x.seq").distinct()

    unique, rest = rows(found.where("is_unique")), found.where("not is_unique")
    if not rescue:
        return unique, rows(rest)
    saved = _shared(rest, least, distance, one_strand, one_mate)
    return unique.unionByName(saved), rows(reads.excluded(rest, saved))


def _shared(fragments: DataFrame, least: int, distance: int, one_strand: bool, one_mate: bool) -> DataFrame:
    """Alignments of the reads whose ambiguous fragments share a region."""
    kind = F.concat(*[F.col(c).isNotNull().cast("int").cast("string") for c in ("fwd", "rev", "joined")])
    groups = fragments.groupBy("seqnum").agg(
        F.count_distinct("chr").alias("_c"), F.count_distinct("strand").alias("_s"), F.count_distinct(kind).alias("_k"), F.min("chr").alias("chr"),
        F.min("strand").alias("strand"), F.array_sort(F.collect_list(F.struct("fwd", "rev", "joined"))).alias("hits"),
    )
    groups = groups.where("_c = 1 and _k = 1" + " and _s = 1" * one_strand).select("seqnum", "chr", "strand", "hits")

    def region(hits: list[dict]) -> tuple[R.Spans, str] | None:
        spans, seq = R.common([[(s["start"], s["end"]) for s in h["spans"]] for h in hits], R.bases(hits[0]["seq"] or ""))
        return (spans, R.marked(seq, spans)) if R.length(spans) >= least else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                sides = {m: [h[c] for h in row["hits"]] for m, c in (("a", "fwd"), ("b", "rev"), ("", "joined")) if row["hits"][0][c]}
                shared = {m: found for m, hits in sides.items() if (found := region(hits))}
                if len(shared) == 2:
                    up, down = sorted(x[0] for x in shared.values())
                    shared = shared if 0 < down[0][0] - up[-1][1] <= distance else {}
                elif len(sides) == 2 and not one_mate:
                    shared = {}
                for m, (spans, seq) in shared.items():
                    out.append((row["seqnum"], m, row["chr"], [{"start": s, "end": e} for s, e in spans], row["strand"], seq))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)

    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    names = {"seqnum": pa.int64(), "mate": pa.string(), "chr": pa.string(), "spans": spans, "strand": pa.string(), "seq": pa.string()}
    schema = pa.schema(list(names.items()))
    return groups.mapInArrow(run, f"seqnum long, mate string, chr string, spans {S.TYPE}, strand string, seq string")


def genome_classified(hits: DataFrame, distance: int = 500_000) -> tuple[DataFrame, DataFrame]:
    """(unique, ambiguous) of genome_hits: overlapping mates are one, a mate within the other adds nothing, no rescue."""
    return split_by_uniqueness(hits, 0, distance, rescue=False)


def transcript_classified(hits: DataFrame, least: int, distance: int = 500_000) -> tuple[DataFrame, DataFrame]:
    """(unique, ambiguous) of transcript_hits: mates fuse where their inner blocks agree, alternatives on one strand may share a region."""
    return split_by_uniqueness(hits, least, distance, one_strand=True, contained=False)


def spliced_classified(hits: DataFrame, least: int, distance: int = 500_000) -> tuple[DataFrame, DataFrame]:
    """(unique, ambiguous) of psl_hits: as transcript_classified, with a base of either mate given up to fuse, only the pairs of most
    covered bases, mates in the order of their mean coordinates, and one mate alone where only its alternatives share a region.

    With psl_hits' column lead, a read with hits of one mate only is unique where one of them has the best score alone; rows that
    have it come with the pair's strand, others with the hit's own."""
    if "lead" in hits.columns:
        hits = settled(hits)
        sides = hits.groupBy("seqnum").agg((F.count_distinct("mate") == 1).alias("_one"), F.max("lead").alias("_led"))
        hits = hits.join(sides, "seqnum").where(~(F.col("_one") & F.col("_led")) | F.col("lead")).drop("_one", "_led", "lead")
        hits = hits.withColumn("strand", Q.flipped(F.col("strand"), F.col("mate") == "b"))
    return split_by_uniqueness(hits, least, distance, one_mate=True, contained=False, repair=True, longest=True, by_mean=True)


def mates_of_joined(joined: DataFrame, sequences: DataFrame) -> DataFrame:
    """Both mates (a, b) of joined alignments: each read's longest stretch that begins, or ends, the joined sequence.

    joined: (seqnum, chr, spans, strand, seq); sequences: (seqnum, a_seq, b_seq) as sequenced. left and right are the read's bases
    before and behind that stretch, in the genome's direction; whole is the joined alignment's spans."""

    def stretch(read: str, whole: str) -> int:
        low, high = 0, min(len(read), len(whole))
        while low < high:  # a shorter start of the whole lies in the read wherever a longer one does
            mid = (low + high + 1) // 2
            low, high = (mid, high) if whole[:mid] in read else (low, mid - 1)
        return low

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = str.maketrans("ACGT", "TGCA")
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                spans, chars, inside = [(s["start"], s["end"]) for s in r["spans"]], [], []
                for k, part in enumerate(R.plain(r["seq"]).split("+")):
                    chars += part
                    inside += [k % 2 == 1] * len(part)
                whole, a, b = "".join(chars), r["a_seq"], r["b_seq"]
                up, down = ("a", a), ("b", b[::-1].translate(turn))
                if r["strand"] == "-":
                    up, down = ("b", b), ("a", a[::-1].translate(turn))
                n = stretch(up[1], whole)
                m = stretch(down[1][::-1], whole[::-1])
                for (mate, read), at, low, high in (
                    (up, up[1].find(whole[:n]), 0, n),
                    (down, len(down[1]) - m - down[1][::-1].find(whole[::-1][:m]), len(whole) - m, len(whole)),
                ):
                    first, last = low, high  # an insertion at the piece's end is clipped
                    while low < high and inside[low]:
                        low += 1
                    while low < high and inside[high - 1]:
                        high -= 1
                    own, _ = R.cut_front(spans, "", inside[:low].count(False))
                    own, _ = R.cut_back(own, "", R.length(own) - inside[low:high].count(False))
                    marks = "".join(f"+{''.join(x)}+" if on else "".join(x) for on, x in R.grouped(inside[low:high], chars[low:high]))
                    seq = R.with_insertions(R.marked(R.bases(marks), own), own, R.insertions(marks, own))
                    row = {"seqnum": r["seqnum"], "mate": mate, "chr": r["chr"], "strand": r["strand"], "seq": seq, "whole": r["spans"]}
                    row |= {"spans": [{"start": s, "end": e} for s, e in own], "left": at + low - first, "right": len(read) - at - (last - first) + last - high}
                    rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema)

    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    text = pa.string()
    schema = pa.schema(
        [("seqnum", pa.int64()), ("mate", text), ("chr", text), ("spans", spans), ("strand", text), ("seq", text), ("left", pa.int64()), ("right", pa.int64()), ("whole", spans)]
    )
    met = joined.select("seqnum", "chr", "spans", "strand", "seq").join(sequences, "seqnum")
    return met.mapInArrow(run, f"seqnum long, mate string, chr string, spans {S.TYPE}, strand string, seq string, left long, right long, whole {S.TYPE}")
