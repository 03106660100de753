"""Two sources of unique hits for the same reads made one: genome with transcriptome, and two aligners.

A read's state in a source is joined (mates fused), pair, single or none; each of the fifteen combinations has a rule.
Both sources are one row per read after a map-side-combined aggregation and meet in one full outer join on the read."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.functions import fragments as R
from loomspan.functions import spans as S
from loomspan.operators.reads import excluded

_HIT = "struct<chr: string, spans: array<struct<start: bigint, end: bigint>>, strand: string, seq: string>"
_OUT = f"seqnum long, mate string, chr string, spans {S.TYPE}, strand string, seq string, verdict string"
_ARROW = pa.schema(
    [
        ("seqnum", pa.int64()),
        ("mate", pa.string()),
        ("chr", pa.string()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("strand", pa.string()),
        ("seq", pa.string()),
        ("verdict", pa.string()),
    ]
)


def by_read(hits: DataFrame, tag: str) -> DataFrame:
    """(seqnum, tag_j, tag_a, tag_b): the joined, forward and reverse hit of each read; of several the least."""
    hit = F.struct("chr", "spans", "strand", "seq")
    pick = lambda m: F.min(F.when(F.col("mate") == m, hit))
    return hits.groupBy("seqnum").agg(pick("").alias(f"{tag}_j"), pick("a").alias(f"{tag}_a"), pick("b").alias(f"{tag}_b"))


def state(tag: str) -> Column:
    """-1 joined, 2 pair, 1 single, 0 none."""
    j, a, b = (F.col(f"{tag}_{m}").isNotNull() for m in "jab")
    return F.when(j, -1).when(a & b, 2).when(a | b, 1).otherwise(0)


class _Side:
    """One source's hits of a read, with spans as tuples and sequences without marks."""

    def __init__(self, row: dict, tag: str):
        hits = {m: row[f"{tag}_{m}"] for m in "jab"}
        self.hits = {
            m: h | {"spans": [(s["start"], s["end"]) for s in h["spans"]], "raw": h["seq"] or "", "seq": R.bases(h["seq"] or "")} for m, h in hits.items() if h is not None
        }
        if "j" in self.hits:
            self.hits, self.state = {"j": self.hits["j"]}, -1
        else:
            self.state = len(self.hits)

    def rows(self, verdict: str) -> list[tuple]:
        return [(m, h, verdict) for m, h in sorted(self.hits.items())]


def _agree(x: dict, y: dict, least: int, equal: bool = False) -> bool:
    n = R.length(R.common([x["spans"], y["spans"]], x["seq"])[0])
    return x["chr"] == y["chr"] and (n >= least if equal else n > least)


def _mates(a: dict, b: dict, distance: int) -> list[tuple]:
    """A forward and a reverse hit of two sources: both if they follow each other, fused if they overlap, else nothing."""
    if a["chr"] != b["chr"] or a["strand"] != b["strand"]:
        return []
    a_first = a["strand"] == "+"
    up, down = (a, b) if a_first else (b, a)
    gap = down["spans"][0][0] - up["spans"][-1][1]
    if gap > 1:
        return [("a", a, "unique"), ("b", b, "unique")] if gap < distance else []
    if up["spans"][0][0] > down["spans"][-1][1]:
        return []
    found = R.fused_mates((a["spans"], a["seq"]), (b["spans"], b["seq"]), a_first)
    if not found:
        return []
    seq = R.with_insertions(R.marked(found[1], found[0]), found[0], R.insertions(a["raw"], a["spans"]) | R.insertions(b["raw"], b["spans"]))
    return [("j", a | {"spans": found[0], "raw": seq}, "unique")]


def genome_rule(g: _Side, t: _Side, least: int, paired: bool, distance: int) -> list[tuple]:
    """Genome (g) against transcriptome (t): the transcriptome's where both agree, contradictions where they don't."""
    both = g.rows("contradictory") + t.rows("contradictory")
    if not g.state or not t.state:
        return (t if not g.state else g).rows("unique")
    if (g.state, t.state) == (-1, -1):
        return t.rows("unique") if _agree(g.hits["j"], t.hits["j"], least) else both
    if (g.state, t.state) == (1, 1):
        (m, x), (k, y) = *g.hits.items(), *t.hits.items()
        if m != k:
            return _mates(*((x, y) if m == "a" else (y, x)), distance)
        if _agree(x, y, least):
            return t.rows("unique")
        return [] if paired else both
    if (g.state, t.state) == (2, 2):
        return t.rows("unique") if all(_agree(g.hits[m], t.hits[m], least) for m in "ab") else both
    if (g.state, t.state) == (-1, 2):
        return both
    if (g.state, t.state) == (2, -1):
        return t.rows("unique") if all(_agree(g.hits[m], t.hits["j"], least, equal=True) for m in "ab") else both
    if -1 in (g.state, t.state):
        return (g if g.state == -1 else t).rows("unique")
    return (g if g.state == 2 else t).rows("unique")


def aligner_rule(w: _Side, l: _Side, least: int, paired: bool, distance: int) -> list[tuple]:  # noqa: E741
    """A short-read aligner (w) against one that splits reads (l): the first's unless the second says clearly more."""
    if not w.state or not l.state:
        return (l if not w.state else w).rows("unique")
    if (w.state, l.state) == (1, 1):
        (m, x), (k, y) = *w.hits.items(), *l.hits.items()
        if m != k:
            return _mates(*((x, y) if m == "a" else (y, x)), distance)
        more = R.length(x["spans"]) - R.length(y["spans"])
        if abs(more) > 3:
            return (w if more > 0 else l).rows("unique")
        return w.rows("unique") if _agree(x, y, least) else w.rows("ambiguous") + l.rows("ambiguous")
    if w.state == 1:
        return l.rows("unique")
    return w.rows("unique")


def _resolved(left: DataFrame, right: DataFrame, rule: Callable, least: int | str, paired: bool, distance: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                out = []
                for row in batch.slice(at, 2000).to_pylist():
                    x, y = _Side(row, "x"), _Side(row, "y")
                    longest = max((R.length(h["spans"]) for s in (x, y) for h in s.hits.values()), default=0)
                    for mate, hit, verdict in rule(x, y, least_overlap(longest) if least == "v" else least, paired, distance):
                        spans = [{"start": s, "end": e} for s, e in hit["spans"]]
                        out.append((row["seqnum"], "" if mate == "j" else mate, hit["chr"], spans, hit["strand"], hit["raw"], verdict))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(_ARROW)], schema=_ARROW)

    return by_read(left, "x").join(by_read(right, "y"), "seqnum", "full_outer").mapInArrow(run, _OUT)


def least_overlap(read_length: int) -> int:
    """Bases that two alignments of a read must share to agree."""
    base = 35 if read_length < 80 else 45
    return int(0.6 * read_length) if base >= 0.8 * read_length else base


def genome_and_transcriptome(
    gu: DataFrame, tu: DataFrame, ambiguous: DataFrame, least: int | str = "v", paired: bool = True, distance: int = 500_000
) -> DataFrame:
    """Unique hits of both, less reads that either calls ambiguous, with verdict unique or contradictory.

    least: shared bases needed to agree, "v": by each read's own length."""
    return _resolved(excluded(gu, ambiguous), excluded(tu, ambiguous), genome_rule, least, paired, distance)


def two_aligners(
    first: DataFrame, second: DataFrame, first_nu: DataFrame, second_nu: DataFrame, least: int | str = "v", paired: bool = True, distance: int = 500_000
) -> DataFrame:
    """Unique hits of both with verdict unique or ambiguous; the second's ambiguous hits stay, unless rescued.

    Reads that the first calls ambiguous go from its unique ones. Where the second has no unique hit, a single mate of the first
    is unique only if none of the second's ambiguous hits is joined or of the same mate; and if they are of the other mate alone and exactly one
    of them pairs with it, both are unique and the read's ambiguous hits go."""
    first, second = excluded(first, first_nu), excluded(second, first_nu)
    own = second_nu.select("seqnum", F.col("mate").alias("_o")).distinct()
    mates = first.groupBy("seqnum").agg(F.count(F.lit(1)).alias("_n"), F.min("mate").alias("_m")).where("_n = 1 and _m <> ''")
    doubt = mates.join(own, "seqnum").where("_o in (_m, '')").select("seqnum").distinct()
    doubt = excluded(doubt, second)
    pairs = rescued(excluded(excluded(first, doubt), second), second_nu, distance)
    done = pairs.select("seqnum").distinct()
    out = _resolved(excluded(excluded(first, done), doubt), excluded(second, done), aligner_rule, least, paired, distance)
    columns = ["seqnum", "mate", "chr", "spans", "strand", "seq"]
    kept = excluded(second_nu, done).unionByName(first_nu).select(*columns, F.lit("ambiguous").alias("verdict"))
    return out.unionByName(pairs.select(*columns, F.lit("unique").alias("verdict"))).unionByName(kept)


def rescued(single: DataFrame, ambiguous: DataFrame, distance: int = 500_000) -> DataFrame:
    """Both rows of single-mate hits that pair with exactly one of the other mate's ambiguous hits."""
    lone = single.join(single.groupBy("seqnum").agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").select("seqnum"), "seqnum", "left_semi")
    lone = lone.where("mate in ('a', 'b')")
    other = ambiguous.where("mate in ('a', 'b')").select(
        "seqnum", "chr", "strand", F.col("mate").alias("o_mate"), F.col("spans").alias("o_spans"), F.col("seq").alias("o_seq")
    )
    met = lone.join(other.distinct(), ["seqnum", "chr", "strand"]).where("mate <> o_mate")
    first = (F.col("mate") == "a") == (F.col("strand") == "+")
    up, down = F.when(first, F.col("spans")).otherwise(F.col("o_spans")), F.when(first, F.col("o_spans")).otherwise(F.col("spans"))
    gap = S.first_start(down) - S.last_end(up)
    met = met.where((gap > 0) & (gap < distance))
    one = met.join(met.groupBy("seqnum").agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").select("seqnum"), "seqnum", "left_semi")
    theirs = one.select("seqnum", F.col("o_mate").alias("mate"), "chr", F.col("o_spans").alias("spans"), "strand", F.col("o_seq").alias("seq"))
    return one.select("seqnum", "mate", "chr", "spans", "strand", "seq").unionByName(theirs)


def demoted(hits: DataFrame, least: int, one_strand: bool = False) -> DataFrame:
    """One row per read whose alternative hits (one chromosome, one strand if asked) share a region of `least` bases: that region."""
    kinds = [F.count_distinct("chr").alias("_c"), F.count_distinct("strand").alias("_s"), F.collect_list(F.struct("spans", "seq")).alias("_hits")]
    groups = hits.groupBy("seqnum", "mate").agg(*kinds, F.min("chr").alias("chr"), F.min("strand").alias("strand"))
    groups = groups.where("_c = 1" + " and _s = 1" * one_strand).select("seqnum", "mate", "chr", "strand", F.array_sort("_hits").alias("_hits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                lists = [[(s["start"], s["end"]) for s in h["spans"]] for h in row["_hits"]]
                spans, seq = R.common(lists, R.plain(row["_hits"][0]["seq"] or ""))
                if R.length(spans) >= least:
                    out.append((row["seqnum"], row["mate"], row["chr"], [{"start": s, "end": e} for s, e in spans], row["strand"], R.marked(seq, spans), "unique"))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(_ARROW)], schema=_ARROW)

    return groups.mapInArrow(run, _OUT)
