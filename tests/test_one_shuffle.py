"""Mates are paired where their read's hits were dealt out to; reads are counted per exon where both meet."""

import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from loomspan.functions import spans as S
from loomspan.operators import breakpoints, quantify, reads
from loomspan.queries import QUERIES

SF = "/root/testdata/sf0.001"


def hits_of(spark, data):
    df = spark.createDataFrame(data, "seqnum long, mate string, chr string, start long, end long, strand string")
    bases = F.repeat(F.lit("A"), (F.col("end") - F.col("start") + 1).cast("int")).alias("seq")
    return df.select("seqnum", "mate", "chr", F.array(S.span(F.col("start"), F.col("end"))).alias("spans"), "strand", bases)


def test_hits_are_shuffled_by_their_read_only(spark):
    hits = hits_of(spark, [(1, "a", "1", 1, 9, "+")])
    for options in ({}, {"longest": True, "by_mean": True}):
        plan = reads.classified(hits, **options)._jdf.queryExecution().executedPlan().toString()
        dealt = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)
        # both sides of the join read one shuffle of the hits; the other one is of the fragments
        assert len(dealt) <= 3 and all(re.fullmatch(r"seqnum#\d+L", keys) for keys in dealt), dealt


def test_classified_odd_hits(spark):
    data = [
        *[(1, "a", "1", 1, 50, "+")] * 3, *[(1, "b", "1", 30, 80, "-")] * 2, (1, "b", "1", 31, 50, "-"), (1, "b", "2", 60, 90, "-"), (1, "b", "1", 60, 90, "+"),
        (2, "a", None, 1, 9, "+"), (3, "a", None, 1, 9, "+"), (3, "b", None, 20, 29, "-"), (4, "", "1", 1, 9, "+"), (4, None, "1", 1, 9, "+"),
        (None, "a", "1", 1, 9, "+"), (5, "a", "1", 1, 9, None), (6, "a", "1", 1, 9, "+"), (6, "", "1", 1, 9, "+"),
        (7, "a", "1", 20, 29, "-"), (7, "b", "1", 1, 9, "+"), (7, "b", "1", 1, 9, "+"),
    ]
    show = lambda c: S.render(F.col(f"{c}.spans")).alias(c)
    of = lambda df: sorted((tuple(r) for r in df.select("seqnum", "chr", "strand", show("fwd"), show("rev"), show("joined"), "is_unique").collect()), key=str)
    single = [(2, None, "+", "1-9", None, None, True), (5, "1", None, "1-9", None, None, True), (6, "1", "+", "1-9", None, None, True)]
    pair = (7, "1", "-", "20-29", "1-9", None, True)
    # mates 31-50 and 30-80 make two alignments with 1-50
    assert of(reads.classified(hits_of(spark, data))) == [(1, "1", "+", None, None, "1-50", False), (1, "1", "+", None, None, "1-80", False), *single, pair]
    assert of(reads.classified(hits_of(spark, data), longest=True)) == [(1, "1", "+", None, None, "1-80", True), *single, pair]
    crowded = of(reads.classified(hits_of(spark, data), crowd=4))
    assert [r[-1] for r in crowded if r[0] == 1] == [False] * 5 and [r for r in crowded if r[0] != 1] == [*single, pair]


def shuffled(spark) -> int:
    """Rows that all stages so far have written to shuffles."""
    context, jvm = spark.sparkContext._jsc.sc(), spark._jvm
    context.listenerBus().waitUntilEmpty()
    some = jvm.java.util.ArrayList
    stages = context.statusStore().stageList(some(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), some())
    return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))


def test_exon_counts_shuffle_blocks_and_exons_once(spark):
    n, before = spark.read.parquet(f"{SF}/lineitem.parquet").count(), shuffled(spark)
    QUERIES["block_exon_counts"](spark, SF).write.format("noop").mode("overwrite").save()
    assert shuffled(spark) - before < 5 * n  # two blocks and two exons a row, and numbers of tiles


def test_exon_counts_of_far_and_crowded_exons(spark, monkeypatch):
    monkeypatch.setattr(breakpoints, "TOGETHER", 40)
    monkeypatch.setattr(breakpoints, "HOT", 1000)
    r, at = random.Random(4), 2 * breakpoints.TILE
    data, exons = [], [("1", at - 50, at + 50), ("1", 5, 4 * at), ("1", at + 9, at + 3), (None, 1, 2), ("1", None, 2)]
    for k in range(400):
        a = at + r.randrange(-60, 60)
        blocks = [(a, a + r.randrange(9))]
        for _ in range(r.randrange(3)):
            a = blocks[-1][1] + r.randrange(2, 6)
            blocks.append((a, a + r.randrange(9)))
        data.append((k % 90 or None, "1", blocks, r.random() < 0.6))
        exons += [("1", s - r.randrange(3), e + r.randrange(3)) for s, e in blocks]
    fits = lambda x, k, s, e: s <= x[k][0] and x[k][1] <= e and (k == 0 or x[k][0] == s) and (k == len(x) - 1 or x[k][1] == e)
    want = []
    for c, s, e in exons:
        met = {(read, sure) for read, chr, x, sure in data if c == chr and s is not None and any(fits(x, k, s, e) for k in range(len(x)))}
        want.append((c, s, e, sum(u for _, u in met), sum(not u for _, u in met)))
    frag = spark.createDataFrame(data, "seqnum long, chr string, spans array<struct<start:long,end:long>>, is_unique boolean")
    places = spark.createDataFrame(exons, "chr string, start long, end long")
    of = lambda df: sorted((tuple(x) for x in df.collect()), key=str)
    assert of(quantify.exon_counts(frag, places)) == sorted(want, key=str)
    assert of(quantify.exon_counts(frag, places, once=True)) == sorted(set(want), key=str)


def test_cells_are_cut_between_reads(monkeypatch):
    r, rows = random.Random(5), []
    for group in range(4):
        rows += [(group << breakpoints.READS, "1", 0, s, s + r.randrange(9), 0, None) for s in (r.randrange(30) for _ in range(40))]
        for read in range(1, 30):
            rows += [(group << breakpoints.READS | read, "1", 0, s, s + r.randrange(5), 1 + 2 * r.randrange(8), read) for s in (r.randrange(30) for _ in range(r.choice([1, 3, 60])))]
    table = pa.table(list(zip(*rows, strict=True)), names=["order", "_0", "tile", "s", "e", "kind", "read"])
    found = lambda size: sorted(
        tuple(x.values()) for b in breakpoints._compatible(iter(table.to_batches(size)), ["_0"], breakpoints.TILE, ["a", "b"], True) for x in b.to_pylist()
    )
    whole = found(10_000)
    assert len(whole) > 100 and sum(x[-1] + x[-2] for x in whole) > 1000
    for name, few in (("INDEXED", 50), ("CANDIDATES", 64), ("DISTINCT", 32)):
        monkeypatch.setattr(breakpoints, name, few)
    assert found(7) == whole
