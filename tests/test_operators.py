import random

import pytest
from pyspark.sql import functions as F

from loomspan.functions import spans as S
from loomspan.operators import coverage, genes, intervals, junctions, quantify, reads, reconcile, sam, text


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_sweep_vector(spark):
    df = spark.createDataFrame([("1", 5, 10, 1), ("1", 8, 15, 2), ("1", 14, 19, 7)], "chr string, start long, end long, w long")
    for tile in (1 << 16, 4):
        out = coverage.sweep(df, ["chr"], weight=F.col("w"), tile=tile)
        assert sorted((r.start, r.end, r.cov) for r in out.collect()) == [(5, 8, 1), (8, 10, 3), (10, 14, 2), (14, 15, 9), (15, 19, 7)]


def test_coverage_sums_to_span_lengths(spark):
    rng = random.Random(1)
    data = [(f"c{rng.randint(0, 2)}", a := rng.randint(0, 500), a + rng.randint(1, 60)) for _ in range(300)]
    df = spark.createDataFrame(data, "chr string, start long, end long")
    out = coverage.sweep(df, ["chr"], tile=64).agg(F.sum((F.col("end") - F.col("start")) * F.col("cov"))).first()[0]
    assert out == sum(e - s for _, s, e in data)
    halves = [coverage.sweep(df.where(f"start % 2 = {k}"), ["chr"]) for k in (0, 1)]
    assert rows(coverage.merged(halves), "chr", "start", "end", "cov") == rows(coverage.sweep(df, ["chr"]), "chr", "start", "end", "cov")
    assert coverage.validated(coverage.sweep(df, ["chr"])).count() == 0


def test_coverage_over_spans(spark):
    cov = spark.createDataFrame([("1", 5, 10, 3), ("1", 12, 20, 1)], "chr string, start long, end long, cov long")
    spans = spark.createDataFrame([("1", 4, 14), ("1", 30, 35)], "chr string, start long, end long")
    assert rows(coverage.over_spans(spans, cov, cutoff=1), "start", "covered_sum", "below") == [(30, 0, 5), (4, 17, 3)]
    assert rows(coverage.over_spans(spans, cov, cutoff=2), "start", "below") == [(30, 5), (4, 5)]


def test_overlap_vector(spark):
    names = {"a": (1, 9), "b": (10, 20), "c": (15, 30)}
    places = spark.createDataFrame([("1", n, s, e) for n, (s, e) in names.items()], "chr string, id string, f_start long, f_end long")
    asked = spark.createDataFrame([("1", 0, 50), ("1", 8, 9), ("1", 8, 10), ("1", 100, 110)], "chr string, start long, end long")
    found = intervals.overlap_join(asked, places, ["chr"], tile=8)
    assert rows(found, "start", "end", "id") == [(0, 50, "a"), (0, 50, "b"), (0, 50, "c"), (8, 10, "a"), (8, 10, "b"), (8, 9, "a")]
    assert rows(intervals.overlap_join(asked, places, ["chr"], how="left_anti"), "start") == [(100,)]


def test_overlap_join_is_plain_join(spark):
    rng = random.Random(2)
    make = lambda n: [(rng.randint(0, 2), a := rng.randint(0, 3000), a + rng.randint(0, 400)) for _ in range(n)]
    a, b = make(150), make(100)
    x = spark.createDataFrame(a, "chr int, start long, end long")
    y = spark.createDataFrame(b, "chr int, f_start long, f_end long")
    want = sorted((c, s, e, fs, fe) for c, s, e in a for d, fs, fe in b if c == d and s <= fe and fs <= e)
    got = sorted(map(tuple, intervals.overlap_join(x, y, ["chr"], tile=100).select("chr", "start", "end", "f_start", "f_end").collect()))
    assert got == want


def test_islands(spark):
    data = [(1, 1, 5), (1, 4, 9), (1, 9, 12), (1, 20, 25), (2, 1, 2)]
    df = spark.createDataFrame(data, "chr int, start long, end long")
    for tile in (1 << 20, 4):
        assert rows(intervals.islands(df, ["chr"], tile=tile), "chr", "start", "end", "n") == [(1, 1, 12, 3), (1, 20, 25, 1), (2, 1, 2, 1)]


def test_contained_removed(spark):
    df = spark.createDataFrame([(1, 1, 300), (1, 10, 50), (1, 200, 250), (1, 205, 240)], "chr int, start long, end long")
    assert rows(intervals.contained_removed(df, ["chr"]), "start") == [(10,), (200,), (205,)]


HIT = "seqnum long, mate string, chr string, t string, strand string, seq string"


def hits(spark, data):
    return spark.createDataFrame(data, HIT).select("seqnum", "mate", "chr", S.parse(F.col("t")).alias("spans"), "strand", "seq")


def test_multiplicity(spark):
    data = [(1, "a", "1", "1-2", "+", "AC"), (1, "a", "2", "1-2", "+", "AC"), (1, "b", "1", "5-6", "+", "AC"), (2, "", "1", "1-2", "+", "AC")]
    df = hits(spark, data)
    assert rows(reads.limited(df, 1), "seqnum") == [(2,)]
    assert len(rows(reads.limited(df, 2), "seqnum")) == 4
    assert rows(reads.separated(df, ["chr"]), "seqnum", "chr", "is_unique") == [(1, "1", False), (1, "2", False), (2, "1", True)]
    assert rows(reads.multiplicity_histogram(df.drop("mate")), "num_locs", "num_reads") == [(1, 1), (3, 1)]


def test_classified(spark):
    data = [
        (1, "a", "1", "100-120", "+", "A" * 21), (1, "b", "1", "200-220", "-", "C" * 21),
        (1, "b", "1", "900000-900020", "-", "C" * 21),
        (2, "a", "1", "1-9", "+", "A" * 9), (2, "a", "2", "1-9", "+", "A" * 9),
        (3, "b", "1", "5-9", "-", "G" * 5),
        (4, "a", "1", "1-50", "+", "A" * 50), (4, "b", "1", "30-80", "-", "C" * 51),
        (5, "a", "1", "30-80", "-", "A" * 51), (5, "b", "1", "1-50", "+", "C" * 50),
        (6, "a", "1", "1-50", "+", "A" * 50), (6, "b", "2", "30-80", "-", "C" * 51),
        (7, "a", "1", "1-10, 20-30", "+", "A" * 21), (7, "b", "1", "5-12, 20-35", "-", "C" * 24),
    ]
    show = lambda c: S.render(F.col(f"{c}.spans")).alias(c)
    out = reads.classified(hits(spark, data)).select("seqnum", "is_unique", show("fwd"), show("rev"), show("joined"), "joined.seq")
    assert rows(out, "seqnum", "is_unique", "fwd", "rev", "joined") == [
        (1, True, "100-120", "200-220", None), (2, False, "1-9", None, None), (2, False, "1-9", None, None), (3, True, None, "5-9", None),
        (4, True, None, None, "1-80"), (5, True, None, None, "1-80"),
    ]
    assert {r.seqnum: r.seq for r in out.collect() if r.joined} == {4: "A" * 50 + "C" * 30, 5: "C" * 50 + "A" * 30}
    crowded = reads.classified(hits(spark, data), crowd=2)
    assert rows(crowded.where("seqnum = 1"), "is_unique") == [(False,)] * 3


def test_pairs_of_most_bases(spark):
    data = [(1, "a", "1", "1-50", "+", "A" * 50), (1, "b", "1", "30-80", "-", "C" * 51), (1, "b", "1", "500-520", "-", "C" * 21)]
    assert reads.classified(hits(spark, data)).count() == 2
    # the joined one covers 80 bases, the pair 71
    assert rows(reads.classified(hits(spark, data), longest=True), "is_unique") == [(True,)]


def test_places_of_pairs(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (1, "b"), (2, ""), (2, "a"), (3, "b")], "seqnum long, mate string")
    assert rows(reads.multiplicity_histogram(df), "num_locs", "num_reads") == [(1, 1), (2, 2)]


def test_mapping_statistics(spark):
    u = spark.createDataFrame([(1, "a"), (1, "b"), (2, ""), (3, "a")], "seqnum long, mate string")
    n = spark.createDataFrame([(5, "b"), (5, "b")], "seqnum long, mate string")
    r = reads.mapping_statistics(u, n, 10).first()
    assert (r.unique_joined, r.unique_both, r.unique_forward_only, r.ambiguous_reverse_only, r.mapped, r.mapped_percent) == (1, 1, 1, 1, 4, 40.0)


@pytest.mark.parametrize(
    "g, t, want",
    [
        ([], [("a", "1-50")], {("a", "unique", "1-50")}),
        ([("a", "1-50")], [], {("a", "unique", "1-50")}),
        ([("", "1-50")], [("", "3-52")], {("", "unique", "3-52")}),
        ([("", "1-50")], [("", "40-90")], {("", "contradictory", "1-50"), ("", "contradictory", "40-90")}),
        ([("a", "1-50")], [("a", "2-51")], {("a", "unique", "2-51")}),
        ([("a", "1-50")], [("a", "300-349")], set()),
        ([("a", "1-50")], [("b", "100-149")], {("a", "unique", "1-50"), ("b", "unique", "100-149")}),
        ([("a", "1-50")], [("b", "40-89")], {("", "unique", "1-89")}),
        ([("a", "1-50"), ("b", "99-148")], [("a", "2-51"), ("b", "99-148")], {("a", "unique", "2-51"), ("b", "unique", "99-148")}),
        ([("", "1-90")], [("a", "1-50")], {("", "unique", "1-90")}),
        ([("a", "1-50")], [("a", "1-50"), ("b", "80-129")], {("a", "unique", "1-50"), ("b", "unique", "80-129")}),
    ],
)
def test_genome_and_transcriptome(spark, g, t, want):
    make = lambda data: hits(spark, [(1, m, "1", s, "+", "A" * sum(int(x.split("-")[1]) - int(x.split("-")[0]) + 1 for x in s.split(", "))) for m, s in data])
    out = reconcile.genome_and_transcriptome(make(g), make(t), make([]), least=20)
    assert {(r.mate, r.verdict, r.s) for r in out.select("mate", "verdict", S.render(F.col("spans")).alias("s")).collect()} == want


def test_two_aligners(spark):
    first = hits(spark, [(1, "a", "1", "1-50", "+", "A" * 50), (2, "a", "1", "1-50", "+", "A" * 50), (3, "a", "1", "1-50", "+", "A" * 50)])
    second = hits(spark, [(1, "a", "1", "1-60", "+", "A" * 60), (2, "a", "2", "1-50", "+", "A" * 50)])
    nu = hits(spark, [(3, "b", "1", "100-149", "+", "C" * 50), (3, "b", "2", "100-149", "+", "C" * 50)])
    out = reconcile.two_aligners(first, second, hits(spark, []), nu, least=20)
    got = {(r.seqnum, r.mate, r.verdict, r.s) for r in out.select("seqnum", "mate", "verdict", S.render(F.col("spans")).alias("s")).collect()}
    assert got == {
        (1, "a", "unique", "1-60"),
        (2, "a", "ambiguous", "1-50"),
        (3, "a", "unique", "1-50"),
        (3, "b", "unique", "100-149"),
    }


def test_insertions_survive_fusing(spark):
    g = hits(spark, [(1, "a", "1", "1-10", "+", "AAAAA+GG+AAAAA")])
    t = hits(spark, [(1, "b", "1", "8-17", "+", "AAACC+T+CCCCC")])
    out = reconcile.genome_and_transcriptome(g, t, hits(spark, []), least=5)
    assert [(r.mate, r.seq) for r in out.collect()] == [("", "AAAAA+GG+AAAAACC+T+CCCCC")]


def test_demoted(spark):
    df = hits(spark, [(1, "a", "1", "1-50", "+", "A" * 50), (1, "a", "1", "5-60", "+", "A" * 56), (2, "a", "1", "1-5", "+", "AAAAA"), (2, "a", "2", "1-5", "+", "AAAAA")])
    assert rows(reconcile.demoted(df, 20).withColumn("s", S.render(F.col("spans"))), "seqnum", "s") == [(1, "5-50")]


def test_features_and_counts(spark):
    models = spark.createDataFrame([("1", "-", "10-20, 31-40", "g")], "chr string, strand string, t string, id string")
    models = models.select("chr", "strand", S.parse(F.col("t")).alias("exons"), "id")
    feats = quantify.features_of(models)
    assert rows(feats, "feature_type", "start", "end", "ordinal") == [
        ("exon", 10, 20, 2), ("exon", 31, 40, 1), ("intron", 21, 30, 1), ("transcript", 10, 40, 0)
    ]
    frag = spark.createDataFrame([(1, "1", "15-20, 31-34", "-", True), (2, "1", "25-27", "-", False)], "seqnum long, chr string, t string, strand string, is_unique boolean")
    frag = frag.withColumn("spans", S.parse(F.col("t")))
    out = quantify.feature_counts(frag, feats)
    assert rows(out, "feature_type", "start", "ucount", "nucount") == [("exon", 10, 1, 0), ("exon", 31, 1, 0), ("intron", 21, 0, 1), ("transcript", 10, 1, 1)]
    assert rows(quantify.feature_counts(frag, feats, strand="+"), "start") == []
    assert quantify.read_total(frag).first()[0] == 2
    ex = feats.where("feature_type = 'exon'")
    assert rows(quantify.exon_counts(frag, ex), "start", "ucount") == [(10, 1), (31, 1)]


def test_exon_counts_of_mates(spark):
    frag = spark.createDataFrame(
        [
            (1, "a", "10-30", True), (1, "b", "50-70", True),  # both fit 1-100 and nothing else
            (2, "b", "10-30", True), (2, "a", "80-120", True),  # the second contradicts 1-100
            (3, "a", "60-100, 201-220", True), (3, "b", "250-300, 401-410", True),  # facing blocks fit 201-300, the outer ones their own
            (4, "a", "10-30", False), (4, "b", "402-410", False),  # neither reaches the other's exon
            (5, "", "10-30", True), (6, "a", "5-9", True),
            (7, "a", "10-40", True), (7, "b", "30-60", True),  # overlapping: one read of 10-60
        ],
        "seqnum long, mate string, t string, is_unique boolean",
    )
    frag = frag.select("seqnum", "mate", F.lit("1").alias("chr"), S.parse(F.col("t")).alias("spans"), "is_unique")
    exons = spark.createDataFrame([("1", 1, 100), ("1", 201, 300), ("1", 401, 450), ("1", 1, 45)], "chr string, start long, end long")
    got = rows(quantify.exon_counts(frag, exons), "start", "end", "ucount", "nucount")
    # 1-45: read 1's and 2's other mates lie beyond it, 7's 10-60 does not fit
    assert got == [(1, 100, 5, 1), (1, 45, 4, 1), (201, 300, 1, 0), (401, 450, 1, 1)]
    assert quantify.read_total(frag).first()[0] == 7


def test_genes(spark):
    models = spark.createDataFrame([("1", "x", "r"), ("1", "y", "e"), ("2", "x", "r")], "chr string, name string, type string")
    assert rows(genes.merged(models, ["chr"]), "chr", "id") == [("1", "x(r)::::y(e)"), ("2", "x(r)")]
    info = spark.createDataFrame([("y", "why"), ("x", "ex")], "id string, info string")
    assert rows(genes.annotated(genes.merged(models, ["chr"]), info), "chr", "info") == [("1", "ex"), ("2", "ex")]


GENOME = "ACGTACGTGT" + "AAAAAAAAAAAAAAAAAAAG" + "CCCCCGGGGG"


def genome(spark):
    return spark.createDataFrame([("1", GENOME)], "chr string, seq string")


def test_junctions(spark):
    chunks = junctions.genome_chunks(genome(spark), size=8)
    a = spark.createDataFrame([(1, "1", "1-8, 31-38", True), (2, "1", "5-8, 31-34", False)], "seqnum long, chr string, t string, is_unique boolean")
    a = a.withColumn("spans", S.parse(F.col("t")))
    r = junctions.called(a, chunks).first()
    assert (r.start, r.end, r.strand, r.score, r.known, r.long_overlap_unique_reads, r.short_overlap_nu_reads) == (9, 30, "+", 1, 0, 1, 1)
    bed = junctions.to_bed(junctions.called(a, chunks)).first()
    assert (bed.start0, bed.end, bed.rgb, bed.block_sizes, bed.block_starts) == (0, 80, "0,0,128", "8,50", "0,30")


def test_junctions_without_a_signal(spark):
    # the intron may lie one base to the left, or right, at either end of chromosome 1; chromosome 2's has a signal one to the left
    text = {"1": "CCCCCCCCCC" + "C" * 40 + "CCCCCCCCCC", "2": "ACGTTACCGG" + "TAAAA" + "C" * 28 + "TAGA" + "TTTTTTTTTT" + "CCC"}
    text["2"] = "ACGTTACCGG" + "TA" + "C" * 33 + "CAGG" + "TTTTTTTTTT"
    chunks = junctions.genome_chunks(spark.createDataFrame(list(text.items()), "chr string, seq string"), size=16)
    seq = lambda c, *spans: ":".join(text[c][a - 1 : b] for a, b in spans)
    a = [(1, "1", "1-10, 51-60", "+", True, seq("1", (1, 10), (51, 60))), (2, "2", "1-10, 50-59", "-", True, "x"), (3, "1", "1-10, 21-30", "+", True, "C" * 10 + ":+A+" + "C" * 10)]
    rows_ = spark.createDataFrame(a, "seqnum long, chr string, t string, strand string, is_unique boolean, seq string").withColumn("spans", S.parse(F.col("t")))
    out = junctions.called(rows_, chunks)
    assert rows(out, "chr", "start", "end", "strand", "score", "ambiguous") == [
        ("1", 10, 49, ".", 0, 1), ("1", 11, 50, ".", 0, 1), ("1", 12, 51, ".", 0, 1), ("2", 10, 48, "+", 1, 0)
    ]
    assert rows(junctions.called(rows_, chunks, strand="-"), "chr", "score") == [("2", 1)]
    assert junctions.called(rows_, chunks, shortest=60).count() == 0


def test_overlap_counts_all_blocks_of_a_side(spark):
    a = spark.createDataFrame([(1, "1", "1-6, 31-36, 61-70", True)], "seqnum long, chr string, t string, is_unique boolean").withColumn("spans", S.parse(F.col("t")))
    chunks = junctions.genome_chunks(spark.createDataFrame([("1", "A" * 80)], "chr string, seq string"))
    out = junctions.called(a, chunks, long=8).where("start in (7, 37)")
    assert rows(out, "start", "long_overlap_unique_reads", "short_overlap_unique_reads") == [(37, 1, 0), (7, 0, 1)]


def test_islands_over_many_tiles(spark):
    rng = random.Random(9)
    data = [(rng.randint(0, 1), a := rng.randint(0, 400), a + rng.choice([0, 3, 9, 150])) for _ in range(60)]
    df = spark.createDataFrame(data, "chr int, start long, end long")
    want = intervals._runs(df, ["chr"], "start", "end", 2, F.lit(1))
    for tile in (5, 64):
        assert rows(intervals.islands(df, ["chr"], gap=2, tile=tile), "chr", "start", "end", "n") == rows(want, "chr", "start", "end", "n")


def test_rescued_pairs(spark):
    from loomspan.operators import hits as H

    two = lambda n, a, b: [(n, "a", "1", a, "+", "A" * (int(a.split("-")[1]) - int(a.split("-")[0]) + 1)), (n, "b", "1", b, "-", "C" * (int(b.split("-")[1]) - int(b.split("-")[0]) + 1))]
    data = [*two(1, "1-50", "200-250"), *two(1, "5-60", "210-260"), *two(2, "1-50", "200-250"), (2, "a", "1", "60-110", "+", "A" * 51)]
    unique, rest = H.transcript_classified(hits(spark, data), 20)
    assert rows(unique.withColumn("s", S.render(F.col("spans"))), "seqnum", "mate", "s") == [(1, "a", "5-50"), (1, "b", "210-250")]
    assert {r.seqnum for r in rest.collect()} == {2}
    unique, rest = H.spliced_classified(hits(spark, data), 20)
    assert (2, "b", "200-250") in rows(unique.withColumn("s", S.render(F.col("spans"))), "seqnum", "mate", "s")


def test_inferred_exons(spark):
    j = "chr string, start long, end long, score long, known int"
    df = spark.createDataFrame([("1", 50, 99, 30, 0), ("1", 151, 200, 30, 0), ("1", 60, 120, 2, 0)], j)
    cov = spark.createDataFrame([("1", 99, 150, 4)], "chr string, start long, end long, cov long")
    known = spark.createDataFrame([("1", 100, 150)], "chr string, start long, end long")
    assert rows(junctions.inferred_exons(df, cov, known), "start", "end", "is_known") == [(100, 150, True)]
    assert rows(junctions.trusted(df), "start") == [(151,), (50,)]


def test_sam_round_trip(spark):
    r = spark.createDataFrame([(1, "ACGTAC", "TTTT"), (2, "GGGG", "CCCC")], "seqnum long, a_seq string, b_seq string")
    al = hits(spark, [(1, "a", "1", "10-12, 50-52", "+", "ACG:TAC"), (1, "b", "1", "70-73", "+", "AAAA")])
    out = sam.to_sam(r, al)
    by = {(x.qname, x.flag & 192): x for x in out.collect()}
    assert (by["seq.1", 64].flag, by["seq.1", 64].cigar, by["seq.1", 64].tlen, by["seq.1", 64].mapq) == (99, "3M37N3M", 64, 25)
    assert (by["seq.1", 128].flag, by["seq.1", 128].seq, by["seq.1", 128].tlen) == (147, "AAAA", -64)
    assert by["seq.2", 64].flag == 77 and by["seq.2", 64].cigar == "*" and by["seq.2", 128].rnext == "="
    back = sam.from_sam(out)
    assert rows(back.withColumn("s", S.render(F.col("spans"))), "seqnum", "mate", "s", "strand", "is_unique") == [
        (1, "a", "10-12, 50-52", "+", True), (1, "b", "70-73", "+", True)
    ]
    assert sam.suppressed(out).count() == 2


def test_sam_pairs_and_tags(spark):
    text = "ACGTACGTAC" + "GT" + "C" * 36 + "AG" + "TTTTTGGGGG" + "A" * 40
    chunks = junctions.genome_chunks(spark.createDataFrame([("1", text)], "chr string, seq string"), size=16)
    fwd, turn = text[4:10] + text[50:54], lambda x: x[::-1].translate(str.maketrans("ACGT", "TGCA"))
    al = hits(spark, [
        (1, "a", "1", "5-10, 51-54", "+", "ACGTAC:TTTT"), (1, "b", "1", "56-60", "+", "GGGGG"),
        (2, "a", "1", "61-64", "+", "AAAA"), (2, "a", "1", "81-84", "-", "AAAA"), (2, "b", "1", "71-74", "+", "AAAA"), (2, "b", "1", "76-79", "-", "AAAA"),
        (3, "", "1", "51-60", "+", "TTTTT+CC+GGGGG"), (4, "b", "1", "51-54", "+", "TTTT"),
    ])
    reads_ = [(1, "T" + fwd, turn("GGGGG"), "ABCDEFGHIJK", "12345", "x/1"), (2, "AAAA", turn("AAAA"), None, None, None),
              (3, "TTTTTCCG", turn("TCCGGGGG"), None, None, None), (4, "GATTACA", turn("TTTA"), None, None, None)]
    r = spark.createDataFrame(reads_, "seqnum long, a_seq string, b_seq string, a_qual string, b_qual string, a_name string")
    out = sam.to_sam(r, al, chunks).collect()
    by = {(x.qname, x.flag & 192, next((t for t in x.tags if t.startswith("HI")), "")): x for x in out}
    x, y = by["x/1", 64, "HI:i:1"], by["x/1", 128, "HI:i:1"]
    assert (x.cigar, x.qual, set(x.tags)) == ("1S6M40N4M", "ABCDEFGHIJK", {"XO:A:F", "MD:Z:10", "NM:i:0", "IH:i:1", "HI:i:1", "XS:A:+"})
    assert (y.pos, y.qual, y.seq, y.pnext, y.tlen) == (56, "54321", "GGGGG", 5, -56)
    # pairs by strand and order, not by place
    two = sorted((q.pos, q.pnext, q.flag, q.mapq) for q in out if q.qname == "seq.2")
    assert two == [(61, 71, 99, 0), (71, 61, 147, 0), (76, 81, 163, 0), (81, 76, 83, 0)]
    assert {(q.flag & 192, q.cigar, q.pos) for q in out if q.qname == "seq.3"} == {(64, "5M2I1M", 51), (128, "1M2I5M", 55)}
    assert all("XO:A:T" in q.tags and "NM:i:2" in q.tags for q in out if q.qname == "seq.3")
    lone = {q.flag & 192: q for q in out if q.qname == "seq.4"}
    assert lone[64].cigar == "*" and lone[64].pos == 51 and lone[64].flag & 12 == 4 and lone[128].cigar == "4M" and lone[128].flag & 12 == 8
    back = sam.from_sam(sam.to_sam(r.drop("a_name"), al, chunks), fuse=True).withColumn("s", S.render(F.col("spans")))
    assert rows(back.where("seqnum <> 2"), "seqnum", "mate", "s", "is_unique") == [
        (1, "a", "5-10, 51-54", True), (1, "b", "56-60", True), (3, "", "51-60", True), (4, "b", "51-54", True)
    ]
    single = sam.to_sam(r.select("seqnum", "a_seq"), al.where("mate = 'a'"), chunks).collect()
    assert {q.flag for q in single if q.qname == "seq.1"} == {0} and {q.flag for q in single if q.qname == "seq.3"} == {4}


def test_cleaned(spark):
    chunks = junctions.genome_chunks(genome(spark), size=8)
    a = hits(spark, [(1, "a", "1", "1-8", "+", "TCGTACGA"), (2, "a", "9", "1-8", "+", "ACGTACGT"), (3, "a", "1", "1-3", "+", "ACG")])
    out = sam.cleaned(a, chunks, 4)
    assert rows(out.withColumn("s", S.render(F.col("spans"))), "seqnum", "s", "seq") == [(1, "2-7", "CGTACG")]
    tags = sam.mismatch_tagged(hits(spark, [(1, "a", "1", "1-8", "+", "ACGAACGT")]), chunks).first()
    assert (tags.md, tags.nm) == ("3T4", 1)


def test_consensus_ties(spark):
    df = spark.createDataFrame([(1, "T"), (1, "C"), (2, "N"), (2, "N"), (2, "A")], "pos int, base string")
    assert rows(junctions.consensus(df, ["pos"]), "pos", "base") == [(1, "C"), (2, "N")]


def test_position_quality(spark):
    df = spark.createDataFrame([("!I",), ("+",)], "qual string")
    assert rows(text.position_quality(df), "pos", "mean") == [(1, 5.0), (2, 40.0)]


def test_steps_by_kind(spark):
    data = [(1, "x", "START", 0), (2, "x", "START", 5), (3, "x", "FINISH", 9), (4, "y", "FINISH", 1), (5, "y", "START", 2), (6, "y", "FINISH", 4), (7, "x", "START", 11)]
    df = spark.createDataFrame(data, "event_id int, step string, kind string, s int").withColumn("ts", F.timestamp_seconds("s"))
    assert rows(text.step_times(df, ["step"], kind="kind"), "step", "seconds") == [("x", 4), ("y", 2)]


def test_missing_exons(spark):
    models = spark.createDataFrame([("g", "1", "-", "1-3, 5-6")], "id string, chr string, strand string, t string").withColumn("exons", S.parse(F.col("t")))
    seqs = spark.createDataFrame([("1", 1, 3, "ACG")], "chr string, start long, end long, seq string")
    assert genes.sequences(models, seqs).first().seq is None
    with pytest.raises(Exception, match="no sequence"):
        genes.sequences(models, seqs, strict=True).collect()


def test_orders(spark):
    from loomspan.operators import order

    df = spark.createDataFrame([("chr10", 5, 6), ("chr2", 9, 10), ("chr2", 9, 10), ("chr2", 1, 3)], "chr string, start long, end long")
    assert [tuple(r) for r in order.distinct_by_location(df).collect()] == [("chr2", 1, 3), ("chr2", 9, 10), ("chr10", 5, 6)]
    assert [r.start for r in order.by_column(df, -2).collect()] == [9, 9, 5, 1]
    some = spark.createDataFrame([(2, "b"), (1, "b"), (1, ""), (1, "a")], "seqnum long, mate string")
    assert [tuple(r) for r in order.by_read(some).collect()] == [(1, ""), (1, "a"), (1, "b"), (2, "b")]


def test_checks_of_reads(spark):
    df = spark.createDataFrame([(1, "a", "x 1:Y:0"), (1, "b", "x 2:N:0"), (2, "a", "y 1:N:0")], "seqnum long, mate string, name string")
    assert rows(text.filtered_reads(df), "seqnum", "mate") == [(1, "a")]
    assert rows(text.without_mate(df), "seqnum", "mates") == [(2, 1)]
