from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomspan.functions import chromosomes, flags, fragments, sequence, splice
from loomspan.functions import spans as S


def one(spark, column, text=None):
    return spark.createDataFrame([(text,)], "t string").select(column).first()[0]


def parsed(spark, text):
    return S.parse(F.lit(text))


def shown(spark, column):
    return one(spark, S.render(column))


def test_parse_and_render(spark):
    assert shown(spark, parsed(spark, "1-5, 8-10")) == "1-5, 8-10"
    assert one(spark, F.size(S.parse(F.lit(None).cast("string")))) == 0
    assert one(spark, F.size(S.parse(F.lit("")))) == 0


def test_lengths(spark):
    assert one(spark, S.total_length(parsed(spark, "1-5, 8-10"))) == 8
    assert one(spark, S.mean_coordinate(parsed(spark, "1-3, 9-11"))) == 6.0


def test_fused_and_introns(spark):
    assert shown(spark, S.fused(parsed(spark, "1-5, 6-8, 10-12"))) == "1-8, 10-12"
    assert shown(spark, S.introns(parsed(spark, "1-5, 8-10, 20-30"))) == "6-7, 11-19"
    assert shown(spark, S.introns(parsed(spark, "1-5"))) == ""
    assert shown(spark, S.union(parsed(spark, "1-5, 20-30"), parsed(spark, "4-9"))) == "1-9, 20-30"


def test_overlap(spark):
    a = parsed(spark, "1-5, 20-30")
    assert one(spark, S.overlap(a, parsed(spark, "5-7")))
    assert not one(spark, S.overlap(a, parsed(spark, "6-19")))
    assert one(spark, S.shared_length(a, parsed(spark, "4-25"))) == 8


def test_bases(spark):
    a = parsed(spark, "1-5, 20-30")
    assert shown(spark, S.prefix(a, F.lit(7))) == "1-5, 20-21"
    assert shown(spark, S.suffix(a, F.lit(3))) == "28-30"
    assert shown(spark, S.lifted(a, F.lit("+"), F.lit(3), F.lit(4))) == "4-5, 20-21"
    assert shown(spark, S.lifted(a, F.lit("-"), F.lit(0), F.lit(12))) == "5-5, 20-30"


def test_cigar(spark):
    assert shown(spark, S.cigar_spans(F.lit(10), F.lit("2S3M1I4M2D5M100N6M"))) == "10-16, 19-23, 124-129"
    assert one(spark, S.to_cigar(parsed(spark, "10-16, 19-23, 124-129"))) == "7M2D5M100N6M"
    assert one(spark, S.to_cigar(parsed(spark, "10-16"), right=F.lit(3))) == "7M3S"
    assert shown(spark, S.without_deletions(parsed(spark, "10-16, 19-23, 124-129"))) == "10-23, 124-129"


def test_sequence(spark):
    assert one(spark, sequence.reverse_complement(F.lit("ACGTN"))) == "NACGT"
    assert tuple(one(spark, sequence.trim_n(F.lit("NNACNGN"), F.lit(10)))) == (12, 15, "ACNG")
    assert one(spark, sequence.with_junctions(F.lit("ACGTAC"), parsed(spark, "1-2, 9-12"))) == "AC:GTAC"
    assert one(spark, sequence.without_insertions(F.lit("AC+GG+T"))) == "ACT"
    assert one(spark, sequence.mismatches(F.lit("ACGT"), F.lit("ACCA"))) == 2
    assert one(spark, sequence.rpkm(F.lit(3), F.lit(1500), F.lit(7_000_000))) == 0.2857
    assert one(spark, sequence.least_overlap(F.lit(75))) == 35
    assert one(spark, sequence.least_overlap(F.lit(40))) == 24


def test_flags(spark):
    assert one(spark, flags.described(F.lit(99))) == ["paired", "proper_pair", "mate_reverse", "first"]
    assert one(spark, flags.described(F.lit(1 + 4 + 16))) == ["paired", "unmapped"]
    assert one(spark, flags.repaired(F.lit(1 + 2 + 4 + 16))) == 5
    assert one(spark, flags.repaired(F.lit(2 + 8 + 16))) == 16


def test_splice(spark):
    assert tuple(one(spark, splice.signal(F.lit("GT"), F.lit("AG")))) == ("+", True)
    assert tuple(one(spark, splice.signal(F.lit("CT"), F.lit("AC")))) == ("-", True)
    assert tuple(one(spark, splice.signal(F.lit("AT"), F.lit("AC")))) == ("+", False)
    assert one(spark, splice.signal(F.lit("AA"), F.lit("AA"))) is None


def test_chromosome_order(spark):
    def ordered(names):
        return [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").orderBy(chromosomes.order_key(F.col("n"))).collect()]

    assert ordered(["chrX", "chr10", "chr2", "chrM", "chrY", "chr1", "chr1_random", "weird"]) == ["chr1", "chr2", "chr10", "chrX", "chrY", "chrM", "chr1_random", "weird"]
    assert ordered(["chrIX", "chrIV", "chrI", "chrV", "chrIII", "chrII"]) == ["chrI", "chrII", "chrIII", "chrIV", "chrV", "chrIX"]
    assert chromosomes.arabic("xxi") == 21 and chromosomes.arabic("zz") is None
    assert [chromosomes.roman(n) for n in (4, 9, 14, 49, 399)] == ["iv", "ix", "xiv", "xlix", "cccxcix"]


def test_by_location(spark):
    rows = spark.createDataFrame([("chr10", 5, 6), ("chr2", 9, 10), ("chr2", 1, 3)], "chr string, start long, end long")
    assert [(r.chr, r.start) for r in chromosomes.by_location(rows).collect()] == [("chr2", 1), ("chr2", 9), ("chr10", 5)]


def test_common_runs_over_shared_gaps():
    assert fragments.common([[(1, 5), (20, 30)], [(3, 5), (20, 25)]], "ACGTACGTACGTACGT") == ([(3, 5), (20, 25)], "GTACGTACG")
    assert fragments.common([[(1, 5)], [(7, 9)]], "ACGTA") == ([], "")


def test_fuse():
    assert fragments.fuse([(1, 5)], [(6, 9)], "AAAAA", "CCCC") == ([(1, 9)], "AAAAACCCC")
    assert fragments.fuse([(1, 5)], [(9, 10)], "AAAAA", "CC") == ([(1, 5), (9, 10)], "AAAAACC")
    assert fragments.fuse([(1, 10), (20, 30)], [(5, 10), (20, 35)], "A" * 21, "C" * 22) == ([(1, 10), (20, 35)], "A" * 21 + "C" * 5)
    assert fragments.fuse([(1, 12), (20, 30)], [(5, 10), (20, 35)], "A" * 23, "C" * 22) is None


def test_trimmed():
    assert fragments.trimmed([(1, 8)], "TCGTACGA", "ACGTACGT") == ([(2, 7)], "CGTACG")
    assert fragments.trimmed([(1, 3), (11, 15)], "ATGTACGT", "ACGTACGT") == ([(3, 3), (11, 15)], "GTACGT")


def test_sam_fields():
    of = fragments.sam_fields
    assert of([(1, 4)], "ACGT", 0, 0, "ACCT") == ("4M", "2C1", 1, None)
    assert of([(1, 2), (5, 6)], "AC:GT", 1, 2, "ACTTGT") == ("1S2M2D2M2S", "2^TT2", 2, None)
    assert of([(1, 4)], "AC+GG+GT", 0, 0, "ACGT") == ("2M2I2M", "4", 2, None)
    assert of([(1, 3), (41, 43)], "ACG:TTT", 0, 0, "ACGGTAGTTA") == ("3M37N3M", "5A0", 1, "+")
    assert of([(1, 3), (41, 43), (90, 91)], "ACG:TTT:AA", 0, 0, "ACGGTAGTTTCTACAA") == ("3M37N3M46N2M", "8", 0, None)  # both strands
    assert of([(1, 4)], "ACGT", 0, 0, "AC") == ("4M", None, None, None)


def test_one_of_mates():
    one = fragments.one_of_mates
    assert one(([(1, 10)], "A" * 10), ([(5, 14)], "C" * 10)) == ([(1, 14)], "A" * 10 + "C" * 4)
    assert one(([(1, 10), (20, 30)], "A" * 10 + ":" + "A" * 11), ([(5, 10), (20, 35)], "C" * 6 + ":" + "C" * 16))[0] == [(1, 10), (20, 35)]
    assert one(([(1, 12), (20, 30)], "A" * 12 + ":" + "A" * 11), ([(5, 10), (20, 35)], "C" * 6 + ":" + "C" * 16)) is None
    assert one(([(1, 10)], "A" * 10), ([(3, 6)], "CCCC")) is None
    assert one(([(1, 10)], "A" * 10), ([(3, 6)], "CCCC"), contained=True) == ([(1, 10)], "A" * 10)
    up, down = ([(1, 10), (20, 30)], "A" * 10 + ":" + "A" * 11), ([(19, 35)], "C" * 17)
    assert one(up, down) is None and one(up, down, repair=True)[0] == [(1, 10), (20, 35)]
    assert one(([(1, 4)], "AC+GG+GT"), ([(4, 6)], "TAA")) == ([(1, 6)], "AC+GG+GTAA")


spans = st.lists(st.tuples(st.integers(0, 20), st.integers(1, 15)), min_size=1, max_size=5).map(
    lambda parts: [(sum(g + n for g, n in parts[: k + 1]) - n + 1, sum(g + n for g, n in parts[: k + 1])) for k, (_, n) in enumerate(parts)]
)


@settings(max_examples=100, deadline=None)
@given(spans, st.integers(0, 60))
def test_cuts_keep_lengths(a, n):
    seq = "A" * fragments.length(a)
    for cut in (fragments.cut_front, fragments.cut_back):
        left, rest = cut(a, seq, n)
        assert fragments.length(left) == len(rest) == max(0, len(seq) - n)


@settings(max_examples=100, deadline=None)
@given(spans, spans)
def test_common_is_covered_by_both(a, b):
    found, seq = fragments.common([a, b], "A" * fragments.length(a))
    covered = lambda x: {i for s, e in x for i in range(s, e + 1)}
    assert covered(found) <= covered(a) & covered(b)
    assert bool(found) == bool(covered(a) & covered(b))
    assert len(seq) == fragments.length(found)


def test_names_are_numbered_in_ranges(spark):
    names = [f"chr{k}{x}" for k in range(300) for x in ("", "_random")] + [f"scaffold_{k}" for k in range(300)] + ["chrX", "iv", None]
    df = spark.createDataFrame([(x, 5 - k % 3, 9) for k, x in enumerate(names)] * 2, "chr string, start long, end long").repartition(7)
    want = [r.chr for r in df.select("chr").distinct().orderBy(chromosomes.order_key(F.col("chr"))).collect()]
    found = chromosomes.ranks(df)
    assert {r.chr: r.chr_rank for r in found.collect()} == {x: k for k, x in enumerate(x for x in want if x is not None)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "row_number() windowspecdefinition(_range" in plan  # not one window over all names
    got = [r.chr for r in chromosomes.by_location(df).collect()]
    assert got == [x for x in want for _ in range(2)]


def test_cigar_lengths_need_no_second_pattern(spark):
    df = spark.createDataFrame([("2S10M15N1I20M3D4=1H",), ("*",), (None,), ("007M",)], "c string").select(S.cigar_ops(F.col("c")).alias("o"))
    assert "regexp_extract(" not in df._jdf.queryExecution().optimizedPlan().toString()
    got = [[tuple(x) for x in r.o] for r in df.collect()]
    assert got == [[(2, "S"), (10, "M"), (15, "N"), (1, "I"), (20, "M"), (3, "D"), (4, "="), (1, "H")], [], [], [(7, "M")]]
