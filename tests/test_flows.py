import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomspan.functions import spans as S
from loomspan.operators import hits, regions
from loomspan.plans import alignment, index
from tests.test_operators import hits as rows_of
from tests.test_operators import rows


def test_transcript_hits(spark):
    models = spark.createDataFrame([("1", "+", "11-15, 21-30", "p"), ("1", "-", "11-15, 21-30", "m")], "chr string, strand string, t string, id string")
    models = models.withColumn("exons", S.parse(F.col("t")))
    raw = [(1, "a", "+", "p", 3, "NACGTA"), (2, "a", "+", "m", 1, "AACCG"), (3, "a", "+", "p", 14, "ACGT")]
    df = spark.createDataFrame(raw, "seqnum long, mate string, strand string, target string, start long, seq string")
    out = hits.transcript_hits(df, models).withColumn("s", S.render(F.col("spans")))
    assert rows(out, "seqnum", "s", "strand", "seq") == [(1, "14-15, 21-23", "+", "AC:GTA"), (2, "26-30", "-", "CGGTT")]


def test_psl_hits_and_uniqueness(spark):
    psl = [
        ("seq.1a", "+", "1", 0, 20, [10, 10], [0, 10], [100, 200]),
        ("seq.1a", "+", "1", 5, 20, [10, 10], [0, 10], [900, 999]),
        ("seq.2b", "-", "1", 0, 20, [10, 8], [0, 12], [100, 110]),
    ]
    df = spark.createDataFrame(
        psl, "q_name string, strand string, t_name string, mismatches long, q_size long, block_sizes array<long>, q_starts array<long>, t_starts array<long>"
    )
    seqs = spark.createDataFrame([("seq.1a", "A" * 10 + "C" * 10), ("seq.2b", "G" * 8 + "TT" + "C" * 10)], "q_name string, seq string")
    out = hits.psl_hits(df, seqs).withColumn("s", S.render(F.col("spans")))
    assert rows(out, "seqnum", "mate", "s", "strand", "seq") == [
        (1, "a", "101-110, 201-210", "+", "AAAAAAAAAA:CCCCCCCCCC"),
        (2, "b", "101-118", "+", "GGGGGGGGGG+AA+CCCCCCCC"),
    ]
    unique, rest = hits.split_by_uniqueness(out.drop("s"), 10)
    assert unique.count() == 2 and rest.count() == 0


PSL = "q_name string, strand string, t_name string, mismatches long, q_size long, q_end long, block_sizes array<long>, q_starts array<long>, t_starts array<long>"


def spliced(spark, rows, reads):
    """Unique and ambiguous alignments of PSL rows (read, strand, chromosome, mismatches, size, end in the read, blocks of (read, genome, bases))."""
    data = [(q, s, c, m, n, e, [x[2] for x in b], [x[0] for x in b], [x[1] for x in b]) for q, s, c, m, n, e, b in rows]
    found = hits.psl_hits(spark.createDataFrame(data, PSL), spark.createDataFrame(list(reads.items()), "q_name string, seq string"))
    show = lambda df: rows_(df.withColumn("s", S.render(F.col("spans"))), "seqnum", "mate", "chr", "s", "strand")
    return [show(df) for df in hits.spliced_classified(found, 30, 500)]


def rows_(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_mates_with_equal_hits_meet_at_one_place(spark):
    reads = {"seq.4a": "A" * 60, "seq.4b": "C" * 60}
    rows = [("seq.4a", "+", c, 0, 60, 55, [(0, at, 55)]) for c, at in (("7", 9000), ("7", 4000), ("5", 700))]
    # one reaches from the first to the last base; the others end early and go in the first pass
    rows += [("seq.4b", "-", c, 0, 60, e, [(60 - n, at, n)]) for c, at, n, e in (("7", 9100, 24, 24), ("7", 4100, 60, 60), ("5", 800, 24, 24))]
    unique, rest = spliced(spark, rows, reads)
    assert unique == [(4, "a", "7", "4001-4055", "+"), (4, "b", "7", "4101-4160", "+")] and rest == []


def test_second_ranking_and_lone_best(spark):
    reads = {f"seq.{k}{m}": "ACGT" * 15 for k in range(1, 6) for m in "ab"}
    one = lambda q, c, m, n, e=60: (q, "+", c, m, 60, e, [(0, 100, n)])
    # 1: a base less than the best is as good, two bases less aren't; the best one alone makes a lone mate unique
    unique, rest = spliced(spark, [one("seq.1a", "1", 0, 60), one("seq.1a", "2", 0, 59), one("seq.1a", "3", 0, 58)], reads)
    assert unique == [(1, "a", "1", "101-160", "+")] and rest == []
    # 2: equally good ones stay, without those of three more mismatches
    unique, rest = spliced(spark, [one("seq.2b", "1", 0, 56), one("seq.2b", "2", 2, 58), one("seq.2b", "3", 3, 59)], reads)
    assert unique == [] and rest == [(2, "b", "1", "101-156", "-"), (2, "b", "2", "101-158", "-")]
    # 3: a row that reaches the read's end sets what the first pass asks for, whatever its score
    unique, rest = spliced(spark, [one("seq.3a", "1", 12, 60), one("seq.3a", "2", 0, 49, 49)], reads)
    assert unique == [] and rest == []
    # 4: with hits of the other mate the lone best one has no say
    unique, rest = spliced(spark, [one("seq.4a", "1", 0, 60), one("seq.4a", "2", 0, 59), ("seq.4b", "-", "2", 0, 60, 60, [(0, 300, 60)])], reads)
    assert unique == [(4, "a", "2", "101-159", "+"), (4, "b", "2", "301-360", "+")] and rest == []


def test_mates_in_order_of_their_means(spark):
    # the upstream mate's spliced end lies far behind, so its mean exceeds the other's, though it starts first
    data = [(1, "a", "1", "1-10, 301-400", "+", "A" * 10 + ":" + "A" * 100), (1, "b", "1", "5-10, 301-450", "-", "A" * 6 + ":" + "A" * 150)]
    assert reads_of(spark, data) == 1 and reads_of(spark, data, by_mean=True) == 1
    data = [(1, "a", "1", "1-10, 301-400", "+", "A" * 10 + ":" + "A" * 100), (1, "b", "1", "2-10, 301-402", "-", "A" * 9 + ":" + "A" * 102)]
    assert reads_of(spark, data) == 1 and reads_of(spark, data, by_mean=True) == 1
    data = [(1, "a", "1", "1-100, 401-500", "+", "A" * 100 + ":" + "A" * 100), (1, "b", "1", "1-100, 401-500, 601-601", "-", "A" * 100 + ":" + "A" * 100 + ":A")]
    assert reads_of(spark, data[::1], by_mean=True) == 1
    data = [(1, "a", "1", "1-10, 401-500", "+", "A" * 10 + ":" + "A" * 100), (1, "b", "1", "1-200, 401-500", "-", "A" * 200 + ":" + "A" * 100)]
    assert reads_of(spark, data, by_mean=True) == 0


def reads_of(spark, data, **more):
    from loomspan.operators import reads

    return reads.classified(rows_of(spark, data), contained=False, **more).count()


def test_ambiguous_hits_with_a_common_region(spark):
    df = rows_of(spark, [(1, "a", "1", "1-50", "+", "A" * 50), (1, "a", "1", "5-60", "+", "A" * 56), (2, "a", "1", "1-5", "+", "AAAAA"), (2, "a", "2", "1-5", "+", "AAAAA")])
    unique, rest = hits.split_by_uniqueness(df, 20)
    assert rows(unique.withColumn("s", S.render(F.col("spans"))), "seqnum", "s") == [(1, "5-50")]
    assert rows(rest, "seqnum") == [(2,), (2,)]


def test_mates_of_joined(spark):
    joined = rows_of(spark, [(1, "", "1", "11-15, 21-27", "+", "ACGTA:CCTTGGA")])
    reads = spark.createDataFrame([(1, "TACGTAC", "TCCAAGG")], "seqnum long, a_seq string, b_seq string")
    out = hits.mates_of_joined(joined, reads).withColumn("s", S.render(F.col("spans")))
    assert rows(out, "mate", "s", "seq", "left", "right") == [("a", "11-15, 21-21", "ACGTA:C", 1, 0), ("b", "21-27", "CCTTGGA", 0, 0)]


def test_regions(spark):
    df = rows_of(spark, [(1, "a", "1", "1-3, 11-12", "+", "ACG:TT"), (2, "a", "1", "2-4", "-", "CGA"), (3, "a", "2", "2-4", "+", "GGG")])
    assert rows(regions.in_region(df, "1", 4, 9), "seqnum") == [(1,), (2,)]
    assert rows(regions.across_junction(df, "1", 4, 10), "seqnum") == [(1,)]
    best = regions.region_consensus(regions.in_region(df, "1", 1, 5), 1, 5)
    assert "".join(r.base for r in best.orderBy("pos").collect()) == "ACGAA"
    assert regions.replicated(df, 3, shift=10).select("seqnum").distinct().count() == 9
    assert rows(regions.sam_junctions(df.withColumn("is_unique", F.lit(True)), 5), "start", "end", "n") == [(4, 10, 1)]


def test_adapter(spark):
    df = spark.createDataFrame([(1, "AAAAGATCGG"), (2, "AAAAGATCGA"), (3, "CCCCCCCCCC"), (4, "GATCGGAAAA")], "seqnum long, seq string")
    assert rows(regions.without_adapter(df, "GATCGG"), "seqnum", "seq") == [(1, "AAAA"), (2, "AAAA"), (3, "CCCCCCCCCC")]


def test_adapter_places_by_brute_force():
    rng = random.Random(5)
    for adapter in ("GATCGG", "A", "ACACAC", "é𝄞A"):
        seqs = [None, "", "GATCG", "é𝄞AC𝄞é𝄞A"] + ["".join(rng.choices("ACGTé𝄞", k=rng.randrange(40))) for _ in range(300)]
        m, want = len(adapter), []
        for seq in seqs:
            scores = [sum(map(str.__eq__, adapter, seq[k : k + m])) for k in range(len(seq or "") - m + 1)]
            at = scores.index(max(scores)) if scores else None
            rest = max([x for k, x in enumerate(scores) if k != at], default=0)
            good = scores and (scores[at] >= m - 1 or (scores[at] >= 0.65 * m and scores[at] >= 1.5 * rest))
            want.append(at if good else None)
        assert regions.adapter_places(pa.array(seqs, pa.string()), adapter, 0.65, 1.5).to_pylist() == want
        assert regions.adapter_places(pa.array(seqs, pa.string()).slice(7), adapter, 0.65, 1.5).to_pylist() == want[7:]
    for seqs, adapter in (([], "A"), ([None, "A"], "AC"), (["AC"], "")):
        assert regions.adapter_places(pa.array(seqs, pa.string()), adapter, 0.65, 1.5).null_count == len(seqs)


def test_headers(spark):
    names = spark.createDataFrame([(">gi|1|chr7 range=1-5",), ("chr2",), ("hg19_chrX:1-9",)], "n string")
    assert [r[0] for r in names.select(regions.renamed_header(F.col("n"))).collect()] == ["chr7", "chr2", "hg19_chrX"]


def test_index_and_outputs(spark, tmp_path):
    rng = random.Random(7)
    genome = "".join(rng.choice("ACGT") for _ in range(300))
    genome = genome[:100] + "GT" + genome[102:148] + "AG" + genome[150:]
    (tmp_path / "g.fa").write_text(">1\n" + "\n".join(genome[k : k + 50] for k in range(0, 300, 50)) + "\n")
    models = spark.createDataFrame([("1", "+", "51-100, 151-220", "g", "r"), ("1", "+", "51-100, 151-220", "h", "e")], "chr string, strand string, t string, name string, type string")
    built = index.built(spark, str(tmp_path / "g.fa"), models.withColumn("exons", S.parse(F.col("t"))).drop("t"), size=64)
    assert built.models.first().id == "g(r)::::h(e)"
    assert built.gene_sequences.first().seq == genome[50:100] + genome[150:220]
    assert built.size.first()[0] == 300
    index.save(built, str(tmp_path / "i"))
    built = index.load(spark, str(tmp_path / "i"))

    gu = rows_of(spark, [(1, "a", "1", "60-90", "+", genome[59:90])])
    tu = rows_of(spark, [(1, "a", "1", "60-90", "+", genome[59:90]), (2, "a", "1", "81-100, 151-170", "+", "x")])
    none = rows_of(spark, [])
    unique, rest = alignment.reconciled(gu, tu, none, none, alignment.Settings(least_overlap=20))
    out = alignment.outputs(unique, rest, built.models, built.chunks)
    assert out["junctions"].select("start", "end", "known", "score", "strand").collect() == [(101, 150, 1, 1, "+")]
    assert out["unique_coverage"].agg(F.sum((F.col("end") - F.col("start")) * F.col("cov"))).first()[0] == 71
    quant = {r.feature_type + str(r.ordinal): (r.ucount, r.nucount) for r in out["quantification"].collect()}
    assert quant == {"transcript0": (2, 0), "exon1": (2, 0), "exon2": (1, 0), "intron1": (0, 0)}
    assert out["statistics"].first().unique_forward_only == 2 and out["chromosome_counts"].first().n == 2


def test_each_source_is_read_once(spark, tmp_path):
    seen = {n: spark.sparkContext.accumulator(0) for n in ("gu", "tu", "gnu", "tnu")}

    def counted(name, data):
        def run(batches):
            for batch in batches:
                seen[name].add(batch.num_rows)
                yield batch

        df = rows_of(spark, data)
        return df.mapInArrow(run, df.schema)

    one = lambda n, m, c, t: (n, m, c, t, "+", "A" * sum(int(x.split("-")[1]) - int(x.split("-")[0]) + 1 for x in t.split(", ")))
    data = {
        "gu": [one(1, "a", "1", "1-50"), one(2, "", "2", "11-60")],
        "tu": [one(1, "a", "1", "1-50"), one(3, "b", "1", "31-40, 61-70")],
        "gnu": [one(4, "a", "1", "5-9"), one(4, "a", "2", "5-9")],
        "tnu": [one(5, "b", "1", "5-9"), one(5, "b", "1", "7-11"), one(5, "b", "1", "9-13")],
    }
    unique, rest = alignment.reconciled(*[counted(n, rows) for n, rows in data.items()], alignment.Settings(least_overlap=20))
    models = spark.createDataFrame([("1", "+", "1-40, 61-80", "g")], "chr string, strand string, t string, id string").withColumn("exons", S.parse(F.col("t"))).drop("t")
    chunks = spark.createDataFrame([("1", 0, 100, "A" * 100), ("2", 0, 100, "C" * 100)], "chr string, chunk long, size long, seq string")
    out = alignment.outputs(unique, rest, models, chunks)
    for df in out.values():
        df.collect()
    assert {n: a.value for n, a in seen.items()} == {n: len(rows) for n, rows in data.items()}
    (r,) = out["report"].collect()
    assert (r.unique_joined, r.unique_forward_only, r.unique_reverse_only, r.ambiguous_forward_only, r.ambiguous_reverse_only) == (1, 1, 1, 1, 1)
    assert (r.unique_footprint, r.unique_percent, r.ambiguous_footprint, r.ambiguous_percent) == (110, 55.0, 14, 7.0)
    assert [tuple(x) for x in r.unique_chromosomes] == [("1", 2), ("2", 1)] and [tuple(x) for x in r.ambiguous_chromosomes] == [("1", 4), ("2", 1)]
    assert [tuple(x) for x in r.multiplicity] == [(2, 1), (3, 1)]


def test_policies_of_uniqueness(spark):
    from loomspan.operators import quantify

    data = [
        (1, 65, "9M", 1), (1, 129, "9M", 1),  # a pair of one place
        (2, 65, "9M", 2), (2, 129, "9M", 2), (2, 321, "9M", 2), (2, 385, "9M", 2),  # of two
        (3, 73, "9M", None), (3, 133, "*", None),  # one mate, without tags
        (4, 65, "9M", None), (4, 129, "9M", None), (4, 385, "9M", None),  # a mate of two places
        (5, 0, "9M", 1), (5, 256, "9M", None),  # unpaired
        (None, 0, "9M", 1), (6, None, "9M", 1),
    ]
    df = spark.createDataFrame(data, "seqnum long, flag int, cigar string, hits int").withColumn("is_unique", F.lit(7))
    got = lambda policy: sorted((r.seqnum or 0, r.flag or 0) for r in quantify.uniqueness(df, policy).collect() if r.is_unique)
    assert got("tags") == [(1, 65), (1, 129), (3, 73), (3, 133), (4, 65), (4, 129), (4, 385), (5, 0), (5, 256)]
    assert got("counted") == [(1, 65), (1, 129), (3, 73)]
    assert got("primary") == [(0, 0), (1, 65), (1, 129), (2, 65), (2, 129), (3, 73), (3, 133), (4, 65), (4, 129), (5, 0)]
    assert quantify.uniqueness(df, "tags").count() == len(data)
    with pytest.raises(ValueError):
        quantify.uniqueness(df, "other")
