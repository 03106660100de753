"""Functions by name in Spark SQL give what the column functions give."""

import random

import pytest
from pyspark.sql import functions as F

from loomspan.functions import sequence as Q
from loomspan.functions import spans as S
from loomspan.functions import sql
from loomspan.operators import coverage


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    sql.register(spark)


def test_named_functions(spark):
    texts = ["", "1-3", "1-3, 7-9", "1-5, 4-9, 20-30", "5-9, 1-3, 10-11"]
    df = spark.createDataFrame([(t, s) for t in texts for s in ("ACGTN+AC+T", "", None)], "t string, seq string").withColumn("x", S.parse(F.col("t")))
    df.createOrReplaceTempView("named_rows")
    pairs = {
        "spans_parse(t)": S.parse(F.col("t")),
        "spans_render(x)": S.render(F.col("x")),
        "spans_length(x)": S.total_length(F.col("x")),
        "spans_mean(x)": S.mean_coordinate(F.col("x")),
        "spans_introns(x)": S.introns(F.col("x")),
        "spans_fused(x, 1)": S.fused(F.col("x")),
        "spans_clipped(x, 3, 8)": S.clipped(F.col("x"), F.lit(3), F.lit(8)),
        "spans_overlap(x, spans_parse('8-9'))": S.overlap(F.col("x"), S.parse(F.lit("8-9"))),
        "reverse_complement(seq)": Q.reverse_complement(F.col("seq")),
        "without_insertions(seq)": Q.without_insertions(F.col("seq")),
        "base_count(seq, 'A')": Q.count_of(F.col("seq"), "A"),
        "rpkm(3, 1500, 1000)": Q.rpkm(F.lit(3), F.lit(1500), F.lit(1000)),
    }
    for text, column in pairs.items():
        got = [r[0] for r in spark.sql(f"SELECT {text} FROM named_rows").collect()]
        assert got == [r[0] for r in df.select(column).collect()], text
    assert spark.sql("SELECT spans_start(x), spans_end(x), strand_flipped('-') FROM named_rows WHERE t = '' OR t = '1-3, 7-9'").distinct().count() == 2


def test_coverage_runs(spark):
    rng = random.Random(8)
    rows = [(rng.choice("12"), s := rng.randint(0, 90), s + rng.choice([0, 1, 9, 40])) for _ in range(80)] + [("1", None, 4), ("1", 9, 3)]
    df = spark.createDataFrame(rows, "chr string, start long, end long")
    df.createOrReplaceTempView("run_rows")
    query = """SELECT * FROM coverage_runs(TABLE(SELECT chr, p.tile, p.start, p.end FROM
        (SELECT chr, tile_pieces(start, end, {}) AS pieces FROM run_rows) LATERAL VIEW explode(pieces) x AS p) PARTITION BY (chr, tile))"""
    want = sorted(map(tuple, coverage.sweep(df.where("start < end"), ["chr"]).collect()))
    assert sorted(map(tuple, spark.sql(query.format(1000)).collect())) == want
    small = spark.sql(query.format(16))
    assert sorted(map(tuple, coverage.merged([small]).collect())) == want and small.where("start div 16 <> (end - 1) div 16").count() == 0
    assert spark.sql(query.format(16).replace("run_rows", "run_rows WHERE false")).count() == 0


def test_coverage_runs_of_many_tiles_in_a_part(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["1", "10", "2", None]), s := rng.randint(0, 900), s + rng.choice([0, 1, 9, 40])) for _ in range(700)]
    df = spark.createDataFrame(rows, "chr string, start long, end long")
    df.createOrReplaceTempView("part_rows")
    query = """SELECT * FROM coverage_runs(TABLE(SELECT chr, p.tile, p.start, p.end, tile_part(chr, p.tile) % {} AS part FROM
        (SELECT chr, tile_pieces(start, end, 16) AS pieces FROM part_rows) LATERAL VIEW explode(pieces) x AS p) PARTITION BY {})"""
    alone = sorted(map(str, spark.sql(query.format(1, "(chr, tile)")).collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)
    try:
        for parts in (1, 3):
            assert sorted(map(str, spark.sql(query.format(parts, "part ORDER BY (chr, tile)")).collect())) == alone
        with pytest.raises(Exception, match="must be ordered"):
            spark.sql(query.format(1, "part ORDER BY tile")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
