"""Sweeps and islands hold a task's rows once; spans shared by many chromosomes; reads are counted without pairs."""

import random

import pytest
from pyspark.sql import functions as F

from loomspan.operators import coverage, intervals, quantify
from loomspan.queries import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def runs_of(rows: list, gap: int) -> list:
    out, far = [], None
    for s, e in sorted(rows):
        if far is None or s > far + gap:
            out.append([s, e, 0])
        out[-1][1], out[-1][2], far = max(out[-1][1], e), out[-1][2] + 1, e if far is None else max(far, e)
    return sorted(map(tuple, out))


@pytest.mark.parametrize("gap", [0, 7])
def test_islands_across_tiles(spark, gap):
    random.seed(gap)
    rows = [(c, s, s + random.choice([-3, 0, 5, 30, 200])) for c in (1, 2, None) for s in random.choices(range(3000), k=150)]
    found = intervals.islands(spark.createDataFrame(rows, "chr int, start long, end long"), ["chr"], gap=gap, tile=64)
    got = {c: sorted((r.start, r.end, r.n) for r in found.collect() if r.chr == c) for c in (1, 2, None)}
    assert got == {c: runs_of([r[1:] for r in rows if r[0] == c], gap) for c in got}


def test_no_join_beside_the_sort(spark):
    df = spark.range(10).selectExpr("id as chr", "id as start", "id + 5 as end")
    for out in (intervals.islands(df, ["chr"]), coverage.sweep(df, ["chr"])):
        assert "Join" not in plan(out)


def test_sweep_across_tiles(spark):
    random.seed(3)
    rows = [(c, s, s + random.choice([1, 9, 40, 300])) for c in (1, 2) for s in random.choices(range(1500), k=60)]
    df = spark.createDataFrame(rows, "chr int, start long, end long")
    depth = {(c, p): sum(a == c and s <= p < e for a, s, e in rows) for c in (1, 2) for p in range(2000)}
    got = coverage.sweep(df, ["chr"], tile=32).collect()
    assert {(r.chr, p): r.cov for r in got for p in range(r.start, r.end)} == {k: n for k, n in depth.items() if n}
    assert all(not (a.chr == b.chr and a.end == b.start and a.cov == b.cov) for a in got for b in got)


def test_shared_spans_equal_spans_one_by_one(spark):
    random.seed(5)
    runs = spark.createDataFrame([(c, s, s + random.randint(1, 30), random.randint(1, 3)) for c in range(7) for s in range(0, 600, 31)], "chr int, start long, end long, cov long")
    places = spark.createDataFrame([(k, s, s + random.choice([0, 1, 9, 70])) for k in (0, 1, 5) for s in random.choices(range(700), k=20)], "k int, start long, end long")
    groups = spark.createDataFrame([(c % 2, c) for c in range(9)] + [(1, 3), (8, 3)], "k int, chr int")
    want = coverage.over_spans(places.join(groups, "k"), runs, ["chr"], cutoff=2)
    got = coverage.over_shared_spans(places, groups, runs, "k", cutoff=2, together=2)
    assert got.dtypes == want.dtypes and sorted(got.collect()) == sorted(want.collect())


def test_the_product_is_not_shuffled(spark):
    """What is put out last is the spread of each span over its members."""
    df = QUERIES["coverage_over_spans"](spark, "/root/testdata/sf0.001")
    lines = plan(df).splitlines()
    assert next(i for i, x in enumerate(lines) if "Exchange" in x) > next(i for i, x in enumerate(lines) if "Generate explode(_members" in x)
