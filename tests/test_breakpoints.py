"""The breakpoint index against plain comparison of all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomspan.operators import breakpoints, intervals

FEATURES = {"a": (5, 15), "b": (10, 20), "c": (17, 20), "d": (30, 40), "e": (30, 33), "f": (37, 40)}


def meet(index, asked):
    s, e = (np.array([x[k] for x in asked], np.int64) for k in (0, 1))
    return sorted((int(a), int(b)) for i, j in index.pairs(s, e) for a, b in zip(i, j, strict=True))


@pytest.mark.parametrize("asked,names", [((0, 50), "abcdef"), ((0, 3), ""), ((8, 9), "a"), ((8, 10), "ab"), ((8, 11), "ab"), ((100, 110), "")])
def test_index_vectors(asked, names):
    index = breakpoints.Breakpoints(*(np.array([x[k] for x in FEATURES.values()]) for k in (0, 1)))
    assert "".join("abcdef"[j] for _, j in meet(index, [asked])) == names


def test_no_features():
    index = breakpoints.Breakpoints(np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert meet(index, [(0, 50)]) == []


@pytest.mark.parametrize("candidates", [1, 1 << 20])
def test_index_is_plain_comparison(candidates, monkeypatch):
    monkeypatch.setattr(breakpoints, "CANDIDATES", candidates)
    rng = random.Random(candidates)
    for _ in range(40):
        some = [(s := rng.randint(0, 300), s + rng.choice([0, 1, 20, 400])) for _ in range(rng.randint(1, 60))]
        asked = [(s := rng.randint(-20, 350), s + rng.choice([0, 1, 9, 500])) for _ in range(40)]
        index = breakpoints.Breakpoints(*(np.array([x[k] for x in some]) for k in (0, 1)))
        want = [(i, j) for i, (s, e) in enumerate(asked) for j, (fs, fe) in enumerate(some) if s <= fe and fs <= e]
        assert meet(index, asked) == want


def test_kept_sets_stay_small():
    n = 20_000  # each within all before: the sets of all pieces would hold n * n entries
    index = breakpoints.Breakpoints(np.arange(n), 10 * n - np.arange(n))
    assert len(index.cover) <= 2 * breakpoints.FEW * 2 * n
    assert len(meet(index, [(n - 1, n - 1)])) == n


@pytest.mark.parametrize("together,tile", [(1 << 18, 1 << 16), (20, 1 << 16), (20, 64)])
def test_overlap_join_deals_crowded_tiles(spark, together, tile, monkeypatch):
    monkeypatch.setattr(breakpoints, "TOGETHER", together)
    rng = random.Random(3)
    x = [(i, rng.choice(["1", "1", "1", "2", None]), s := rng.choice([7, rng.randint(0, 900)]), s + rng.choice([-3, 0, 30, 300])) for i in range(150)]
    y = [(i, rng.choice(["1", "1", "2", "3"]), s := rng.choice([7, rng.randint(0, 900)]), s + rng.choice([0, 30, 5000])) for i in range(120)]
    x += [(999, "1", None, 5), (998, "1", 5, None)]
    left = spark.createDataFrame(x, "i long, chr string, start long, end long")
    right = spark.createDataFrame(y, "j long, chr string, f_start long, f_end long")
    sound = [r for r in x if None not in r[1:] and r[2] <= r[3]]
    want = sorted((r[0], q[0]) for r in sound for q in y if r[1] == q[1] and r[2] <= q[3] and q[2] <= r[3])
    met = intervals.overlap_join(left, right, ["chr"], tile=tile)
    assert met.columns == ["i", "chr", "start", "end", "j", "f_start", "f_end"]
    assert sorted((r.i, r.j) for r in met.collect()) == want
    sums = {"n": F.lit(1), "s": F.col("j")}
    for bases in (False, True):
        got = breakpoints.overlap_sums(left, right, ["chr"], ("start", "end"), ("f_start", "f_end"), sums, bases, tile).collect()
        shared = lambda r, q: min(r[3], q[3]) - max(r[2], q[2]) + 1 if bases else 1  # noqa: B023, E731
        most = lambda r: [(shared(r, q), q[0]) for q in y if r[1] == q[1] and r[2] <= q[3] and q[2] <= r[3]]  # noqa: B023, E731
        assert {(r.chr, r.start, r.end): (r.n, r.s) for r in got} == {r[1:]: (sum(n for n, _ in most(r)), sum(n * j for n, j in most(r))) for r in sound if r[1]}
    hit = {i for i, _ in want}
    for how, keep in (("left_semi", lambda i: i in hit), ("left_anti", lambda i: i not in hit)):
        assert sorted(r.i for r in intervals.overlap_join(left, right, ["chr"], tile=tile, how=how).collect()) == [r[0] for r in sorted(x) if keep(r[0])]


def test_long_features_are_copied_once_per_tile(spark):
    df = spark.createDataFrame([("1", 5, 1_000_004)], "chr string, start long, end long")
    assert breakpoints._placed(df, ["chr"], "start", "end", breakpoints.TILE).count() == 1 + 1_000_004 // breakpoints.TILE


def test_odd_columns(spark):
    left = spark.createDataFrame([(1, 2, "x y", [1, 2])], "s long, `kind` long, `a b` string, l array<int>")
    right = spark.createDataFrame([(2, 2, {"k": 1})], "f long, t long, group map<string,int>")
    out = intervals.overlap_join(left, right, [], ("s", "kind"), ("f", "t"))
    assert [tuple(r) for r in out.collect()] == [(1, 2, "x y", [1, 2], 2, 2, {"k": 1})]
    assert intervals.overlap_join(left.limit(0), right, [], ("s", "kind"), ("f", "t")).count() == 0
    assert intervals.overlap_join(left, right.where(F.lit(False)), [], ("s", "kind"), ("f", "t")).count() == 0


@pytest.mark.parametrize("passed", [3, 1 << 14])
def test_groups_share_one_index(passed, monkeypatch):
    made, plain = [], breakpoints.Breakpoints
    monkeypatch.setattr(breakpoints, "Breakpoints", lambda *x: made.append(1) or plain(*x))
    monkeypatch.setattr(breakpoints, "PASSED", passed)
    rng, tile, rows = random.Random(passed), 40, []
    for group in range(30):
        for kind in (0, 1):
            for _ in range(rng.randint(0, 6)):
                late = rng.random() < 0.3
                s = (kind if late else rng.randint(1, tile))
                rows.append({"group": group, "kind": kind, "s": s, "e": rng.randint(max(s, 1), tile), "late": late, "l": len(rows), "r": len(rows)})
    batch = pa.RecordBatch.from_pylist(rows)
    got = sorted((p["l"], p["r"]) for part in breakpoints._found(batch, tile) for p in part.to_pylist())
    meets = lambda x, y: x["group"] == y["group"] and x["s"] <= y["e"] and y["s"] <= x["e"] and not (x["late"] and y["late"])
    assert got == sorted((x["l"], y["r"]) for x in rows for y in rows if x["kind"] == 1 and y["kind"] == 0 and meets(x, y)) and len(made) == 1
    assert all(part.num_rows <= passed for part in breakpoints._found(batch, tile))


def test_reads_are_counted_once_per_feature_without_pairs(spark):
    from loomspan.operators import quantify

    rng = random.Random(5)
    reads = [(rng.randint(0, 60), rng.choice("xy"), [(a, a + rng.randint(-1, 90)) for a in (rng.randint(0, 900) for _ in range(rng.randint(1, 4)))], rng.choice("+-."), rng.random() < 0.6) for _ in range(400)]
    places = sorted({(rng.choice("xyz"), a, a + rng.randint(-1, 200), rng.choice("+-")) for a in (rng.randint(0, 900) for _ in range(150))})
    frag = spark.createDataFrame(reads, "seqnum long, chr string, spans array<struct<start: bigint, end: bigint>>, strand string, is_unique boolean")
    feats = spark.createDataFrame(places, "chr string, start long, end long, strand string")
    meet = lambda f, r: r[1] == f[0] and f[1] <= f[2] and any(a <= b and a <= f[2] and f[1] <= b for a, b in r[2])
    many = lambda f, ok: len({r[0] for r in reads if meet(f, r) and ok(r)})
    out = quantify.feature_counts(frag, feats)
    assert sorted(map(tuple, out.select("chr", "start", "end", "strand", "ucount", "nucount").collect())) == [(*f, many(f, lambda r: r[4]), many(f, lambda r: not r[4])) for f in places]
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.count("MapInArrow") == 1 and "_read" not in plan[: plan.index("MapInArrow")]
    out = quantify.sense_counts(frag, feats)
    assert sorted(map(tuple, out.select("chr", "start", "end", "strand", "sense", "anti").collect())) == [
        (*f, many(f, lambda r, s=f[3]: r[4] and r[3] == s), many(f, lambda r, s=f[3]: r[4] and r[3] == {"+": "-", "-": "+"}[s])) for f in places
    ]
    assert out._jdf.queryExecution().analyzed().toString().count("MapInArrow") == 1


def test_groups_whose_hashes_fall_together_stay_apart():
    place, ask = {"group": 8, "kind": 0, "s": 1, "e": 9, "x": 1, "y": 9}, {"group": 8, "kind": 1, "s": 2, "e": 3, "x": None, "y": None}
    rows = pa.RecordBatch.from_pylist([{"_0": "p"} | place, {"_0": "q"} | place, {"_0": "q"} | ask, {"_0": "q"} | ask, {"_0": "p"} | ask])
    found = [r for b in breakpoints._counted(rows, ["_0"], 64, 1) for r in b.to_pylist()]
    assert [(r["_0"], r["n0"]) for r in found] == [("p", 1), ("q", 2)]
