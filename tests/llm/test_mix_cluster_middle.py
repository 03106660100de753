"""Operators 11 to 13 against brute force, their SQL and exact round trips, and on odd rows."""

import collections
import hashlib
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomspan.llm import centroids, middle, mixing
from loomspan.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
ODD = [(1, None, "a"), (2, "", None), (3, "one two", "a"), (3, "one two", "a"), (4, "Straße — ÉTÉ 42, x" * 700, None), (None, "no id", ""), (5, "á é <M> \U0001f600", "b")]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, out = QUERIES[name](spark, SF), con.sql(ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert sorted(out.columns) == columns
    at = [out.columns.index(c) for c in columns]
    got = sorted(tuple(r[c] for c in columns) for r in df.collect())
    assert got == sorted(tuple(r[k] for k in at) for r in out.fetchall()) and len(got) > 100


def clashing(df, names):
    for name in names.split():
        df = df.withColumn(name, F.lit(f"own {name}"))
    return df


# 11 mixing


def brute_targets(sizes, weights, share, most):
    """Excess over the caps is dealt again by weight until there is none."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while open_ and left > 1e-9:
        all_ = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / all_
        left = sum(max(0.0, target[s] - most * sizes[s]) for s in open_)
        target = {s: min(t, most * sizes[s]) for s, t in target.items()}
        open_ = {s for s in open_ if target[s] < most * sizes[s]}
    return target


def word_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("weights,share,most,block", [((3, 1, 2), 1.5, 2.0, 16), ((1,), 0.4, 1.0, 7), ((5, 1, 1, 1), 2.5, 3.0, 64)])
def test_mix(spark, weights, share, most, block):
    rng = np.random.default_rng(1)
    source = [None, "", "b", "é", "Z", "hot"]
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 60))), source[int(rng.choice(6, p=[0.1, 0.05, 0.1, 0.1, 0.05, 0.6]))]) for i in range(400)]
    mix = mixing.mixed(word_rows(spark, rows), weights, share, most, block)
    docs, pieces = mix.documents.collect(), mix.schedule.orderBy("slot", "first").collect()
    sizes = collections.Counter()
    for _, text, name in rows:
        sizes[name] += len(text.split())
    want = brute_targets(sizes, weights, share, most)
    assert sorted((r.doc_id, r.size, r.source_size) for r in docs) == [(i, len(t.split()), sizes[s]) for i, t, s in rows]
    assert all(r.target == pytest.approx(want[r.source]) for r in docs)

    # a source's pieces are its stream: every word up to its target once a pass, none beyond
    by = collections.defaultdict(list)
    for p in pieces:
        by[p.source].append(p)
    for name, total in sizes.items():
        at = sorted((p["pass"] * total + p.first + p.first_word, p.words) for p in by[name])
        assert [a for a, _ in at] == list(np.cumsum([0] + [w for _, w in at])[:-1]) and sum(w for _, w in at) == int(want[name])
    laid = {r.doc_id: r for r in docs}
    assert all(p.words > 0 and p.first_word + p.words <= laid[p.doc_id].size and p.first == laid[p.doc_id].first for p in pieces)

    # slots: whole blocks but the last of a source, and sources even in time
    slot = collections.defaultdict(int)
    for p in pieces:
        slot[p.slot, p.source] += p.words
    assert len({t for t, _ in slot}) == len(slot)
    for name in sizes:
        own = sorted(w for (_, s), w in slot.items() if s == name)
        assert all(w == block for w in own[1:])
    order = [s for _, s in sorted(slot, key=lambda x: x[0])]
    for name in sizes:
        seen = np.cumsum([s == name for s in order])
        assert np.abs(seen - seen[-1] * np.arange(1, len(order) + 1) / len(order)).max() <= 3
    again = mixing.mixed(word_rows(spark, rows[::-1]).repartition(5), weights, share, most, block)
    assert sorted(again.schedule.collect(), key=str) == sorted(pieces, key=str)


@pytest.mark.parametrize("n", [1, 2, 3, 100, 1000])
def test_slots_take_every_place(spark, n, monkeypatch):
    monkeypatch.setattr(mixing, "TILE", 64)
    rng = np.random.default_rng(n)
    cut = np.unique(np.concatenate([[0, n], rng.integers(0, n + 1, 7)]))
    rows = [(k, int(b), int(b - a)) for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True))] + [(99, n, 0)]
    got = mixing.slots(spark.createDataFrame(rows, "no long, until long, slots long"), n).collect()
    points, step = mixing._lattice(n)
    want = {t: int(np.searchsorted(cut, t * step % points, "right")) - 1 for t in range(points) if t * step % points < n}
    assert {r.slot: r.no for r in got} == want and len(got) == n
    for no, _, k in rows:
        assert [r.rank for r in sorted(got, key=lambda r: r.slot) if r.no == no] == list(range(k))
    with pytest.raises(ValueError):
        mixing.slots(spark.createDataFrame(rows, "no long, until long, slots long"), mixing.POINTS)


def test_large_products_stay_in_range(spark):
    points, step = mixing._lattice(mixing.POINTS // 2)
    t, half = points - 1, 1 << 21
    (got,) = spark.createDataFrame([(t,)], "t long").select((F.col("t") * (step // half) % points * half + F.col("t") * (step % half)) % points).first()
    assert got == t * step % points


def test_sizes_are_the_patterns_words(spark):
    texts = ["", None, " a\tb\nc\x0bd\x0ce\rf ", "\x1fx\x85y é z", "\x00 \x00", "\U0001f600  "]
    got = [r.n for r in spark.createDataFrame([(t,) for t in texts], "text string").select(mixing.words_in("text").alias("n")).collect()]
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def test_mix_of_odd_rows(spark):
    df = clashing(word_rows(spark, ODD), "size first slot no slice name words target rank h")
    mix = mixing.mixed(df)
    sizes = sorted((str(r.doc_id), r.size) for r in mix.documents.collect())
    assert sizes == sorted((str(i), len((t or "").split())) for i, t, _ in ODD)
    assert not mix.schedule.where("doc_id in (1, 2)").count() and mix.schedule.where("doc_id is null").count()
    assert mix.documents.where("doc_id = 3").select("first").distinct().count() == 2
    for rows in ([], [(1, None, "a"), (2, "", None)]):
        mix = mixing.mixed(word_rows(spark, rows))
        assert mix.documents.count() == len(rows) and mix.schedule.count() == 0


# 12 centroids


def brute_clusters(rows, k=8, rounds=10, size=64, scale=1024):
    ok = lambda v: v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)
    grid = [(i, tuple(int(np.floor(scale * float(x))) for x in v)) for i, v in rows if ok(v)]
    named = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), g) for i, g in grid if i is not None)
    centres = [g for _, g in named[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for r in range(rounds + 1):
        near = [min((apart(g, c), n) for n, c in enumerate(centres)) for _, g in grid]
        if r < rounds:
            for n in range(len(centres)):
                own = [g for (_, g), (_, m) in zip(grid, near, strict=True) if m == n]
                if own:
                    centres[n] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    inertia = collections.Counter()
    for d, n in near:
        inertia[n] += d
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), centres[n]) for (i, _), (d, n) in zip(grid, near, strict=True)), key=str)


def vector_rows(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def clusters(df, **more):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, tuple(r.centroid)) for r in centroids.clustered(df, **more).collect()), key=str)


@pytest.mark.parametrize("spread", [0.001, 0.2, 40.0])
def test_clusters(spark, spread, monkeypatch):
    monkeypatch.setattr(centroids, "STRIP", 37)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(5, 64)) * spread
    rows = [(i, (base[i % 5] + rng.normal(size=64) * 0.02).tolist()) for i in range(90)]
    rows += [(200 + i, rows[i % 3][1]) for i in range(12)] + [(1, rows[7][1]), (1, rows[7][1])]
    assert clusters(vector_rows(spark, rows).repartition(3)) == brute_clusters(rows)


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(x) / 4 for x in np.unravel_index(i, (3, 3, 3))]) for i in range(27)]
    got = clusters(vector_rows(spark, rows), size=3, scale=4, rounds=2, k=6)
    assert got == brute_clusters(rows, k=6, rounds=2, size=3, scale=4)


def test_bounds_are_below_distances():
    rng = np.random.default_rng(3)
    for scale in (3, 1000, centroids.MOST // 2):
        cells = rng.integers(-scale, scale + 1, (200, 64))
        cells[100:] = cells[0] + (cells[100:] - cells[0]) * rng.integers(0, 2, (100, 1)) // 50
        pivots = centroids.Pivots(cells[::29])
        points = np.concatenate([cells[:40], cells[::29], (cells[:20] + cells[20:40]) // 2])
        bound = pivots.below(pivots.distances(cells), pivots.distances(points))
        exact = np.array([[sum(int(x) ** 2 for x in a - b) for b in points] for a in cells[:60]], dtype=object)
        assert all(int(b) <= e for b, e in zip(bound[:60].ravel(), exact.ravel(), strict=True)) and bound.max() > 0
        label, best, measured = centroids.nearest(cells, pivots.distances(cells), points, pivots)
        every = np.stack([centroids.squared(cells, p) for p in points], 1)
        assert (label == every.argmin(1)).all() and (best == every.min(1)).all() and measured <= every.size


def test_clusters_of_near_groups_leave_distances_out():
    rng = np.random.default_rng(4)
    base = rng.integers(-4000, 4000, (8, 64))
    cells = np.repeat(base, 50, 0) + rng.integers(-9, 10, (400, 64))
    pivots = centroids.Pivots(cells[::50])
    assert centroids.nearest(cells, pivots.distances(cells), base, pivots)[2] < 0.4 * len(cells) * 8


def test_clusters_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [float(k % 7) for k in range(64)]
    rows = [(1, good), (2, None), (3, []), (4, good[:63]), (5, [*good[:63], None]), (6, [*good[:63], nan]), (7, [*good[:63], inf]), (None, good), (1, good), (8, [-0.3] * 64)]
    df = clashing(vector_rows(spark, rows), "key cluster h cells c distance")
    assert clusters(df) == brute_clusters(rows) and len(clusters(df)) == 4
    assert clusters(vector_rows(spark, [])) == clusters(vector_rows(spark, rows[1:7])) == []
    with pytest.raises(Exception, match="exceeds"):
        clusters(vector_rows(spark, [(1, [1e6] * 64)]))


# 13 fill-in-middle

MARKS = tuple(m.encode() for m in middle.MARKS)


def brute_middle(doc, text):
    h = hashlib.sha256(f"1:{'null' if doc is None else doc}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in middle.MARKS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB<>PSM \n9é—\U0001f600", max_size=40), st.integers(0, 99), st.integers(0, 99), st.sampled_from(["psm", "spm"]), st.integers(1, 9))
def test_rotation_and_back(text, u, v, form, stretch):
    if any(x in text for x in middle.MARKS):
        return
    old, middle.STRETCH = middle.STRETCH, stretch
    try:
        raw = text.encode()
        units = middle.Units(np.frombuffer(raw, np.uint8))
        cut = re.findall("[A-Za-z]+|[^A-Za-z]", text)
        assert units.n == len(cut)
        a, b = sorted((u % (units.n + 1), v % (units.n + 1)))
        first, second = units.byte(a), units.byte(b)
        p, m, s = raw[:first], raw[first:second], raw[second:]
        assert p.decode() == "".join(cut[:a]) and m.decode() == "".join(cut[a:b])
        out = middle.moved(raw, first, second, form, MARKS)
        assert out == (b"<P>%b<S>%b<M>%b" % (p, s, m) if form == "psm" else b"<S>%b<P>%b<M>%b" % (s, p, m))
        assert middle.back(bytes(out), form, MARKS) == raw
    finally:
        middle.STRETCH = old


def test_fill_in_middle(spark):
    rows = [(i, "Ein <P, kurzer\nText: " + "é" * (i % 5) + " <S" * (i % 3)) for i in range(300)] + [(i, t) for i, t, _ in ODD]
    out = middle.restored(middle.fill_in_middle(clashing(spark.createDataFrame(rows, "doc_id long, text string"), "n form output restored middle_chars x")))
    got = sorted(((str(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored, r.x) for r in out.collect()), key=str)
    assert got == sorted(((str(i), *brute_middle(i, t), t or "", "own x") for i, t in rows), key=str)
    assert len({r[2] for r in got}) == 3
    assert middle.restored(middle.fill_in_middle(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


def test_long_text_in_the_middle(spark):
    text = "Größe, " * 700_000  # several stretches
    (row,) = middle.restored(middle.fill_in_middle(spark.createDataFrame([(3, text)], "doc_id long, text string"))).collect()
    assert (row.n, row.form, row.prefix_chars, row.middle_chars, row.output) == brute_middle(3, text) and row.restored == text and row.form != "plain"
