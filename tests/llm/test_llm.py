"""Each operator against a brute-force version or an exact round trip, and its behaviour on odd rows."""

import collections
import hashlib
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomspan.llm import decontam, huffman, neardup, ngram_join, packing, pii, sharding, store, substrings, toxicity, warc, words
from loomspan.llm.ranks import components, gapless, hot_keys, spread
from loomspan.llm.tokens import Encoder, default_path

SF = "/root/testdata/sf0.001"
#: Nulls, empty and long texts, repeated rows, and columns whose names clash with those that operators add.
CLASH = "size string, shard int, slot int, n_words long, items string, score double, spans string, n_email int, _row int"
ODD = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (4, "Straße — ÉTÉ 42, x" * 700), (None, "no id"), (5, "á é <|endoftext|> \U0001f600")]


def docs(spark, rows=None):
    return spark.createDataFrame(ODD if rows is None else rows, "doc_id long, text string")


def odd_columns(spark):
    out = docs(spark)
    for kind in CLASH.split(", "):
        out = out.withColumn(kind.split()[0], F.lit(None).cast(kind.split()[1]))
    return out


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(real):
    return {r.doc_id: r.text for r in real.collect()}


# shared parts


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aB9 \n.é— -", max_size=30), min_size=1, max_size=6))
def test_words_are_the_patterns_words(lines):
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    for mask, pattern in ((words.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (words.SOLID, r"[^\x20\x09-\x0D]+")):
        found = words.Words(pa.array(lines), mask)
        for k, line in enumerate(lines):
            got = [found.word(i).decode() for i in range(found.first[k], found.first[k + 1])]
            assert got == re.findall(pattern, low(line))


def test_slices_keep_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 0, 90, 3, 3, 200)] + [None]})
    parts = list(words.slices(iter([batch, batch.slice(0, 0)]), "text", 50))
    assert [x for p in parts for x in p.column("text").to_pylist()] == batch.column("text").to_pylist()


def test_encoder_equals_library():
    rng = random.Random(4)
    lines = ["", "It's 42.5%, O'NEIL'S don't", "<|startoftext|>x<|ENDOFTEXT|>", "été ÀÉ ß İ ſ ﬁ Σας", "áb ...,, x.y, z. 9. é. %. '.", " nb​sp\x85"]
    alphabet = "abzAZ09 .,'%-éÀßΣ́ \n<|>"
    lines += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    own = Encoder(default_path())
    for at in range(0, len(lines), 100):
        part = lines[at : at + 100]
        assert own.encode(part) == own.whole(part)


def test_gapless_numbers(spark):
    df = spark.range(1000).select((F.col("id") % 3 == 0).cast("int").alias("g"), F.col("id").alias("k")).union(spark.createDataFrame([(9, 5), (9, 5)], "g int, k long"))
    out = gapless(df, ["g"], ["k"], "n", parts=7)
    for _, rows in out.toPandas().groupby("g"):
        assert sorted(rows.n) == list(range(len(rows)))


def test_gapless_keeps_columns_of_any_name(spark):
    df = spark.range(40).selectExpr("id % 3 as g", "id as k", "id + 1 as _first", "id + 2 as _ROW", "id + 3 as _slice", "id + 4 as _n", "id + 5 as n")
    out = gapless(df, ["g"], ["k"], "n")
    assert sorted(out.columns) == sorted(df.columns)
    assert all(r._first == r.k + 1 and r._ROW == r.k + 2 and r._slice == r.k + 3 and r._n == r.k + 4 for r in out.collect())


def test_hot_keys_are_dealt(spark):
    rows = spark.range(3000).selectExpr("if(id < 2000, -1, id % 50) as g", "id")
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    hot = hot_keys(sizes, "g", "n", 100)
    assert [tuple(r) for r in hot.collect()] == [(-1, 20)]
    out = spread(rows, sizes.where("g < 40"), "g", "id", hot).collect()
    assert sorted(r.id for r in out) == [k for k in range(3000) if k < 2000 or k % 50 < 40] and {r.n for r in out if r.g == -1} == {2000}


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(90)] + [(k, k + 1) for k in range(200, 230)] + [(300, k) for k in range(301, 400)]
    label = np.arange(400)
    neardup.hook(label, *np.array(edges).T)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: label[n] for e in edges for n in e if e[0] != e[1]} | {n: got[n] for n in got}
    assert all(label[n] == c for n, c in got.items())


def test_written_uses_the_shared_folder(spark):
    out = store.written(spark.range(3).toDF("x"), "t")
    assert out.count() == 3 and out.inputFiles()[0].startswith("file:")
    store.dropped(out)
    assert not os.path.exists(out.inputFiles()[0].removeprefix("file://"))


# 1 near-duplicate embeddings


def brute_links(vectors, least=0.9):
    keys = sorted(vectors)
    v = np.array([vectors[k] for k in keys])
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = u @ u.T >= least
    np.fill_diagonal(near, False)
    label = np.arange(len(keys))
    neardup.hook(label, *np.nonzero(near))
    return [(k, int(near[i].sum()), keys[label[i]]) for i, k in enumerate(keys)]


@pytest.mark.parametrize("block", [4096, 23, 20])
def test_near_duplicates(spark, block):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(12, 24))
    rows = {i: (base[i % 12] + rng.normal(size=24) * rng.choice([0.05, 0.2, 0.4])).astype(np.float32).astype(float).tolist() for i in range(110)}
    rows |= {200 + i: rows[3] for i in range(9)}
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<float>")
    got = neardup.near_duplicates(df, block=block).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute_links(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_error_bounds_hold():
    rng = np.random.default_rng(6)
    unit, codes, scale, error = neardup.quantised(rng.normal(size=(200, 48)) * 10.0 ** rng.integers(-6, 6, (200, 1)))
    exact, rough = unit @ unit.T, (codes.astype(float) @ codes.T.astype(float)) * scale[:, None] * scale[None, :]
    assert (np.abs(exact - rough) <= error[:, None] + (1 + error[:, None]) * error[None, :] + 1e-12).all()


def test_near_duplicates_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [1.0, None]), (6, [inf, 0.0]), (7, []), (8, [2.0, 0.1]), (9, [1.0, 0.0, 0.0])]
    rows += [(None, [1.0, 0.0]), (1, [1.0, 0.0])]
    out = neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("kept", F.lit(7)))
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in out.collect()), key=str)
    alone = [(k, 0, k, True) for k in (2, 3, 4, 5, 6, 7, 9)]
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (8, 2, 1, False), (None, 0, None, False), *alone], key=str)
    assert neardup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_rows_that_repeat_a_key(spark):
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (7, [1.0, 0.0]), (9, [0.05, 1.0]), (11, [-1.0, 0.0])]
    out = neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in out)
    assert got == [(5, 1, 5, True), (5, 1, 5, True), (7, 1, 5, False), (9, 1, 5, False), (11, 0, 11, True)]


@pytest.mark.parametrize("few", [0, 16])
def test_doubtful_pairs_are_read_again(few, monkeypatch, tmp_path):
    monkeypatch.setattr(neardup, "FEW", few)
    monkeypatch.setattr(neardup, "TERMS", 40)
    rng = np.random.default_rng(7)
    base = rng.normal(size=16)
    vectors = base / np.linalg.norm(base) + rng.normal(size=(60, 16)) * 0.083  # cosines of about 0.9 with each other
    one = np.ones(30)
    a, b = (neardup.Side(neardup.packed(k, one, v, f"file://{tmp_path}")) for k, v in ((np.arange(30), vectors[:30]), (np.arange(30, 60), vectors[30:])))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.9) & ~np.eye(60, dtype=bool)
    for found, want in ((neardup.tile(a, None, 0.9), near[:30, :30].sum(1)), (neardup.tile(a, b, 0.9), np.concatenate([near[:30, 30:].sum(1), near[:30, 30:].sum(0)]))):
        links = dict(zip(found[0].tolist(), found[1].tolist(), strict=True))
        assert [links.get(k, 0) for k in range(len(want))] == want.tolist() and 50 < want.sum() < 1600


# 2 decontamination


def brute_contamination(rows, items):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = collections.defaultdict(set)
    for item, text in items:
        own = find(text)
        size = min(13, len(own))
        for k in range(len(own) - size + 1 if own else 0):
            windows[tuple(own[k : k + size])].add(str(item))
    sizes, out = {len(w) for w in windows}, []
    for doc, text in rows:
        own, hit, met = find(text), set(), set()
        for size in sizes:
            for k in range(len(own) - size + 1):
                if (found := windows.get(tuple(own[k : k + size]))) is not None:
                    hit.update(range(k, k + size))
                    met |= found
        digest = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        out.append((doc, len(own), len(hit), len(met), digest, bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [500_000, 40])
def test_contaminated(spark, most):
    rng = random.Random(8)
    word = lambda: f"w{rng.randint(0, 300)}"
    items = [(k, " ".join(word() for _ in range(rng.choice([0, 1, 3, 5, 12, 13, 14, 30])))) for k in range(25)] + [(90, None), (91, "-- !"), (None, "w1 w2")]
    rows = []
    for k in range(120):
        own = [word() for _ in range(rng.randint(0, 80))]
        for _, text in rng.sample(items[:25], 2):
            at = rng.randint(0, len(own))
            own[at:at] = text.split() if rng.random() < 0.5 else text.split()[:14]
        rows.append((k, rng.choice([" ", ", ", " — "]).join(own).upper()))
    rows += [(500, None), (501, ""), (500, None)]
    out = decontam.contaminated(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"), most=most)
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = sorted((tuple(r[n] for n in names) for r in out.collect()), key=str)
    assert got == brute_contamination(rows, [x for x in items if x[0] is not None])


def test_contaminated_odd_rows(spark, real):
    none = spark.createDataFrame([], "item_id long, text string")
    out = decontam.contaminated(odd_columns(spark), none, keep_text=True)
    assert out.count() == len(ODD) and not out.where("contaminated").count() and "text" in out.columns and "score" in out.columns
    assert decontam.contaminated(docs(spark, []), none).count() == 0


# 3 substrings


def test_chunks_cover_whole_texts():
    rng = random.Random(9)
    lines = ["".join(rng.choice("abc é—\n") for _ in range(rng.randint(0, 900))) for _ in range(40)] + ["", "x" * 3000, "é" * 777]
    data, at = words.utf8(pa.array(lines))
    start, end = substrings.cuts(data, at)
    assert (start[1:] == end[:-1]).all() and start[0] == 0 and end[-1] == len(data)
    assert set(at[:-1][np.diff(at) > 0]) <= set(start.tolist()) and (end - start).max() <= substrings.FAR + 3
    assert [data[a:b].tobytes().decode() for a, b in zip(start, end, strict=True)]


def test_cuts_resist_an_insertion():
    rng = random.Random(10)
    text = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(400))
    chunks = lambda t: {t[a:b] for a, b in zip(*(x.tolist() for x in substrings.cuts(*words.utf8(pa.array([t])))), strict=True)}
    before, after = chunks(text), chunks(text[:700] + "inserted " + text[700:])
    assert len(before - after) <= 8


def test_repeated_passages_are_found(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("etaoinshrdlué") for _ in range(rng.randint(2, 9)))
    passage = " ".join(word() for _ in range(55))
    rows = []
    for k in range(60):
        own = [word() for _ in range(150)]
        if k % 6 == 0:
            own[70:70] = [passage]
        rows.append((k, " ".join(own)))
    rows += [(100, None), (101, ""), (None, passage)]
    out = {r.doc_id: r for r in substrings.deduplicated(docs(spark, rows)).collect()}
    assert {k for k, r in out.items() if r.n_repeated} == set(range(0, 60, 6))
    for k in range(0, 60, 6):
        text, r = rows[k][1], out[k]
        covered = {i for s in r.repeated_spans.split(",") for i in range(*map(int, s.split(":")))}
        low = text.index(passage)
        # two texts may go on alike for a few characters by chance
        assert covered <= set(range(low - 6, low + len(passage) + 6)) and len(covered) > 0.5 * len(passage)
        assert (r.n_removed == 0) == (k == 0)
        left = "".join(c for i, c in enumerate(text) if not any(a <= i < b for a, b in (map(int, s.split(":")) for s in filter(None, r.removed_spans.split(",")))))
        assert r.text == left
    assert out[100].text is None and out[101].text == "" and out[None].n_repeated == 0


def test_repeated_passages_are_whole(spark):
    rng = random.Random(12)
    rows, passages = [], []
    for k in range(400):
        low, high = ((1, 7), (2, 9), (3, 6), (4, 10))[k % 4]
        word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(low, high)))  # noqa: B023, E731
        passage = " ".join(word() for _ in range(rng.randint(51, 60)))
        own = [[word() for _ in range(rng.randint(30, 90))] for _ in range(4)]
        passages.append(passage)
        rows += [(2 * k + j, " ".join([*own[2 * j], passage, *own[2 * j + 1]])) for j in (0, 1)]
    out = {r.doc_id: r for r in substrings.deduplicated(docs(spark, rows)).collect()}
    found = 0
    for doc, text in rows:
        passage, r = passages[doc // 2], out[doc]
        low = text.index(passage)
        if r.n_repeated:
            # the whole passage in one span, and no more than what goes on alike by chance
            ((a, b),) = (map(int, s.split(":")) for s in r.repeated_spans.split(","))
            assert low - 6 <= a <= low and low + len(passage) <= b <= low + len(passage) + 6
            assert r.text == (text[:a] + text[b:] if doc % 2 else text)
            found += 1
    assert found >= 0.985 * len(rows)


def test_repeats_against_all_windows(spark, real, texts):
    """What is reported occurs again, piece by piece, and of what occurs again across texts nearly all is reported."""
    out = {r.doc_id: r for r in substrings.deduplicated(real).collect()}
    spans = {d: [tuple(map(int, s.split(":"))) for s in filter(None, r.repeated_spans.split(","))] for d, r in out.items()}
    width, seen = 16, collections.Counter()
    for text in texts.values():
        seen.update(text[k : k + width] for k in range(len(text) - width + 1))
    inside = again = 0
    for d, own in spans.items():
        for a, b in own:
            # neighbouring chunks may repeat in different texts, so a window over their border may be new
            places = {j for k in range(a, b - width + 1) if seen[texts[d][k : k + width]] > 1 for j in range(k, k + width)}
            inside, again = inside + b - a, again + len(places)
    assert again >= 0.998 * inside > 1000, (again, inside)
    word = re.compile(r"[^ \t-\r]+")
    words = {d: [m.span() for m in word.finditer(t)] for d, t in texts.items()}
    text_of = lambda d, k: texts[d][words[d][k][0] : words[d][k + 50][1]]  # noqa: E731  51 words and what lies between
    runs = collections.defaultdict(set)
    for d, own in words.items():
        for k in range(len(own) - 50):
            runs[text_of(d, k)].add(d)
    runs = {t: at for t, at in runs.items() if len(at) > 1}
    wanted = caught = 0
    for d, own in words.items():
        repeated = {j for k in range(len(own) - 50) if text_of(d, k) in runs for j in range(k, k + 51)}
        places = {k for a, b in spans[d] for k in range(a, b)}
        wanted, caught = wanted + len(repeated), caught + sum(places.issuperset(range(*own[j])) for j in repeated)
    assert wanted > 500 and caught >= 0.98 * wanted, (caught, wanted)
    # one occurrence of each such run stays: in a text that keeps it, or cut where a longer repeat was
    kept = " ".join(r.text for r in out.values())
    gone = [t for t in runs if t not in kept]
    assert len(gone) <= 0.02 * len(runs), (len(gone), len(runs))


def test_growth_of_a_repeated_key_stays_in_its_text(spark):
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9)))
    passage = " ".join(word() for _ in range(60))
    text = lambda: " ".join([*[word() for _ in range(40)], passage, *[word() for _ in range(40)]])
    rows = [(1, text()), (1, "short"), (2, text()), (3, ""), (3, text())]
    out = substrings.deduplicated(docs(spark, rows)).collect()
    assert len(out) == 5 and sum(passage in r.text for r in out) == 1
    assert {r.n_removed > 0 for r in out if r.doc_id == 2} == {True}


def test_substrings_of_odd_rows(spark):
    assert substrings.deduplicated(odd_columns(spark)).count() == len(ODD)
    assert substrings.deduplicated(docs(spark, [])).count() == 0


# 4 packing


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), min_size=1, max_size=20), st.sampled_from([1, 3, 64]))
def test_plans_place_every_piece(counts, groups):
    plan = packing.Plan(dict(counts), 64, groups=groups)
    load = collections.Counter()
    seen = collections.defaultdict(list)
    for size, a, b, first, per in plan.runs:
        seen[size].append((a, b))
        for i in range(a, b):
            load[first + (i - a) // per] += size
    assert max(load.values()) <= 64 and set(load) == set(range(plan.sequences))
    for size, n in counts.items():
        assert [0, *(b for _, b in sorted(seen[size]))] == [*(a for a, _ in sorted(seen[size])), n]


def test_plans_are_near_the_bound():
    rng = np.random.default_rng(1)
    for lengths in (np.minimum(4096, rng.lognormal(6.3, 1, 60_000).astype(int) + 1), rng.integers(1, 4097, 20_000)):
        plan = packing.Plan(dict(collections.Counter(lengths.tolist())), 4096)
        assert plan.sequences <= 1.003 * (lengths.sum() / 4096) + 1


def fewest(pieces, capacity):
    """The least number of sequences, by dynamic programming over subsets: (sequences, load of the last one)."""
    best = [(0, capacity)] + [(99, 0)] * ((1 << len(pieces)) - 1)
    for mask in range(1, len(best)):
        for k, n in enumerate(pieces):
            if mask >> k & 1:
                many, load = best[mask ^ 1 << k]
                best[mask] = min(best[mask], (many, load + n) if load + n <= capacity else (many + 1, n))
    return best[-1][0]


def test_plans_are_near_the_optimum():
    rng, over = random.Random(2), 0
    for k in range(250):
        low = (1, 6, 11)[k % 3]
        pieces = [rng.randint(low, rng.choice((20, 40))) for _ in range(rng.randint(1, 10))]
        plan, best = packing.Plan(dict(collections.Counter(pieces)), 40, groups=rng.choice((3, 64))), fewest(pieces, 40)
        assert best <= plan.sequences <= best + 1
        over += plan.sequences - best
    assert over <= 20


def test_configurations_solve_the_program():
    found = packing.configurations(np.array([24, 16, 8]), np.array([10.0, 10.0, 20.0]), 40)  # full sequences are possible
    assert sum(n for _, n in found) == 14 and sum(c * n for c, n in found).tolist() == [10, 10, 20]
    rng = np.random.default_rng(3)
    sizes = np.sort(rng.choice(np.arange(1025, 4097), 40, replace=False))[::-1]
    counts = rng.integers(1, 500, 40).astype(float)
    found = packing.configurations(sizes, counts, 4096)
    used = sum(c * n for c, n in found)
    assert (used @ sizes) / 4096 <= sum(n for _, n in found) and all(sizes @ c <= 4096 for c, _ in found)
    assert (counts - used).clip(0).sum() <= 3 * 40  # what rounding down leaves


def test_packed_documents(spark, real, texts):
    out = packing.packed_documents(real, with_ids=True)
    rows = out.collect()
    ids = dict(zip(texts, Encoder(default_path()).whole(list(texts.values())), strict=True))
    for r in rows:
        whole = ids[r.doc_id] + b"\1\0\0\0"
        assert r.ids == whole[4 * r.start : 4 * (r.start + r.length)] and r.ids_crc32 == zlib.crc32(r.ids) and r.start == 4096 * r.piece
    assert sum(r.length for r in rows) == sum(len(x) // 4 + 1 for x in ids.values())
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        ends = [a + n for a, n in sorted(parts)]
        assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 4096
    assert packing.sequences(out).agg(F.sum(F.octet_length("ids"))).first()[0] == 4 * sum(r.length for r in rows)


def test_packing_odd_rows(spark):
    rows = packing.packed_documents(odd_columns(spark)).collect()
    assert collections.Counter(r.doc_id for r in rows if r.length == 1) == {1: 1, 2: 1} and sum(r.doc_id == 3 for r in rows) == 2
    assert packing.packed_documents(docs(spark, [])).count() == 0


# 5 n-gram join


def brute_join(rows):
    sets = {}
    for doc, text in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc] = {tuple(own[k : k + 5]) for k in range(len(own) - 4)} if len(own) >= 5 else ({tuple(own)} if own else set())
    keys = sorted(sets)
    pairs = [(i, j) for i, a in enumerate(keys) for j, b in enumerate(keys[:i]) if (n := len(sets[a] & sets[b])) and 100 * n >= 80 * len(sets[a] | sets[b])]
    label = np.arange(len(keys))
    if pairs:
        neardup.hook(label, *np.array(pairs).T)
    return [(k, len(sets[k]), keys[label[i]]) for i, k in enumerate(keys)]


@pytest.mark.parametrize("tree, bits", [(512, 16), (16, 16), (8, 4)])
def test_linked(spark, tree, bits):
    rng = random.Random(12)
    rows, base = [], [f"w{rng.randint(0, 300)}" for _ in range(60)]
    passage = [f"p{k}" for k in range(40)]
    for k in range(90):
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = f"x{rng.randint(0, 10**6)}"
        rows.append((k, " ".join(own)))
    for k in range(100, 130):  # a shared passage alone doesn't link
        rows.append((k, " ".join([*passage, *(f"y{rng.randint(0, 10**6)}" for _ in range(rng.choice([2, 4, 8, 30])))])))
    rows += [(200, None), (201, ""), (202, "a b"), (203, "A\tb"), (204, "a b c d e"), (205, " \n"), (206, "b a")]
    got = sorted(tuple(r) for r in ngram_join.linked(docs(spark, rows), tree=tree, bits=bits).collect())
    assert got == brute_join(rows)


def test_linked_on_documents(spark, real, texts):
    assert sorted(tuple(r) for r in ngram_join.linked(real).collect()) == brute_join(texts.items())


def test_linked_odd_rows(spark):
    got = ngram_join.linked(odd_columns(spark), bits=8).collect()
    assert len(got) == len(ODD) and {r.component_id for r in got if r.doc_id is None} == {None}
    assert ngram_join.linked(docs(spark, []), bits=8).count() == 0


# 6 WARC


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.mark.parametrize("packed", [True, False])
def test_archives_round_trip(spark, packed, tmp_path):
    big, small = "é<p>" * 400, "tiny"
    rows = [(1, "http://a/ b", big), (2, None, big), (3, "u", small), (4, "u", small), (5, "u", None), (6, "u", ""), (7, "u", big), (7, "u", big), (None, "u", big), (8, "u", "z" * 999), (9, "u", "z" * 999)]
    rows += [(k, "u", f"{k}" * 500) for k in range(100, 140)]
    manifest = warc.write_archives(pages(spark, rows).withColumn("bytes", F.lit(1)), f"file://{tmp_path}/w", packed=packed)
    got = warc.read_archives(manifest).collect()
    assert len(got) == len(rows)
    want = collections.Counter()
    for page, _, html in rows:
        raw = (html or "").encode()
        first = max((p for p, _, h in rows if (h or "").encode() == raw and p is not None), default=None)
        own = len(raw) < 1000 or page == first
        want[page, len(raw), hashlib.sha1(raw).hexdigest(), "response" if own else "revisit", None if own else first] += 1
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert {bytes(r.payload) for r in got if r.record_type == "response"} == {(h or "").encode() for _, _, h in rows}
    assert warc.archived(pages(spark, [])).count() == 0


def number(part):
    return int(part.fields["warc-record-id"][10:-1])


def told(parts, size):
    """(records, gaps, inner gaps); every byte of the file lies in a member or record that was read, or in a gap."""
    parts = list(parts)
    gaps = [(x.at, x.bytes) for x in parts if x.kind == "gap" and not x.inner]
    read = {(x.at, x.bytes) for x in parts if x.kind == "record"}
    ends = sorted(gaps + list(read))
    assert [0, *(a + n for a, n in ends)] == [*(a for a, _ in ends), size]
    return [number(x) for x in parts if x.kind == "record"], gaps, [x.inner for x in parts if x.kind == "gap" and x.inner]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_recovers_later_records(packed, tmp_path):
    rng = random.Random(13)
    raw = [warc.record(k, "u", rng.randbytes(rng.randint(0, 3000)), None, "00" * 20) for k in range(40)]
    parts = [warc.member(x) if packed else x for x in raw]
    at = np.cumsum([0, *map(len, parts)])
    data = bytearray(b"".join(parts))
    data[at[5] + len(parts[5]) // 2] ^= 0xFF  # a flipped bit
    data = bytes(data[: at[12]]) + b"\x1f\x8b\x08 JUNK WARC/1.1 \r\n" * 9 + bytes(data[at[12] : at[20] + 90]) + bytes(data[at[21] : at[39] + 40])
    name = f"{tmp_path}/x.warc" + ".gz" * packed
    open(name, "wb").write(data)
    found, gaps, inner = told(warc.salvage(name), len(data))
    assert found == [k for k in range(39) if k not in (5, 20)] and not inner
    assert gaps[0] == (at[5], len(parts[5])) and gaps[1] == (at[12], 9 * len(b"\x1f\x8b\x08 JUNK WARC/1.1 \r\n")) and gaps[-1][1] == 40 and len(gaps) == 4


def test_salvage_within_members(tmp_path, monkeypatch):
    rng = random.Random(14)
    raw = [warc.record(k, "u", rng.randbytes(rng.randint(0, 3000)), None, "00" * 20) for k in range(60)]
    at = np.cumsum([0, *map(len, raw)])
    bad = bytearray(b"".join(raw[:20]))
    bad[at[7] + 600] ^= 1  # a damaged record in a sound member
    bad[at[13]] ^= 1  # and a damaged version line
    second, third = warc.member(b"".join(raw[20:40])), bytearray(warc.member(b"".join(raw[40:])))
    third[len(third) // 2] ^= 4  # a flipped bit: the member's CRC fails
    data = warc.member(bytes(bad)) + second[: len(second) // 2] + bytes(third) + b"tail"
    for held in (1 << 20, 5000):  # members held whole, and read by stretches
        monkeypatch.setattr(warc, "READ", held)
        monkeypatch.setattr(warc, "PIECE", min(held, 1 << 16))
        open(f"{tmp_path}/x.warc.gz", "wb").write(data)
        found, gaps, inner = told(warc.salvage(f"{tmp_path}/x.warc.gz"), len(data))
        assert [k for k in found if k < 20] == [k for k in range(20) if k not in (7, 13)]
        assert inner[:2] == [(at[7], len(raw[7])), (at[13], len(raw[13]))]
        cut = [k for k in found if 20 <= k < 40]  # what inflates before the cut
        assert cut == list(range(20, 20 + len(cut))) and len(cut) >= 8
        late = [k for k in found if k >= 40]
        assert len(late) >= 9 and gaps[-1][0] + gaps[-1][1] == len(data)
        parts = [x for x in warc.salvage(f"{tmp_path}/x.warc.gz") if x.kind == "record"]
        assert all(x.torn == (number(x) >= 20) for x in parts)
        assert all(warc.record(number(x), "u", x.block.partition(b"\r\n\r\n")[2], None, "00" * 20) == raw[number(x)] for x in parts)


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_does_not_believe_a_length(packed, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "READ", 4096)
    monkeypatch.setattr(warc, "PIECE", 1024)
    rng = random.Random(15)
    raw = [warc.record(k, "u", rng.randbytes(20_000 if k % 7 == 3 else 700), None, "00" * 20) for k in range(30)]
    raw[4] = re.sub(rb"Content-Length: \d+\r\n\r\nHTTP", b"Content-Length: 150000\r\n\r\nHTTP", raw[4], count=1)
    data = warc.member(b"".join(raw)) if packed else b"".join(raw)
    name = f"{tmp_path}/x.warc" + ".gz" * packed
    open(name, "wb").write(data)
    assert told(warc.salvage(name), len(data))[0] == [k for k in range(30) if k != 4]
    large = [x for x in warc.salvage(name, most=10_000) if x.kind == "record"]
    assert [number(x) for x in large] == [k for k in range(30) if k != 4]
    whole = {number(x): x.block.partition(b"\r\n\r\n")[2] for x in warc.salvage(name) if x.kind == "record"}
    for x in large:
        assert (x.payload is not None) == (number(x) % 7 == 3)
        if x.payload:
            assert x.payload == (20_000, hashlib.sha1(whole[number(x)]).hexdigest()) and len(x.block) < 200


def test_damaged_archives_of_the_writer(spark, tmp_path):
    rng = random.Random(16)
    rows = [(k, "u", "".join(rng.choice("abcdefgh <>") for _ in range(rng.randint(1, 4000)))) for k in range(300)]
    manifest = warc.write_archives(pages(spark, rows).repartition(3), f"file://{tmp_path}/w")
    for (path,) in manifest.select("path").collect():
        name = path.removeprefix("file://")
        data = bytearray(open(name, "rb").read())
        assert data[:3] == b"\x1f\x8b\x08" and zlib.decompressobj(31).decompress(bytes(data)).startswith(b"WARC/1.1")  # gzip once
        data[len(data) // 3] ^= 16
        open(name, "wb").write(bytes(data[: len(data) // 2]) + b"junk" * 99 + bytes(data[len(data) // 2 : -30]))
    out = warc.read_archives(manifest).collect()
    good = {r.page_id: bytes(r.payload).decode() for r in out if r.record_type == "response"}
    assert 300 - 3 * manifest.count() <= len(good) < 300 and good.items() <= {k: t for k, _, t in rows}.items() and any(r.gap for r in out)


# 7 toxicity


def test_toxicity_on_held_out_rows(spark):
    folder = SF.replace("0.001", "0.01")
    table = toxicity.op7_toxicity(spark, folder).toPandas().merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id")
    held = table[table.held_out]
    assert (held.held_out == (held.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0))).all()
    right, alarms, toxic = (int(x.sum()) for x in (held.predicted & held.toxic, held.predicted, held.toxic))
    assert toxic >= 5 and right >= 0.9 * alarms and right >= 0.8 * toxic, (right, alarms, toxic)


def plain_grams(text):
    text = f" {(text or '').lower()} "
    return collections.Counter(text[k : k + n] for n in toxicity.SIZES for k in range(len(text) - n + 1))


def test_ratios_and_inputs_are_the_plain_ones(spark):
    rows = [("you fool, you fool", 1), ("a fine day", 0), ("fool", 1), ("", 0), (None, 1), ("fine fine fine fine fine", 0)]
    ratio = toxicity.log_count_ratios(spark.createDataFrame(rows, "text string, toxic int"))
    counts = [collections.Counter(), collections.Counter()]
    place = lambda g: int(toxicity.grams([g])[0][len(toxicity.grams([g])[0]) and [n for n, _ in _own(g)].index(g)])
    for text, toxic in rows:
        counts[toxic] += plain_grams(text)
    totals = [sum(c.values()) for c in counts]
    for gram in ("fool", "fine", "you"):
        n, p = counts[0][gram], counts[1][gram]
        want = np.log((p + 1) / (totals[1] + 1)) - np.log((n + 1) / (totals[0] + 1)) if n + p >= toxicity.LEAST else 0
        assert ratio[place(gram)] == pytest.approx(want)
    feature, value = toxicity.inputs([t for t, _ in rows], ratio)
    for (text, _), f, v in zip(rows, feature, value, strict=True):
        own = plain_grams(text)
        want = {place(g): n * ratio[place(g)] * toxicity.SCALE / sum(own.values()) for g, n in own.items() if ratio[place(g)]}
        assert dict(zip(f.tolist(), v.tolist(), strict=True)) == pytest.approx(want, rel=1e-5)


def _own(gram):
    """The n-grams that grams() makes of a text, in its order."""
    text = f" {gram.lower()} "
    return [(text[k : k + n], k) for n in toxicity.SIZES for k in range(len(text) - n + 1)]


def test_fit_has_no_slope_left():
    rng = np.random.default_rng(4)
    row, feature = np.repeat(np.arange(300), 6), rng.integers(0, 40, 1800)
    value, toxic, weight = rng.normal(size=1800), rng.integers(0, 2, 300).astype(float), rng.choice([1.0, 9.0], 300)
    loss = lambda w, b: weight @ np.logaddexp(0, -(2 * toxic - 1) * (np.bincount(row, weights=value * w[feature]) + b)) / weight.sum()
    slopes, bias = toxicity.fitted(feature, value, row, toxic, weight)
    best = loss(slopes, bias)
    for _ in range(200):
        assert loss(slopes + rng.normal(size=len(slopes)) * 0.1, bias + rng.normal() * 0.1) > best - 1e-3


def test_a_rare_class_is_in_the_sample(spark):
    labels = spark.range(50_000).selectExpr("id as doc_id", "cast(id % 10000 = 77 as int) as toxic")
    some = toxicity.labelled(labels.selectExpr("doc_id", "'x' as text"), labels, 2_000).groupBy("toxic").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"))
    got = {r.toxic: (r.n, r.w) for r in some.collect()}
    assert got[1] == (5, 5.0) and abs(got[0][0] - 1995) < 200 and got[0][1] == pytest.approx(49_995, rel=0.1)


def test_toxicity_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    model = toxicity.train(docs(spark), labels)
    out = toxicity.scored(odd_columns(spark), model).collect()
    assert len(out) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert len({r.score for r in out if not r.text}) == 1
    assert toxicity.scored(docs(spark, []), model).count() == 0


# 8 personal data

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return sorted(out)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab01259.@+- ()%é", max_size=60))
def test_base_spans(text):
    assert sorted(pii.base_spans(text)) == brute_spans(text)


def test_field_finds_more_and_leaves_the_rest():
    field = pii.Field()
    found = lambda t: [(pii.KINDS[k], t[a:b]) for k, a, b in field.spans([t], [pii.base_spans(t)])[0]]
    assert found("ring (212) 555-0188 tonight") == [("phone", "(212) 555-0188")]
    for text in ("in 1999 and 2004", "page 12-15", "version 2.0.1", "Licensed under CC BY-NC 4.0.", "password=90ffe1b2c3d4", "12 500 people", ""):
        assert found(text) == []
    long = "x1 " * 5000
    assert len(field.labels([pii.features(long, r) for r in pii.runs(long)])[0]) == 5000


#: Sentences and values that the field has never seen; [kind text] marks a span.
HELD_OUT = """
my address is [email p.novak@firma.example.cz], write soon
cc [email hello.world@mail-3.example.org] and wait
mail [email backup@nas] if it fails
forward to [email t.okafor@lists.example.edu]!
follow @example on 2 sites
bought 7 @ 2 dollars
gateway [ip 192.0.2.44] replied
ssh to [ip 198.51.100.23] or leave
proxy [ip 192.0.2.9]:3128 is slow
route [ip 10.0.0.0]/8 added
resolver [ip 2001:db8:85a3::99] listens
update 2.4.1 fixes 3 bugs
chapter 10.2.3 begins
printed at 18:45:10 today
the bank blocked [card 4242 4242 4242 4242] yesterday
charge [card 5555555555554444] again
his card [card 6011-0009-9013-9424] was stolen
paid by [card 4222.2222.2222.2220] once
invoice 4242424242424241 is open
order 9876543210987654 came
isbn 978-0-306-40615-7 is sold out
phone [phone +61 2 5550 1234] after 6
call [phone +1 202 555 0147] tonight
office [phone (0161) 496 0753] closed
her cell is [phone 303-555-0111] now
fax [phone 718.555.0126] is broken
ring [phone 0113 496 0247] before noon
tel. [phone 040/6696-9123] bitte
mobile [phone 07700 900 456] only
call [phone (312) 555-0165] or wait
dial [phone 555-0119] for help
hotline [phone 0808 157 0456] is free
tel [phone 02 61 91 34 56] matin
contact [phone 020 7946 0712] first
born 03.11.1975 and died 2010
on 2023-12-01 at 09:15
between 1914 and 1918 they
nearly 37 400 fans came
worth 4,500.50 dollars
seats 14-17 in row 3
won 3-1, then 2-2
the 3rd of 12 parts
commit 9a0b364 and 77 more
md5 0cc175b9c0f1b6a831c399e269772661 differs
uuid 9f1b2c3d-4e5f-4a6b-8c7d-0e1f2a3b4c5d lost
zip 75011 Paris
aged 34 to 56 years
add 3+4 and 5
rows 100 to 2000 were read
at 48.8566 2.3522 exactly
about 20-25 % of 300
model X200-15 sold 90 units
"""


def test_field_on_held_out_lines():
    field, counts = pii.Field(), collections.Counter()
    for line in HELD_OUT.strip().split("\n"):
        assert line not in pii.LABELLED
        text, gold = "", set()
        for part in re.split(r"(\[\w+ [^\]]*\])", line):
            kind, _, inner = part[1:-1].partition(" ")
            if kind in pii.KINDS and part[0] == "[":
                gold.add((pii.KINDS.index(kind), len(text), len(text) + len(inner)))
                part = inner
            text += part
        base = set(pii.base_spans(text))
        added = set(field.spans([text], [sorted(base)])[0])
        assert base <= gold
        counts += collections.Counter(right=len(added & gold), wrong=len(added - gold), missed=len(gold - base - added))
    # what the field adds, beside 12 spans of the patterns: precision and recall
    assert counts["right"] + counts["missed"] >= 12
    assert counts["right"] >= 0.9 * (counts["right"] + counts["wrong"]) and counts["right"] >= 0.9 * (counts["right"] + counts["missed"]), counts


def test_words_are_looked_at_whole():
    tail = "b" * 5000 + "1" * 3
    (seen,) = pii.features(tail, [(0, len(tail))])
    assert "digits 3" in seen and "letters True" in seen


def test_viterbi_is_the_best_path():
    field, rng = pii.Field(), np.random.default_rng(2)
    for run in (["+1", "(988)", "555-2485"], ["4111", "1111", "1111", "1111"], ["a@b"]):
        text = " ".join(run)
        seen = pii.features(text, next(pii.runs(text)))
        score = np.array([field.weight[[field.index[f] for f in w if f in field.index]].sum(0) for w in seen])
        value = lambda p: field.allowed[-1][p[0]] + score[0][p[0]] + sum(field.step[a, b] + field.allowed[a, b] + score[k + 1][b] for k, (a, b) in enumerate(zip(p, p[1:], strict=False)))  # noqa: E731, B023
        best = value(field.labels([seen])[0])
        assert all(value(rng.integers(0, len(pii.TAGS), len(run)).tolist()) <= best + 1e-9 for _ in range(2000))


def test_personal_data(spark, real, texts):
    out = {r.doc_id: r for r in pii.personal_data(real, redact=True).collect()}
    for doc, text in texts.items():
        base = brute_spans(text)
        line = lambda spans: ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)
        r = out[doc]
        assert r.base_sha256 == hashlib.sha256(line(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in range(4)]
        assert set(filter(None, line(base).split(","))) <= set(r.spans.split(","))
        assert not pii.base_spans(r.text) or not base


def test_personal_data_odd_rows(spark):
    out = pii.personal_data(odd_columns(spark), redact=True).collect()
    assert len(out) == len(ODD) and sum(r.text is None for r in out) == 1
    assert pii.personal_data(docs(spark, [])).count() == 0


# 9 Huffman


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=300), st.data())
def test_codes_round_trip(counts, data):
    lengths = huffman.code_lengths(np.array(counts), 16)
    used = np.flatnonzero(counts)
    assert (lengths[used] > 0).all() and lengths.max(initial=0) <= 16 and (2.0 ** -lengths[used].astype(float)).sum() <= 1
    if len(used):
        ids = np.array(data.draw(st.lists(st.sampled_from(used.tolist()), max_size=700)), np.uint32)
        code = huffman.Code(lengths)
        packed, marks, bits = code.pack(ids)
        assert bits == lengths[ids].sum() and len(packed) == (bits + 7) // 8
        assert code.unpack(packed, marks, len(ids)).tolist() == ids.tolist()


def test_code_lengths_are_optimal():
    import heapq

    rng = random.Random(15)
    for limit, n in ((16, 12), (16, 200), (4, 16), (5, 20)):
        counts = [rng.randint(1, 1000) for _ in range(n)]
        lengths = huffman.code_lengths(np.array(counts), limit)
        heap = list(counts)
        heapq.heapify(heap)
        best = 0
        while len(heap) > 1:
            x = heapq.heappop(heap) + heapq.heappop(heap)
            best += x
            heapq.heappush(heap, x)
        total = int((lengths * np.array(counts)).sum())
        assert lengths.max() <= limit and (total == best if limit == 16 else total >= best)
    assert huffman.code_lengths(np.array([1, 1, 2, 4, 8, 16]), 3).max() == 3


@pytest.mark.parametrize("most", [huffman.BLOCK, 700])
def test_encoded_ids(spark, real, texts, most, tmp_path):
    manifest = huffman.encoded_ids(real.repartition(5), folder=f"file://{tmp_path}/f", most=most)
    # the folder alone is enough
    rows = sorted(huffman.read_files(spark.read.parquet(f"file://{tmp_path}/f/manifest")).collect(), key=lambda r: r.doc_id)
    ids = [x + b"\2\0\0\0" for x in Encoder(default_path()).whole([texts[k] for k in sorted(texts)])]
    starts = np.cumsum([0, *(len(x) // 4 for x in ids)]).tolist()
    assert [tuple(r) for r in rows] == [(k, s, len(x) // 4, zlib.crc32(x)) for k, s, x in zip(sorted(texts), starts, ids, strict=False)]
    assert manifest.agg(F.sum("bytes")).first()[0] < 2 * starts[-1] + manifest.count() * 50_000
    paths = [r.path for r in manifest.orderBy("set", "low", "crc").collect()]
    whole = np.frombuffer(b"".join(ids), "<u4")
    at, n = 0, manifest.where(F.col("path") == paths[0]).first().ids
    for at, many in ((0, 5), (127, 2), (128, 128), (699, 900), (n - 3, 9), (n, 4), (13, n)):
        assert huffman.ids_at(paths[0], at, many).tolist() == whole[at : min(at + many, n)].tolist()
    name = paths[0].removeprefix("file://")
    raw = bytearray(open(name, "rb").read())
    for place in (-1, 30):
        raw[place] ^= 1
        open(name, "wb").write(raw)
        with pytest.raises(OSError):
            list(huffman.read_blocks(paths[0]))
        raw[place] ^= 1


def test_encoded_odd_rows(spark):
    rows = huffman.read_files(huffman.encoded_ids(odd_columns(spark))).collect()
    assert len(rows) == len(ODD) and sorted(r.start for r in rows)[0] == 0
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {1} and min(rows, key=lambda r: r.start).doc_id is None
    assert huffman.read_files(huffman.encoded_ids(docs(spark, []))).count() == 0


def test_encoded_long_text(spark):
    text = "Größe 12, ok. " * 400_000  # over a block of ids and several slices of text
    (row,) = huffman.read_files(huffman.encoded_ids(docs(spark, [(7, text)]))).collect()
    ids = Encoder(default_path()).whole(["Größe 12, ok. "])[0] * 400_000 + b"\2\0\0\0"
    assert tuple(row) == (7, 0, len(ids) // 4, zlib.crc32(ids)) and row.n_tokens > huffman.BLOCK


# 10 sharding


def test_sharded(spark, real, texts):
    rows = sharding.sharded(real, [1.0] * 8).collect()
    by = collections.defaultdict(list)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key") and r.grown_shard in (r.shard, 8)
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and len(by) == 8


def drawn(spark, keys, shard):
    """Each key's uniform number for a shard, from Spark's own hash alone."""
    rows = spark.createDataFrame([(k,) for k in keys], "k long").selectExpr("k", f"xxhash64(k, {shard}, 'shard') as h").collect()
    return {r.k: (((r.h % 2**64) >> 11) + 0.5) / 2**53 for r in rows}


def test_the_least_draw_wins(spark, real, texts):
    weights = [1.0, 2.5, 0.0, 0.5]
    rows = sharding.sharded(real, weights, [*weights, 4.0]).collect()
    cost = {s: {k: -np.log(u) / w for k, u in drawn(spark, texts, s).items()} for s, w in enumerate([*weights, 4.0]) if w}
    for r in rows:
        assert r.shard == min((s for s in cost if s < 4), key=lambda s: cost[s][r.doc_id])
        assert r.grown_shard == (4 if cost[4][r.doc_id] < cost[r.shard][r.doc_id] else r.shard)


def test_weights_share_rows(spark):
    df = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    counts = collections.Counter(r.shard for r in sharding.sharded(df, [1.0, 2.0, 0.0, 3.0]).select("shard").collect())
    assert 2 not in counts and all(abs(counts[s] / 30_000 - w / 6) < 0.02 for s, w in ((0, 1), (1, 2), (3, 3)))


def test_sharded_odd_rows(spark):
    out = sharding.sharded(odd_columns(spark).withColumns({c: F.lit(c) for c in ("_first", "_slice", "_n")}), [1.0, 1.0])
    assert {tuple(r) for r in out.select("_first", "_slice", "_n").collect()} == {("_first", "_slice", "_n")} and "_row" in out.columns
    assert out.count() == len(ODD) and {r.size for r in out.where("doc_id in (1, 2)").collect()} == {1}
    assert sharding.sharded(docs(spark, []), [1.0]).count() == 0
    with pytest.raises(ValueError):
        sharding.rendezvous("doc_id", [0.0])
