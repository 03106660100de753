"""Operator 5: exact Jaccard join of n-gram sets with prefix trees."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm.memory import release
from loomspan.llm.neardup import hook
from loomspan.llm.ranks import components, hot_keys, spread
from loomspan.llm.store import dropped, written
from loomspan.llm.words import SOLID, Words, mix, slices

#: Words in a shingle and the least Jaccard similarity as a fraction.
SHINGLE, SHARE = 5, (80, 100)
#: Texts in a tree; counters of the sketch that orders shingles, as a power of two, and per row of it.
TREE, SKETCH_BITS, SKETCH_ROW = 512, 24, 1 << 16
#: A prefix has one token more for each so many of the set's shingles, and so more tokens in common.
SPARE = 20


def shingle_sets(column: pa.Array, n: int = SHINGLE) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes; fewer than n words are one shingle, none are none."""
    words = Words(column, SOLID)
    runs, out = words.runs(n), []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(runs[a : b - n + 1]))
        elif b > a:
            total = np.uint64(b - a)
            for h in words.hash[a:b]:
                total = mix(np.array([total]))[0] ^ h
            out.append(mix(np.array([total])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_id(shingles: np.ndarray) -> int:
    """A 64-bit name of the set: equal sets are one node, and two sets share a name once in 2 ** 64 pairs."""
    return int(mix(np.array([mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(shingles))])).view(np.int64)[0])


def ordered(shingles: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """The set in the global order: by the sketch's level, rare ones first, then by hash."""
    level = sketch[shingles & np.uint64(len(sketch) - 1)].astype(np.uint64)
    return shingles[np.argsort(level << np.uint64(56) | shingles >> np.uint64(8), kind="stable")]


def spare(size):
    """Tokens that two similar sets of at least this size have in common in their prefixes (an int, or a column)."""
    return 1 + size // SPARE if isinstance(size, int) else 1 + F.floor(size / SPARE)


def described(docs: DataFrame, n: int, bits: int) -> DataFrame:
    """(doc_id, size, id, block, counts): a row per document, and rows of each task's counters, compressed.

    A shingle's counter adds up how many documents have it, or another one of the same low bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        counts = np.zeros(1 << bits, np.uint32)
        for rows in slices(batches, "text"):
            sets = shingle_sets(rows.column("text"), n)
            size = np.array([len(s) for s in sets])
            names = [set_id(s) if len(s) else None for s in sets]
            none = pa.nulls(len(sets), pa.int32())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(size), pa.array(names, pa.int64()), none, pa.nulls(len(sets), pa.binary())], names_)
            np.add.at(counts, np.concatenate(sets) & np.uint64((1 << bits) - 1), np.uint32(1))
        blocks = counts.reshape(-1, min(SKETCH_ROW, 1 << bits))
        packed = [zlib.compress(b.tobytes(), 1) for b in blocks]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(packed), pa.int64())] * 3 + [pa.array(np.arange(len(packed), dtype=np.int32)), pa.array(packed, pa.binary())], names_
        )

    names_ = ["doc_id", "size", "id", "block", "counts"]
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, size long, id long, block int, counts binary")


def _added(rows: DataFrame, keys: list[str], kind: type) -> DataFrame:
    """Sums of the counters (of a kind) of equal keys, compressed: rows stream by in the keys' order, so that one sum is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            values = [*([x] for x in now), [zlib.compress(total.tobytes(), 1)]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names)

        now, total = None, None
        for batch in batches:
            for *key, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is not None and key != now:
                    yield done()
                if key != now:
                    now, total = key, 0
                total = total + np.frombuffer(zlib.decompress(counts), kind).astype(np.int64)
        if now is not None:
            yield done()

    names, types = [*keys, "counts"], [pa.int32()] * len(keys) + [pa.binary()]
    by_key = rows.select(*keys, "counts").repartition(*keys).sortWithinPartitions(*keys)
    return by_key.mapInArrow(run, ", ".join(f"{k} int" for k in keys) + ", counts binary")


def sketch_of(table: DataFrame, bits: int) -> np.ndarray:
    """The tasks' counters summed, as levels of eight to a doubling: 2 ** bits bytes, however large the table.

    Sums are made of 64 pieces of a block at most, and again of these, so that no task meets all tasks' pieces of a block."""
    pieces, kind = table.where("block is not null"), np.uint32
    many = pieces.count() // max(1, (1 << bits) // SKETCH_ROW)
    while many > 64:
        many = -(-many // 64)
        pieces = _added(pieces.withColumn("part", F.pmod(F.xxhash64("counts"), F.lit(many)).cast("int")), ["block", "part"], kind)
        kind = np.int64
    out = np.zeros(1 << bits, np.uint8)
    for row in _added(pieces, ["block"], kind).toLocalIterator():
        total = np.frombuffer(zlib.decompress(row.counts), np.int64)
        out[row.block * len(total) : (row.block + 1) * len(total)] = np.minimum(8 * np.log2(1 + total), 255).astype(np.uint8)
    return out


def prefixes(docs: DataFrame, n: int, share: tuple[int, int], sketch) -> DataFrame:
    """(token, id): sets x and y that are similar enough have spare(min(|x|, |y|)) tokens in common here.

    Of a set of s shingles these are the first s - ceil(share * s) + spare(s) in the global order. For were one of that many
    first common shingles behind x's prefix, so would be all later common ones, of which there are more than places there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        order = sketch.value
        for rows in slices(batches, "text"):
            tokens, names, many = [np.zeros(0, np.uint64)], [], []
            for s in shingle_sets(rows.column("text"), n):
                if len(s):
                    tokens.append(ordered(s, order)[: len(s) + (-share[0] * len(s) // share[1]) + spare(len(s))])
                    names.append(set_id(s))
                    many.append(len(tokens[-1]))
            ids = np.repeat(np.array(names, np.int64), np.array(many, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(ids)], ["token", "id"])

    return docs.where("doc_id is not null").select("text").mapInArrow(run, "token long, id long")


class Tree:
    """A compressed prefix tree of sets whose shingles are numbered in the global order, common ones first.

    Each node has a stretch of shingles, its children, the sets that end there, and the least and largest size below."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        order = sorted(range(len(sets)), key=lambda k: sets[k].tolist()[:64])  # any order works; a like start is shared
        self.root: dict = {"own": np.zeros(0, np.int64), "deep": 0, "kids": {}, "ends": []}
        for k in order:
            self._add(k)
        self._bound(self.root)

    def _add(self, k: int) -> None:
        node, left = self.root, self.sets[k]
        while len(left):
            kid = node["kids"].get(int(left[0]))
            if kid is None:
                node["kids"][int(left[0])] = {"own": left, "deep": node["deep"] + len(left), "kids": {}, "ends": [k]}
                return
            most = min(len(left), len(kid["own"]))
            apart = np.flatnonzero(left[:most] != kid["own"][:most])
            same = int(apart[0]) if len(apart) else most
            if same < len(kid["own"]):  # split the stretch
                upper = {"own": kid["own"][:same], "deep": node["deep"] + same, "kids": {int(kid["own"][same]): kid}, "ends": []}
                node["kids"][int(left[0])] = upper
                kid["own"] = kid["own"][same:]
                kid = upper
            node, left = kid, left[same:]
        node["ends"].append(k)

    def _bound(self, root: dict) -> None:
        stack = [(root, False)]
        while stack:
            node, done = stack.pop()
            if not done:
                stack.append((node, True))
                stack += [(kid, False) for kid in node["kids"].values()]
                continue
            sizes = [node["deep"]] * bool(node["ends"]) + [x for kid in node["kids"].values() for x in (kid["least"], kid["most"])]
            node["least"], node["most"] = min(sizes, default=0), max(sizes, default=0)
            node["last"] = int(node["own"][-1]) if len(node["own"]) else -1

    def links(self, wanted, asked: list[int], label: np.ndarray, share: tuple[int, int]) -> list[tuple[int, int]]:
        """Links of the sets `asked` with sets k that wanted(q, k) allows, less those that `label` unites already.

        The path from the root has an overlap with the set asked for, which all sets below share; a subtree goes
        when what is left of either cannot lift it to the least overlap of the smallest set below."""
        mark = np.zeros(1 + max((int(s[-1]) for s in self.sets if len(s)), default=0), bool)
        a, b = share[1] + share[0], share[0]  # |I| * a >= b * (|x| + |y|)
        out = []
        for q in asked:
            own = self.sets[q]
            size = len(own)
            mark[own] = True
            stack = [(self.root, 0)]
            while stack:
                node, common = stack.pop()
                if node["most"] * share[1] < share[0] * size or size * share[1] < share[0] * node["least"]:
                    continue
                if node["ends"] and not node["kids"] and all(label[k] == label[q] or not wanted(q, k) for k in node["ends"]):
                    continue
                common += int(np.count_nonzero(mark[node["own"]]))
                left = min(node["most"] - node["deep"], size - int(np.searchsorted(own, node["last"], "right")))
                if (common + left) * a < b * (size + node["least"]):
                    continue
                for k in node["ends"]:
                    if label[k] != label[q] and wanted(q, k) and common * a >= b * (size + len(self.sets[k])):
                        out.append((q, k))
                        hook(label, np.array([q]), np.array([k]))
                stack += [(kid, common) for kid in node["kids"].values()]
            mark[own] = False
        return out


def _tree_links(group: pa.Table, n: int, share: tuple[int, int], sketch: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links within one group of texts (id, part, ask, text).

    Sets of one part are linked already; only rows with ask are compared with all others."""
    names = group["id"].to_numpy()
    sets = shingle_sets(group["text"].combine_chunks(), n)
    sound = [k for k, s in enumerate(sets) if len(s) and set_id(s) == names[k]]  # a repeated key may bring another text
    names, parts, ask = names[sound], group["part"].to_numpy()[sound], np.asarray(group["ask"].to_pylist(), bool)[sound]
    sets = [sets[k] for k in sound]
    if len(sets) < 2:
        return []
    every = ordered(np.unique(np.concatenate(sets)), sketch)[::-1]  # common ones first, so that like sets start alike
    place = np.argsort(every)
    numbered = [np.sort(place[np.searchsorted(every[place], s)]) for s in sets]
    label = np.arange(len(sets))
    for value in (parts, names):
        _, first = np.unique(value, return_inverse=True)
        lead = np.full(first.max() + 1, len(sets))
        np.minimum.at(lead, first, np.arange(len(sets)))
        hook(label, np.arange(len(sets)), lead[first])
    tree = Tree(numbered)
    wanted = lambda q, k: k > q or not ask[k]  # noqa: E731  each pair once
    found = tree.links(wanted, np.flatnonzero(ask).tolist(), label, share)
    return [(int(names[q]), int(names[k])) for q, k in found]


def tree_join(members: DataFrame, n: int, share: tuple[int, int], sketch) -> DataFrame:
    """(a, b) links from members (g, u, v, id, part, ask, text): each (g, u, v) is one tree, its rows stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(group: list[pa.Table]) -> pa.RecordBatch:
            found = _tree_links(pa.concat_tables(group), n, share, order)
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        release()
        order, group, now = sketch.value, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("g", "u", "v")])
            edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                key = tuple(keys[:, a].tolist())
                if group and key != now:
                    yield done(group)
                    group = []
                now = key
                group.append(pa.Table.from_batches([batch.slice(a, b - a)]))
        if group:
            yield done(group)

    key = ["g", "u", "v"]
    return members.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "a long, b long")


def _dealt(column: str, many) -> F.Column:
    return F.pmod(F.xxhash64(column, F.lit("deal")), many).cast("long")


def linked(docs: DataFrame, n: int = SHINGLE, share: tuple[int, int] = SHARE, tree: int = TREE, bits: int = SKETCH_BITS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of docs (doc_id, text): components of all pairs with
    |intersection| * share[1] >= share[0] * |union| of their shingle sets.

    1. Documents with equal sets are one node. 2. A fixed-size sketch counts shingles over all documents and so orders
    them. 3. Similar sets share tokens of their prefixes (a theorem, whatever the order), so each token's smallest node
    gathers the token's nodes: its star. All similar pairs lie within a star, and nodes with too few shared tokens for
    any link go. 4. Each node goes into the star of most common tokens first, dealt into prefix trees of about `tree` texts that all hold the star's leader. 5. Stars that
    still span components are joined whole: nodes outside the star's largest component, in blocks, against all its
    nodes, in blocks. Only links that unite two components leave a tree, so groups of copies make no pairs.

    Null and empty texts have no shingles and are alone; a null doc_id is alone with a null component; rows that
    repeat a doc_id are taken together; other columns are ignored; an empty table gives an empty result."""
    spark = docs.sparkSession
    table = written(described(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), n, bits), "sets")
    sketch = spark.sparkContext.broadcast(sketch_of(table, bits))
    sets = table.where("block is null").select("doc_id", "size", "id")

    tokens = written(prefixes(docs, n, share, sketch), "prefixes")
    shared = tokens.groupBy("token").agg(F.min("id").alias("g"), F.max("id").alias("top")).where("g < top").select("token", "g")
    hits = written(tokens.join(shared, "token").groupBy("g", "id").agg(F.count(F.lit(1)).alias("n")), "hits")
    dropped(tokens)
    reps = sets.where("id is not null and doc_id is not null").groupBy("id").agg(F.min("doc_id").alias("doc_id"), F.first("size").alias("size"))
    # the smallest set that can be similar is share * size, so fewer tokens in common with all others mean no link
    enough = hits.groupBy("id").agg(F.sum("n").alias("n")).join(reps, "id").where(F.col("n") >= spare(F.ceil(F.col("size") * share[0] / share[1])))
    stars = written(hits.join(enough.select("id"), "id", "left_semi"), "stars")
    many = written(stars.groupBy("g").agg(F.count(F.lit(1)).alias("many")).where("many > 1"), "many")
    hot = hot_keys(many, "g", "many")  # a group of near copies is one star, so joins on g deal its nodes
    stars = spread(stars, many.select("g"), "g", "id", hot)
    # the star with which a node has most tokens in common is its home; a leader is at home in its own one, too
    home = stars.groupBy("id").agg(F.max_by("g", F.struct("n", "g")).alias("g")).withColumn("main", F.lit(True))
    own = stars.where("g = id").select("id", "g").join(home.select("id", "g"), ["id", "g"], "left_anti")
    home = home.unionByName(own.withColumn("main", F.lit(False)))
    sizes = home.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / tree).alias("many"))
    home = spread(home, sizes, "g", "id", hot).join(reps.select("id", "doc_id"), "id")
    # a star's leader is in all of its trees
    deal = F.when(F.col("id") == F.col("g"), F.sequence(F.lit(0).cast("long"), F.col("many") - 1)).otherwise(F.array(_dealt("id", F.col("many"))))
    home = home.select("doc_id", "id", "g", "main", F.posexplode(deal).alias("k", "u"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(home, "doc_id")
    texts = written(texts.select("g", "u", "id", (F.col("main") & (F.col("k") == 0)).alias("main"), "text"), "texts")
    first = texts.select("g", "u", F.lit(0).cast("long").alias("v"), "id", F.col("id").alias("part"), F.lit(True).alias("ask"), "text")
    links = written(tree_join(first, n, share, sketch), "links")
    parts = written(components(links), "parts")

    found = stars.join(parts.withColumnRenamed("node", "id"), "id", "left").select("g", "id", F.coalesce("component", "id").alias("part"))
    split = found.groupBy("g").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("g")
    found = written(spread(found, split, "g", "id", hot), "open")
    if not found.isEmpty():
        links = links.unionByName(_rest(found, hot, texts.where("main").select("id", "text"), n, share, sketch, tree))
        parts = components(links)

    named = reps.join(parts.withColumnRenamed("node", "id"), "id", "left").select("id", "doc_id", F.coalesce("component", "id").alias("class"))
    least = named.groupBy("class").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    classes = spread(named, least.drop("n"), "class", "id", hot_keys(least, "class", "n")).select("id", "component_id")
    full = sets.where("id is not null")  # a class of near copies, and a set of exact ones, may have a third of all rows
    copies = hot_keys(full.groupBy("id").agg(F.count(F.lit(1)).alias("n")), "id", "n")
    out = spread(full, classes, "id", "doc_id", copies, "left").select("doc_id", "size", "component_id")
    out = out.unionByName(sets.where("id is null").select("doc_id", "size", F.lit(None).cast("long").alias("component_id")))
    alone = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", F.col("size").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), alone).alias("component_id"))


def _rest(found: DataFrame, hot: DataFrame, texts: DataFrame, n: int, share: tuple[int, int], sketch, tree: int) -> DataFrame:
    """Links between the components that still meet in a star (g, id, part).

    A missing link joins two components, so one end lies outside the star's largest one: those nodes ask."""
    by_part = found.groupBy("g", "part").agg(F.count(F.lit(1)).alias("n"))
    most = by_part.groupBy("g").agg(F.max_by("part", F.struct("n", "part")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("in_main"))
    many = {"us": F.ceil((F.col("all") - F.col("in_main")) / tree), "vs": F.ceil(F.col("all") / tree)}
    rows = spread(found, most, "g", "id", hot).withColumns(many).withColumn("ask", F.col("part") != F.col("main"))
    zero = F.lit(0).cast("long")
    keys = ["g", "id", "part", "us", "vs"]
    asking = rows.where("ask").select(*keys, _dealt("id", F.col("us")).alias("u")).withColumn("v", F.explode(F.sequence(zero, F.col("vs") - 1)))
    others = rows.select(*keys, _dealt("id", F.col("vs")).alias("v")).withColumn("u", F.explode(F.sequence(zero, F.col("us") - 1)))
    kinds = asking.select("g", "u", "v", "id", "part", F.lit(True).alias("ask")).unionByName(others.select("g", "u", "v", "id", "part", F.lit(False).alias("ask")))
    # a node that asks within its own block is there once, asking
    once = kinds.groupBy("g", "u", "v", "id", "part").agg(F.max("ask").alias("ask"))
    return tree_join(once.join(texts, "id").select("g", "u", "v", "id", "part", "ask", "text"), n, share, sketch)


def op5_ngram_join(spark, sf_dir: str) -> DataFrame:
    return linked(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
