"""An index of intervals by breakpoints: joins of interval tables that look it up by binary search, and sums that need no pairs.

The coordinates at which intervals begin or have ended cut a stretch into pieces in which the set of live intervals doesn't change. The
set is kept at each piece where few intervals are live, and at fewer pieces where many are, so that all sets together stay in
proportion to the intervals; what begins after a kept piece is a range of the intervals in order of start. A look-up is two binary searches
and reads little more than what it finds, however long the intervals are."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Coordinates of a tile, rows of a side that a task gets together, live intervals up to which every piece keeps its set, candidates
#: looked at together, rows of a batch that is passed on, and rows of both sides that are indexed and looked up together.
TILE, TOGETHER, FEW, CANDIDATES, PASSED, INDEXED = 1 << 16, 1 << 18, 8, 1 << 20, 1 << 14, 1 << 16
#: A tile is dealt out only if it has more than a HOT-th of all rows, so fewer than HOT are.
HOT = 4096


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (n[0] numbers), then first[1], ..."""
    upto = np.cumsum(n)
    return np.arange(upto[-1] if len(n) else 0) + np.repeat(first - (upto - n), n)


class Breakpoints:
    """Closed intervals, indexed."""

    def __init__(self, start: np.ndarray, end: np.ndarray):
        self.order = np.argsort(start, kind="stable")
        self.start, self.end, self.ends = start[self.order], end[self.order], np.sort(end)
        pieces = np.unique(np.concatenate([start, end + 1]))
        live = np.searchsorted(self.start, pieces, "left") - np.searchsorted(self.ends, pieces, "left")
        place = np.cumsum(1 / np.maximum(1, live / FEW)).astype(np.int64)
        self.kept = pieces[np.diff(place, prepend=-1) > 0]
        self.after = np.searchsorted(self.start, self.kept, "left")
        # an interval is live across the kept pieces that begin within it
        low = np.searchsorted(self.kept, self.start, "right")
        n = np.searchsorted(self.kept, self.end, "right") - low
        piece = _ranges(low, n)
        self.cover = np.repeat(np.arange(len(n)), n)[np.argsort(piece, kind="stable")]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(piece, minlength=len(self.kept)))])

    def pairs(self, start: np.ndarray, end: np.ndarray, late: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(asked, interval) numbers of those that meet, some at a time; where `late` holds, only intervals that begin within the asked one."""
        at = np.searchsorted(self.kept, start, "right") - 1
        known = at >= 0
        at = np.maximum(at, 0)
        if not len(self.kept):
            return
        held = np.where(known, self.first[at + 1] - self.first[at], 0)
        low = np.where(known, self.after[at], 0)
        if late is not None:
            held, low = np.where(late, 0, held), np.where(late, np.searchsorted(self.start, start, "left"), low)
        more = np.maximum(np.searchsorted(self.start, end, "right") - low, 0)
        upto, row = np.cumsum(held + more), 0
        while row < len(start):
            done = upto[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(upto, done + CANDIDATES, "right")))
            part = slice(row, stop)
            asked = np.arange(row, stop)
            i = np.concatenate([np.repeat(asked, held[part]), np.repeat(asked, more[part])])
            j = np.concatenate([self.cover[_ranges(self.first[at[part]], held[part])], _ranges(low[part], more[part])])
            meet = (self.end[j] >= start[i]) & (self.start[j] <= end[i])
            yield i[meet], self.order[j[meet]]
            row = stop


def _placed(df: DataFrame, on: Sequence[str], start: str, end: str, tile: int, keep: dict[str, Column] | None = None, copied: bool = True) -> DataFrame:
    """(row, on as _0, _1, ..., s, e, home, tile): one row per tile that an interval touches, or only the first. keep: other columns in place of row."""
    place = lambda c: F.floor(F.col(c) / tile)
    rows = df.where(f"`{start}` <= `{end}`").select(
        *[c.alias(n) for n, c in ({"row": F.struct(*df.columns)} if keep is None else keep).items()], *[F.col(c).alias(f"_{k}") for k, c in enumerate(on)], F.col(start).cast("long").alias("s"), F.col(end).cast("long").alias("e"),
        place(start).alias("home"), place(end).alias("last"),
    )
    for k in range(len(on)):
        rows = rows.where(f"_{k} is not null")
    return rows.withColumn("tile", F.explode(F.sequence("home", "last")) if copied else F.col("home")).drop("last")


def _crowded(rows: DataFrame, keys: list[str], out: str) -> DataFrame:
    """(keys, parts): the tiles that must be dealt out, fewer than HOT."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.agg(F.greatest(F.lit(TOGETHER), F.coalesce(F.sum("n"), F.lit(0)) / HOT).alias("most"))
    sizes = sizes.crossJoin(F.broadcast(most))  # one row
    return sizes.where("n > most").select(*keys, F.ceil(F.col("n") / F.col("most")).alias(out))


def _dealt(x: DataFrame, y: DataFrame, on: Sequence[str], x_hash: Column, y_hash: Column) -> tuple[DataFrame, DataFrame]:
    """Both placed sides with group, a hash of what meets: a tile, or a cell of a crowded one, whose rows the hashes deal."""
    keys = [*(f"_{k}" for k in range(len(on))), "tile"]
    for rows, own in ((x, "x_parts"), (y, "y_parts")):
        hot = F.broadcast(_crowded(rows, keys, own))
        x, y = x.join(hot, keys, "left"), y.join(hot, keys, "left")
    n = {c: F.coalesce(F.col(c), F.lit(1)) for c in ("x_parts", "y_parts")}
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), n[c] - 1))
    one = lambda hashed, c: F.when(n[c] > 1, F.pmod(hashed, n[c])).otherwise(0)
    x = x.withColumn("_x", one(x_hash, "x_parts")).withColumn("_y", every("y_parts"))
    y = y.withColumn("_y", one(y_hash, "y_parts")).withColumn("_x", every("x_parts"))
    group = F.shiftleft(F.xxhash64(*keys, "_x", "_y"), 1)  # even, so that group + 1 comes between groups
    return x.withColumn("group", group), y.withColumn("group", group)


def _within(tile: int) -> tuple[Callable[[int], Column], Column]:
    """(s, e) of a placed row within its tile, from 1 on; s is of what began before the tile: 0 for a feature, 1 for an asking row."""
    place = lambda c: (F.col(c) - F.col("tile") * tile + 1).cast("int")
    last = F.least(F.col("e") - F.col("tile") * tile + 1, F.lit(tile)).cast("int").alias("e")
    return lambda before: F.when(F.col("tile") > F.col("home"), before).otherwise(place("s")).alias("s"), last


def _met(left: DataFrame, right: DataFrame, on: Sequence[str], a: tuple[str, str], b: tuple[str, str], tile: int) -> DataFrame:
    """Both sides go to the tiles that they touch, features (kind 0) before what asks for them (kind 1), and a task indexes the features of some
    tiles, or of a large one, at a time while the asking rows stream by. A pair is made in the tile in which the later of both begins. Crowded tiles are
    dealt out as a rectangle: each part of one side meets each part of the other once."""
    hashed = lambda df: F.xxhash64("s", "e", *[F.col("row")[f.name] for f in df.schema if "map<" not in f.dataType.simpleString()])
    x, y = _dealt(_placed(left, on, *a, tile), _placed(right, on, *b, tile), on, hashed(left), hashed(right))
    group, late = F.col("group"), F.col("tile") > F.col("home")
    begin, last = _within(tile)
    none = lambda df: F.lit(None).cast(df.schema)
    asks = x.select(group, F.lit(1).alias("kind"), begin(1), last, late.alias("late"), F.col("row").alias("l"), none(right).alias("r"))
    places = y.select(group, F.lit(0).alias("kind"), begin(0), last, late.alias("late"), none(left).alias("l"), F.col("row").alias("r"))
    both = places.unionByName(asks).repartition("group").sortWithinPartitions(F.col("group") + F.col("kind"))

    return both.mapInArrow(lambda batches: _by_group(batches, lambda rows: _found(rows, tile)), T.StructType([T.StructField("l", left.schema), T.StructField("r", right.schema)]))


def _by_group(batches: Iterator[pa.RecordBatch], found: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """What `found` makes of rows in order of group, many at a time; rows that go on with a group come with its features again."""
    known, new, n = None, [], 0  # features of the last group so far, and what came since
    for batch in batches:
        new.append(batch)
        n += batch.num_rows
        if n >= max(INDEXED, known.num_rows if known else 0):
            rows = pa.concat_batches([known, *new] if known else new)
            yield from found(rows)
            known, new, n = _unfinished(rows), [], 0
    if new:
        yield from found(pa.concat_batches([known, *new] if known else new))


def _unfinished(rows: pa.RecordBatch) -> pa.RecordBatch:
    """The features of the last group, for which more rows may ask."""
    group, kind = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("group", "kind"))
    own = np.flatnonzero((group == group[-1]) & (kind == 0))
    return rows.take(pa.array(own))


def _found(rows: pa.RecordBatch, tile: int) -> Iterator[pa.RecordBatch]:
    """(l, r) of all groups of the rows by one index: each group has a stretch of `tile` + 1 places of its own."""
    group, kind, s, e, late = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("group", "kind", "s", "e", "late"))
    base = np.concatenate([[0], np.cumsum(np.diff(group) != 0)]).astype(np.int64) * (tile + 1)
    f, a = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
    if not len(f) or not len(a):
        return
    index = Breakpoints(base[f] + s[f], base[f] + e[f])
    left, right = rows.column("l"), rows.column("r")
    for i, j in index.pairs(base[a] + s[a], base[a] + e[a], late[a]):
        for k in range(0, len(i), PASSED):
            yield pa.RecordBatch.from_arrays([left.take(pa.array(a[i[k : k + PASSED]])), right.take(pa.array(f[j[k : k + PASSED]]))], ["l", "r"])


def overlap_counts(
    asks: DataFrame, places: DataFrame, on: Sequence[str], a: tuple[str, str], b: tuple[str, str], after: str, kind: str, names: Sequence[str], tile: int = TILE
) -> DataFrame:
    """(on, b, and a count for each of `names`): for every interval of places, whose rows are distinct, the rows of asks that meet it and
    whose `after` is null or less than its start; `kind` is the number of the name that a row counts for. Places that nothing meets are left out.

    A task makes the pairs and keeps sums, so neither pairs nor more of a row than its numbers leave it. Tiles as in overlapping()."""
    names, n = list(names), len(names)
    hashed = F.xxhash64(*[c for c, t in asks.dtypes if "map<" not in t])
    x = _placed(asks, on, *a, tile, {"hash": hashed, "x": F.col(after).cast("long"), "k": F.col(kind).cast("int")})
    y = _placed(places.select(*on, *b), on, *b, tile, {"hash": F.xxhash64(*on, *b)})
    x, y = _dealt(x, y, on, F.col("hash"), F.col("hash"))
    begin, last = _within(tile)
    keys = [f"_{k}" for k in range(len(on))]
    late, none = F.col("tile") > F.col("home"), F.lit(None).cast("long")
    # kind 0 is a place, then 1 + 2 * kind + late; x is a place's start or an asking row's `after`
    asked = x.select("group", *keys, (1 + 2 * F.col("k") + late.cast("int")).alias("kind"), begin(1), last, "x", none.alias("y"))
    known = y.select("group", *keys, F.lit(0).alias("kind"), begin(0), last, F.col("s").alias("x"), F.col("e").alias("y"))
    # one number is sorted by its digits, places of a group before what asks for them
    rows = known.unionByName(asked).repartition("group").sortWithinPartitions(F.col("group") + (F.col("kind") > 0).cast("long"))
    met = rows.mapInArrow(lambda batches: _by_group(batches, lambda part: _counted(part, keys, tile, n)), T.StructType(
        [*(T.StructField(f"_{k}", places.schema[c].dataType) for k, c in enumerate(on)), T.StructField("x", T.LongType()), T.StructField("y", T.LongType()), *(T.StructField(f"n{k}", T.LongType()) for k in range(n))]
    ))
    sums = met.groupBy(*keys, "x", "y").agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(n)])
    bound = lambda c, name: F.col(c).cast(places.schema[name].dataType).alias(name)
    return sums.select(*[F.col(k).alias(c) for k, c in zip(keys, on, strict=True)], bound("x", b[0]), bound("y", b[1]), *[F.col(f"n{k}").alias(c) for k, c in enumerate(names)])


def _counted(rows: pa.RecordBatch, keys: list[str], tile: int, n: int) -> Iterator[pa.RecordBatch]:
    """(keys, x, y, n counts) of the places of all groups that an asking row meets."""
    group, kind, s, e = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("group", "kind", "s", "e"))
    same = np.diff(group) == 0
    base = np.concatenate([[0], np.cumsum(~same)]).astype(np.int64) * (tile + 1)
    # groups are hashed: if two fell together, keys are compared
    own = rows.select(keys)
    mixed = any((same & pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)).any() for c in own.columns)
    f, a = np.flatnonzero(kind == 0), np.flatnonzero(kind)
    if not len(f) or not len(a):
        return
    x = pc.fill_null(rows.column("x"), np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
    start, after, of = x[f], x[a], (kind[a] - 1) >> 1
    index, counts = Breakpoints(base[f] + s[f], base[f] + e[f]), np.zeros(len(f) * n, np.int64)
    for i, j in index.pairs(base[a] + s[a], base[a] + e[a], (kind[a] - 1) & 1 == 1):
        first = start[j] > after[i]
        for c in own.columns if mixed else ():
            first &= pc.equal(c.take(pa.array(f[j])), c.take(pa.array(a[i]))).to_numpy(zero_copy_only=False)
        np.add.at(counts, j[first] * n + of[i[first]], 1)
    counts = counts.reshape(-1, n)
    some = np.flatnonzero(counts.any(1))
    met = rows.select([*keys, "x", "y"]).take(pa.array(f[some]))
    yield pa.RecordBatch.from_arrays([*met.columns, *(pa.array(counts[some, k]) for k in range(n))], [*met.schema.names, *(f"n{k}" for k in range(n))])


#: What a block asks of a place (compatible_counts): to begin with it, to end with it; that it counts for the second number; that its mate is behind it, before it.
BEGINS, ENDS, SECOND, UP, DOWN = 1, 2, 4, 8, 16
#: Lower bits of a row's order: 0 for a place, from 1 on a hash of the read that asks. Pairs that a task makes distinct at a time.
READS, DISTINCT = 23, 1 << 22


def compatible_counts(
    asks: DataFrame, places: DataFrame, on: Sequence[str], a: tuple[str, str], b: tuple[str, str], read: str, kind: str, names: tuple[str, str], limit: str | None = None, tile: int = TILE
) -> DataFrame:
    """(on, b, and two counts): every distinct interval of places, with the reads of which a row of asks lies within it, as its `kind` asks.

    kind is a sum of BEGINS, ENDS, SECOND, UP and DOWN. A read counts once for each number, if one such row is neither UP nor DOWN, one that is UP or DOWN and
    whose `limit` is behind or before the place, or one of each. Rows without an `on` or a bound, or that end before they begin, are left out on both sides.

    Asking rows go to the tile that they begin in, dealt out by read, places to all tiles that they touch. Where a place has one cell, the cell
    tells its counts as they are; only counts of places in crowded tiles, and the reads of places that touch several tiles, are shuffled again."""
    x = _placed(asks, on, *a, tile, {"read": F.col(read), "k": F.col(kind).cast("int"), **({"limit": F.col(limit).cast("long")} if limit else {})}, copied=False)
    y = _placed(places.select(*on, *b), on, *b, tile, {})
    keys = [f"_{k}" for k in range(len(on))]
    x, y = _dealt(x, y, on, F.xxhash64("read"), F.xxhash64(*keys, "s", "e"))
    low = (1 << READS) - 1
    order = lambda sub: F.col("group").bitwiseAND(~low).bitwiseOR(sub).alias("order")
    # asking rows have odd kinds; places 0 if one cell tells all, 2 if counts of cells are added, 4 if reads of several tiles are made distinct
    several = F.when(F.col("home") != F.floor(F.col("e") / tile), 4).when(F.coalesce(F.col("x_parts"), F.lit(1)) > 1, 2).otherwise(0)
    asked = x.select(order(F.pmod(F.xxhash64("read"), F.lit(low)) + 1), *keys, "tile", "s", "e", (2 * F.col("k") + 1).alias("kind"), "read", *(["limit"] if limit else []))
    known = y.select(order(F.lit(0).cast("long")), *keys, "tile", "s", "e", several.alias("kind"))
    rows = known.unionByName(asked, allowMissingColumns=True).repartition(F.shiftright("order", READS)).sortWithinPartitions("order")
    of = [T.StructField(k, places.schema[c].dataType) for k, c in zip(keys, on, strict=True)] + [T.StructField(c, T.LongType()) for c in ("s", "e", *names)]
    who = [T.StructField("read", asks.schema[read].dataType), *(T.StructField(c, T.BooleanType()) for c in ("second", "sure", "up", "down"))]
    # both read the same shuffle
    whole = rows.mapInArrow(lambda batches: _compatible(batches, keys, tile, names, True), T.StructType(of))
    parts = rows.mapInArrow(lambda batches: _compatible(batches, keys, tile, names, False), T.StructType(of + who))
    some = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    parts = parts.groupBy(*keys, "s", "e", "read", "second").agg(*[F.sum(c).alias(c) for c in names], (some("sure") | (some("up") & some("down"))).alias("fits"))
    one = lambda second: (F.col("fits") & (F.col("second") == second)).cast("long")
    parts = parts.groupBy(*keys, "s", "e").agg(*[F.sum(F.col(c) + F.coalesce(one(bool(k)), F.lit(0))).alias(c) for k, c in enumerate(names)])
    bound = lambda c, name: F.col(c).cast(places.schema[name].dataType).alias(name)
    return whole.unionByName(parts).select(*[F.col(k).alias(c) for k, c in zip(keys, on, strict=True)], bound("s", b[0]), bound("e", b[1]), *names)


def _compatible(batches: Iterator[pa.RecordBatch], keys: list[str], tile: int, names: Sequence[str], whole: bool) -> Iterator[pa.RecordBatch]:
    """The counts of places that one cell tells (whole), or else counts and reads of the other places.

    Rows come in order of group and read. They are cut between reads, so each read of a cell is seen at once; places of a group that goes on are kept with their counts."""
    cells, new, n, need = _Cells(keys, tile, names, whole), [], 0, INDEXED
    for batch in batches:
        new.append(batch)
        n += batch.num_rows
        if n < need:
            continue
        rows = pa.concat_batches(new)
        order = rows.column("order").to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(order, order[-1], "left"))
        rest = rows.slice(cut)
        if n - cut > INDEXED:  # many rows of one read, or of one group's places
            rest = pa.Table.from_batches([rest]).group_by(rest.schema.names).aggregate([]).select(rest.schema.names).combine_chunks()
            rest = pa.concat_batches(rest.to_batches())
        if cut > cells.known:
            yield from cells.counted(rows.slice(0, cut), order[-1] >> READS if order[-1] & ((1 << READS) - 1) else None)
            new = [*cells.places, rest]
        else:
            new = [rows.slice(0, cut), rest]
        n = sum(b.num_rows for b in new)
        need = n + max(INDEXED, n)
    if n:
        yield from cells.counted(pa.concat_batches(new), None)


class _Cells:
    """Places of cells and their counts."""

    def __init__(self, keys: list[str], tile: int, names: Sequence[str], whole: bool):
        self.keys, self.tile, self.names, self.whole = keys, tile, list(names), whole
        self.known, self.places, self.counts = 0, [], np.zeros((0, 2), np.int64)

    def counted(self, rows: pa.RecordBatch, goes_on: int | None) -> Iterator[pa.RecordBatch]:
        """What is known of the places of all groups but the one that goes on, whose places are kept and come first in the next rows."""
        group, kind = rows.column("order").to_numpy(zero_copy_only=False) >> READS, rows.column("kind").to_numpy(zero_copy_only=False)
        wanted = (kind == 0) if self.whole else (kind & 1 == 0) & (kind > 0)
        rows = rows.filter(pa.array(wanted | ((kind & 1 == 1) & np.isin(group, group[wanted]))))
        held, self.known, self.places = self.counts, 0, []
        if not rows.num_rows:
            return
        order, kind, s, e, t = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("order", "kind", "s", "e", "tile"))
        group, f, a = order >> READS, np.flatnonzero(kind & 1 == 0), np.flatnonzero(kind & 1)
        cell = _ids(group, *[_codes(rows.column(c)) for c in self.keys], t)  # groups are hashed: two may have fallen together
        # distinct places; those kept from before come first among the rows
        by = np.lexsort((e[f], s[f], cell[f]))
        g = f[by]
        fresh = np.concatenate([[True], (np.diff(cell[g]) != 0) | (np.diff(s[g]) != 0) | (np.diff(e[g]) != 0)])
        own = np.empty(len(f), np.int64)
        own[by] = np.cumsum(fresh) - 1
        f = g[fresh]
        counts = np.zeros((len(f), 2), np.int64)
        counts[own[: len(held)]] += held
        if len(a):
            yield from self._read(rows, cell, s, e, t, kind, f, a, counts)
        stays = group[f] == goes_on if goes_on is not None else np.zeros(len(f), bool)
        if stays.any():
            self.places, self.counts, self.known = [rows.take(pa.array(f[stays]))], counts[stays], int(stays.sum())
        else:
            self.counts = np.zeros((0, 2), np.int64)
        if not stays.all():
            yield self._batch(rows, f[~stays], counts[~stays])

    def _batch(self, rows: pa.RecordBatch, at: np.ndarray, counts: np.ndarray, who: Sequence[pa.Array] = ()) -> pa.RecordBatch:
        found = rows.select([*self.keys, "s", "e"]).take(pa.array(at))
        if not self.whole and not who:
            who = [pa.nulls(len(at), rows.schema.field("read").type), *(pa.nulls(len(at), pa.bool_()) for _ in range(4))]
        new = [*found.columns, *(pa.array(counts[:, k]) for k in range(2)), *who]
        return pa.RecordBatch.from_arrays(new, [*found.schema.names, *self.names, *(["read", "second", "sure", "up", "down"] if who else [])])

    def _read(self, rows, cell, s, e, t, kind, f, a, counts) -> Iterator[pa.RecordBatch]:
        """Reads of the asking rows are added to the counts of their places, or come out where a place touches several tiles."""
        asks = kind[a] >> 1
        readers = _codes(rows.column("read").take(pa.array(a)))
        who, limit = readers * 2 + (asks & SECOND > 0), None
        if "limit" in rows.schema.names:
            limit = rows.column("limit").take(pa.array(a))
            none = pc.is_null(limit).to_numpy(zero_copy_only=False)
            limit = pc.fill_null(limit, 0).to_numpy(zero_copy_only=False)
        # where a bound is asked for, the places with just this bound; else all that the row meets
        finders = []
        for asked, c in ((asks & BEGINS > 0, s), (asks & (BEGINS | ENDS) == ENDS, e)):
            ids = _ids(cell[np.concatenate([f, a])], c[np.concatenate([f, a])])
            finders.append((asked, _Equal(ids[: len(f)]), lambda at, ids=ids: (ids[len(f) + at],)))
        base = cell * (self.tile + 1)
        asked = asks & (BEGINS | ENDS) == 0
        if asked.any():
            begin = lambda at: base[at] + np.maximum(s[at] - t[at] * self.tile + 1, 0)
            last = lambda at: base[at] + np.minimum(e[at] - t[at] * self.tile + 1, self.tile)
            finders.append((asked, Breakpoints(begin(f), last(f)), lambda at: (begin(a[at]), last(a[at]))))

        def pairs(low: int, high: int, most: float) -> tuple[np.ndarray, np.ndarray] | None:
            out, n = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
            for asked, index, place in finders:
                at = low + np.flatnonzero(asked[low:high])
                for i, j in index.pairs(*place(at)) if len(at) else ():
                    i, ways = at[i], asks[at[i]]
                    fs, fe, x, y = s[f[j]], e[f[j]], s[a[i]], e[a[i]]
                    fits = (fs <= x) & (y <= fe) & ((ways & BEGINS == 0) | (fs == x)) & ((ways & ENDS == 0) | (fe == y))
                    out.append((i[fits], j[fits]))
                    n += len(out[-1][0])
                    if n > most:
                        return None
            return np.concatenate([i for i, _ in out]), np.concatenate([j for _, j in out])

        order = rows.column("order").to_numpy(zero_copy_only=False)[a]
        begins = np.concatenate([np.flatnonzero(np.diff(order, prepend=order[0] - 1)), [len(a)]])  # of reads, by their hash
        todo = [(0, len(begins) - 1)]
        while todo:
            low, high = todo.pop()
            got = pairs(begins[low], begins[high], DISTINCT if high - low > 1 else np.inf)
            if got is None:
                todo += [((low + high) // 2, high), (low, (low + high) // 2)]
                continue
            i, j = got
            if not len(i):
                continue
            n = int(who.max()) + 1
            pair, first, back = np.unique(j * n + who[i], return_index=True, return_inverse=True)
            place, second = pair // n, (who[i[first]] & 1).astype(bool)
            up, down = asks[i] & UP > 0, asks[i] & DOWN > 0
            sure = ~(up | down)
            if limit is not None:
                sure |= ~none[i] & np.where(up, e[f[j]] < limit[i], s[f[j]] > limit[i])
            some = lambda x: np.bincount(back.ravel(), x, len(pair)) > 0
            sure, up, down = (some(x) for x in (sure, up, down))
            far = kind[f[place]] == 4
            fits = (sure | (up & down)) & ~far
            np.add.at(counts, (place[fits], second[fits].astype(np.int64)), 1)
            if far.any():
                read = rows.column("read").take(pa.array(a[i[first[far]]]))
                yield self._batch(rows, f[place[far]], np.zeros((int(far.sum()), 2), np.int64), [read, *(pa.array(x[far]) for x in (second, sure, up, down))])


class _Equal:
    """Numbers, looked up by equal ones; as Breakpoints, pairs come some at a time."""

    def __init__(self, known: np.ndarray):
        self.order = np.argsort(known, kind="stable")
        self.known = known[self.order]

    def pairs(self, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        low = np.searchsorted(self.known, asked, "left")
        n = np.searchsorted(self.known, asked, "right") - low
        upto, row = np.cumsum(n), 0
        while row < len(asked):
            stop = max(row + 1, int(np.searchsorted(upto, (upto[row - 1] if row else 0) + CANDIDATES, "right")))
            part = slice(row, stop)
            yield np.repeat(np.arange(row, stop), n[part]), self.order[_ranges(low[part], n[part])]
            row = stop


def _codes(column: pa.Array) -> np.ndarray:
    """A number for each distinct value, null too."""
    return pc.dictionary_encode(column, null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _ids(first: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """A number from 0 on for each distinct row of whole numbers, in order of the rows."""
    out = np.unique(first, return_inverse=True)[1].ravel()
    for x in more:
        at = np.unique(x, return_inverse=True)[1].ravel()
        n = int(at.max()) + 1 if len(at) else 1
        if n > 1:
            out = np.unique(out * n + at, return_inverse=True)[1].ravel()
    return out


def overlapping(left: DataFrame, right: DataFrame, on: Sequence[str], a: tuple[str, str], b: tuple[str, str], tile: int = TILE) -> DataFrame:
    """Pairs of rows with equal `on` whose closed intervals share a coordinate: left's columns, then right's but for `on`.

    Rows without an `on` or a bound, or that end before they begin, meet nothing. An interval is copied once per `tile` coordinates, not per
    bin, so long ones cost little. Both sides are read twice, as tiles are counted first, and must give the same rows."""
    met = _met(left, right, on, a, b, tile)
    for c in on:  # groups are hashed
        met = met.where(F.col("l")[c] == F.col("r")[c])
    return met.select("l.*", *[F.col("r")[c].alias(c) for c in right.columns if c not in on])


def overlap_sums(
    left: DataFrame, right: DataFrame, on: Sequence[str], a: tuple[str, str], b: tuple[str, str], sums: dict[str, Column], bases: bool = False, tile: int = TILE
) -> DataFrame:
    """(on, a, and each of `sums`): for every distinct interval of left, whole-number columns summed over the rows of right that it meets.

    With `bases` a row counts as often as it shares coordinates with the interval. No pairs are made: what an interval meets is what has
    begun by its end less what ended before its start, so it asks two places for running totals (with `bases`, of depth and depth times place).
    Totals per place are combined map-side, running ones are made per tile as in a sweep; nothing is copied per tile, and a hot place is one
    row. Intervals without an `on` or a bound, or that end before they begin, are left out on both sides; those that meet nothing have 0."""
    sound = lambda df, c: df.where(" and ".join([f"`{c[0]}` <= `{c[1]}`", *(f"`{k}` is not null" for k in on)]))
    names = list(sums)
    begin, after = F.col(b[0]).cast("long"), F.col(b[1]).cast("long") + 1
    w = [x.cast("long") for x in sums.values()]
    change = lambda pos, g, h: F.struct(pos.alias("pos"), *[x.alias(f"_g{i}") for i, x in enumerate(g)], *[x.alias(f"_h{i}") for i, x in enumerate(h)])
    if bases:
        both = change(begin, w, [x * begin for x in w]), change(after, [-x for x in w], [-x * after for x in w])
    else:
        none = [F.lit(0).cast("long")] * len(w)
        both = change(begin, w, none), change(after, none, w)
    totals = [f"_{k}{i}" for k in "gh" for i in range(len(w))]
    events = sound(right, b).select(*on, F.explode(F.array(*both)).alias("_x")).select(*on, "_x.*")
    events = events.groupBy(*on, "pos").agg(*[F.sum(c).alias(c) for c in totals])
    asked = sound(left, a).select(*on, *a).distinct()
    low = F.col(a[0]).cast("long") - (1 if bases else 0)
    place = lambda pos, upper: F.struct(pos.alias("pos"), F.lit(upper).alias("_upper"))
    asks = asked.select("*", F.struct(*[F.col(c).alias(f"_{k}") for k, c in enumerate(a)]).alias("_ask"), F.explode(F.array(place(F.col(a[1]).cast("long"), True), place(low, False))).alias("_x"))
    asks = asks.select(*on, "_ask", "_x.*")
    rows = events.unionByName(asks, allowMissingColumns=True).withColumn("_tile", F.floor(F.col("pos") / tile))
    tiles = rows.groupBy(*on, "_tile").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in totals])
    before = Window.partitionBy(*on).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    tiles = tiles.select(*on, "_tile", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in totals])
    own = Window.partitionBy(*on, "_tile").orderBy("pos", F.col("_ask").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({c: F.coalesce(F.sum(c).over(own), F.lit(0)) for c in totals}).where("_ask is not null").join(tiles, [*on, "_tile"])
    upto = lambda c: F.col(c) + F.col(f"_{c}")
    value = lambda i: (
        F.when(F.col("_upper"), 1).otherwise(-1) * ((F.col("pos") + 1) * upto(f"_g{i}") - upto(f"_h{i}")) if bases else F.when(F.col("_upper"), upto(f"_g{i}")).otherwise(-upto(f"_h{i}"))
    )
    out = rows.groupBy(*on, "_ask").agg(*[F.sum(value(i)).alias(n) for i, n in enumerate(names)])
    return out.select(*on, *[F.col("_ask")[f"_{k}"].alias(c) for k, c in enumerate(a)], *names)
