"""Coverage of alignments that keep arriving, with Structured Streaming.

The batch sweep needs only the changes per place, and those add up from batch to batch. changes() keeps them all, for rows in
any order; settling() lets runs go that rows in order of place have passed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from loomspan.operators.coverage import sweep


def changes(stream: DataFrame, on: str = "chr", start: str = "start", end: str = "end") -> DataFrame:
    """(on, pos, d): the running sum of changes per place, as a streaming aggregation (update or complete mode)."""
    both = F.explode(F.array(F.struct(F.col(start).alias("pos"), F.lit(1).alias("d")), F.struct(F.col(end).alias("pos"), F.lit(-1).alias("d"))))
    return stream.select(on, both.alias("x")).groupBy(on, "x.pos").agg(F.sum("x.d").alias("d"))


def settled(changes_table: DataFrame, on: str = "chr") -> DataFrame:
    """Coverage from a table of changes, such as a complete-mode sink."""
    up = changes_table.where("d > 0").select(on, F.col("pos").alias("start"), F.lit(None).cast("long").alias("end"), "d")
    down = changes_table.where("d < 0").select(on, F.lit(None).cast("long").alias("start"), F.col("pos").alias("end"), (-F.col("d")).alias("d"))
    return sweep(up.unionByName(down), [on], weight=F.col("d"))


class _Settling(StatefulProcessor):
    """Of one tile: the changes at and behind the watermark's coordinate, what is open there and since where."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("changes", "pos binary, d binary, open long, since long, base long, timer long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        old = self.state.get() if self.state.exists() else None
        parts = list(rows)
        base = int(parts[0]["base"].iloc[0])
        pos, d, depth, since, _, timer = self._read(old) if old else (np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0, base, None)
        new = [(p["start"], p["w"]) for p in parts] + [(p["end"], -p["w"]) for p in parts]
        pos, at = np.unique(np.concatenate([pos, *[x.to_numpy(np.int64) for x, _ in new]]), return_inverse=True)
        sums = np.zeros(len(pos), np.int64)
        np.add.at(sums, at, np.concatenate([d, *[x.to_numpy(np.int64) for _, x in new]]))
        yield from self._purged(key, pos, sums, depth, since, base, timer, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.state.exists():
            yield from self._purged(key, *self._read(self.state.get())[:5], None, timerValues)

    @staticmethod
    def _read(row) -> tuple:
        return np.frombuffer(row[0], np.int64), np.frombuffer(row[1], np.int64), *row[2:]

    def _purged(self, key, pos, d, depth, since, base, timer, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N803
        """The runs that end before the watermark; what is left stays as state, with a timer at its first change."""
        pos, d = pos[d != 0], d[d != 0]
        before = timerValues.getCurrentWatermarkInMs() - base
        n = int(np.searchsorted(pos, before, "left"))
        if n:
            edges, depths = np.concatenate([[since], pos[:n]]), np.concatenate([[depth], d[:n]]).cumsum()
            some = np.flatnonzero(depths[:-1])
            depth, since = int(depths[-1]), int(pos[n - 1])
            if len(some):
                yield pd.DataFrame({"chr": key[0], "start": edges[some], "end": edges[some + 1], "cov": depths[some]})
        if n == len(pos):  # then nothing is open either
            self.state.clear()
            return
        if timer is None or base + int(pos[n]) + 1 < timer:
            timer = base + int(pos[n]) + 1
            self.handle.registerTimer(timer)
        self.state.update((pos[n:].tobytes(), d[n:].tobytes(), depth, since, base, timer))

    def close(self) -> None:
        pass


def settling(stream: DataFrame, late: int, on: str = "chr", start: str = "start", end: str = "end", base: Column | None = None, weight: Column | None = None, tile: int = 1 << 16) -> DataFrame:
    """(chr, start, end, cov): runs of coverage, each once and as soon as no later row can change it.

    Half-open spans arrive about in order of place, as in a sorted file: none starts more than `late` bases before one that has come.
    base + start is a row's place in the whole genome (`base`: the sizes of the chromosomes before, 0 for a single one) and serves as event time, a base
    a millisecond, so Spark's watermark is the place up to which all is settled. State is kept by chromosome and tile: changes at or behind
    the watermark only, and none of a tile that it has passed. Rows later than that are dropped, as Spark's metrics tell. A row
    with a null end carries no span and only says how far the reading has come; one past the last chromosome settles all. Runs end at a
    tile's border; coverage.merged joins equal neighbours. Needs the RocksDB state store."""
    kind = stream.schema[on].dataType.simpleString()
    place = F.lit(0).cast("long") if base is None else base.cast("long")
    rows = stream.select(
        F.col(on).alias("chr"), F.timestamp_millis(place + F.col(start) + 1).alias("at"), F.col(end).cast("long").alias("e"), place.alias("base"),
        (F.lit(1) if weight is None else weight).cast("long").alias("w"),
    )
    # Spark drops rows at the watermark too, hence one more; all below is made of `at`, so that no filter goes before the watermark
    rows = rows.withWatermark("at", f"{late + 1} milliseconds").withColumn("s", F.unix_millis("at") - F.col("base") - 1)
    tiles = F.when(F.col("s") < F.col("e"), F.sequence(F.floor(F.col("s") / tile), F.floor((F.col("e") - 1) / tile)))
    pieces = rows.withColumn("tile", F.explode(tiles))
    pieces = pieces.select("chr", "tile", "at", "base", "w", F.greatest("s", F.col("tile") * tile).alias("start"), F.least("e", (F.col("tile") + 1) * tile).alias("end"))
    out = f"chr {kind}, start long, end long, cov long"
    settled_runs = pieces.groupBy("chr", "tile").transformWithStateInPandas(_Settling(), out, "Append", "EventTime")
    return settled_runs.withColumnRenamed("chr", on)
