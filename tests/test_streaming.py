"""Coverage that settles while alignments arrive in order of place."""

import random

import pytest
from pyspark.sql import functions as F

from loomspan.operators import coverage
from loomspan.streaming.coverage import settling

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture(autouse=True)
def rocks(spark):
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)


class Feed:
    """Batches of (chr, start, end, w), one file each; what came out after each of them, and the rows of state that stay."""

    def __init__(self, spark, folder, late, tile=1 << 16):
        self.spark, self.folder, self.late, self.tile = spark, folder, late, tile
        self.kind = "chr string, start long, end long, w long"
        (folder / "in").mkdir()

    def add(self, rows):
        self.spark.createDataFrame(rows, self.kind).coalesce(1).write.mode("append").parquet(str(self.folder / "in"))
        got = []
        stream = self.spark.readStream.schema(self.kind).parquet(str(self.folder / "in"))
        base = F.when(F.col("chr") == "1", 0).when(F.col("chr") == "2", 10_000).otherwise(20_000)
        out = settling(stream, self.late, base=base, weight=F.col("w"), tile=self.tile)
        keep = lambda df, k: got.extend(tuple(r) for r in df.collect())
        query = out.writeStream.foreachBatch(keep).option("checkpointLocation", str(self.folder / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
        self.state = sum(o["numRowsTotal"] for o in query.lastProgress["stateOperators"]) if query.lastProgress else None
        return sorted(got)


def test_purged_up_to_the_watermark(spark, tmp_path):
    feed = Feed(spark, tmp_path, 0)
    got = feed.add([("1", 5, 10, 1)]) + feed.add([("1", 7, None, 0)])
    assert got == []  # a change at 5, but what is open there goes on beyond 7
    got = feed.add([("1", 8, 15, 2), ("1", 9, None, 0)]) + feed.add([("1", 9, None, 0)])
    assert got == [("1", 5, 8, 1)]
    got = feed.add([("1", 14, 19, 7), ("1", 15, None, 0)]) + feed.add([("1", 15, None, 0)])
    assert got == [("1", 8, 10, 3), ("1", 10, 14, 2)]
    assert feed.add([("2", 0, None, 0)]) + feed.add([("2", 0, None, 0)]) == [("1", 14, 15, 9), ("1", 15, 19, 7)]
    assert feed.state == 0  # nothing stays of what is settled


def test_late_rows_wait(spark, tmp_path):
    feed = Feed(spark, tmp_path, 10)
    got = feed.add([("1", 20, 30, 1)]) + feed.add([("1", 10, 25, 1), ("1", 9, 99, 5)])  # 10 is not too late, 9 is
    assert got == []
    assert feed.add([("3", 0, None, 0)]) + feed.add([("3", 0, None, 0)]) == [("1", 10, 20, 1), ("1", 20, 25, 2), ("1", 25, 30, 1)]


@pytest.mark.parametrize("tile", [16, 1 << 16])
def test_settled_runs_are_the_sweep(spark, tmp_path, tile):
    rng = random.Random(tile)
    rows = sorted((rng.choice("12"), s := rng.randint(0, 300), s + rng.choice([1, 5, 60]), rng.randint(1, 3)) for _ in range(120))
    feed, got = Feed(spark, tmp_path, 0, tile), []
    for k in range(0, 120, 40):
        got += feed.add(rows[k : k + 40])
    got += feed.add([("3", 0, None, 0)]) + feed.add([("3", 0, None, 0)])
    assert feed.state == 0
    kind = "chr string, start long, end long"
    want = coverage.sweep(spark.createDataFrame(rows, kind + ", w long"), ["chr"], weight=F.col("w"))
    runs = spark.createDataFrame(got, kind + ", cov long")
    assert sorted(map(tuple, coverage.merged([runs]).collect())) == sorted(map(tuple, want.collect()))
    assert coverage.validated(runs).count() == 0
