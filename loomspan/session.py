"""A local session for tests and benches (a cluster brings its own), and tables cut from their lineage."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | None = None, shuffle: int = 8) -> SparkSession:
    n = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(f"local[{n}]").appName("loomspan")
    settings = {
        "spark.sql.shuffle.partitions": shuffle,
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset and all runs in one process, a temporary one."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """df computed once and kept in spark.checkpoint.dir, where all that reads it finds it, lost executors or not.

    For tables that several outputs are made of: else each output would compute them anew."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
