"""The folder that driver and executors share, tables cut from their lineage, and files in any store."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset and all runs in one process (tests), below a temporary one."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        top = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.sparkContext.setCheckpointDir(top)
    return f"{top.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: its lineage is cut, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a written() table that no later step reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        with contextlib.suppress(Exception):  # only disk space is lost if a store refuses
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def swept(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of finished jobs now: its cleaner acts on what the driver's garbage collections find. The
    first one lets go of what Python held, the second finds what that held."""
    gc.collect()
    for _ in range(2):
        spark.sparkContext._jvm.java.lang.System.gc()
        time.sleep(0.5)


def file_system(uri: str):
    """(filesystem, path) of a URI as executors see it: file:, hdfs:, s3:, gs: or a bare path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://", 1) if uri.startswith("file:") else f"file://{uri}")


def put_once(uri: str, chunks) -> int:
    """Write an iterable of bytes, as they are, to a file that nobody else names; returns the bytes written.

    Each task attempt writes under its own name and only the manifest row of the attempt that
    succeeded is read, so retried or speculative attempts leave nothing but unread files."""
    store, path = file_system(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    total = 0
    with store.open_output_stream(path, compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
            total += len(chunk)
    return total
