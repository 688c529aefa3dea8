"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("chatmeter")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .getOrCreate()
    )


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop path and its file system, for any scheme Spark can read."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark._jsc.hadoopConfiguration())


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder that every executor can reach, removed when the session ends.

    It lies under ``spark.checkpoint.dir`` as the cluster sets it. Where that is unset, a session that
    runs in one process gets a local temporary folder; any other is refused, as its executors
    would each write to a disk of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _local_base()
    path = f"{base.rstrip('/')}/chatmeter/{name}-{uuid.uuid4().hex}"
    hpath, fs = hadoop_path(spark, path)
    fs.deleteOnExit(hpath)
    return path


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="chatmeter-")


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder of ``scratch_dir`` that nothing reads any more."""
    hpath, fs = hadoop_path(spark, path)
    fs.delete(hpath, True)


@contextmanager
def scratch_table(spark: SparkSession, df: DataFrame, name: str, **options) -> Iterator[DataFrame]:
    """A materialized copy of ``df`` that is deleted at the end of the block. ``options`` are those of the writer."""
    path = scratch_dir(spark, name)
    try:
        df.write.options(**options).parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        discard(spark, path)


def materialize(spark: SparkSession, df: DataFrame, name: str, partition_by: tuple[str, ...] = (), **options) -> DataFrame:
    """Write ``df`` to a scratch table and read it back. ``options`` are those of the writer.

    The copy survives lost executors, is computed once however often it is read, and has a real
    size, so that the planner broadcasts it only when it is under the broadcast threshold.
    """
    path = scratch_dir(spark, name)
    if partition_by:
        df.hint("rebalance", *partition_by).write.options(**options).partitionBy(*partition_by).parquet(path)
    else:
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
