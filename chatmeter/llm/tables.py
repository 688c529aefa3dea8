"""Shared pieces of the operators: reading columns safely, materialising, walking Arrow batches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmeter.session import materialize


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Later steps read the files, so a lost executor costs a re-read and never a re-computation.
    """
    return materialize(df.sparkSession, df, name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def give_back() -> None:
    """Hands memory that earlier tasks of this worker have freed back to the system: a worker outlives its tasks, and what the
    allocators keep of a large one would add to what the next operator needs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the text of each piece stays near ``most`` bytes (one row at least)."""
    give_back()
    for batch in batches:
        size, start = 0, 0
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        for i, n in enumerate(lengths):
            if size + n > most and i > start:
                yield batch.slice(start, i - start)
                size, start = 0, i
            size += n
        if start < len(lengths):
            yield batch.slice(start)


def spread(df: DataFrame, by: str, rows: int, per_bucket: int = 200_000) -> DataFrame:
    """``df`` with ``_bucket``: so many hash buckets of ``by`` that each holds about ``per_bucket`` rows."""
    return df.withColumn("_bucket", F.pmod(F.xxhash64(by), F.lit(max(1, -(-rows // per_bucket)))))
