"""Plain outputs: text files, consoles, per-batch output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def write_text(df: DataFrame, path: str, sep: str = "\t", mode: str = "errorifexists") -> None:
    """Rows as separated text, one part file per partition, in the partitions' order."""
    columns = [F.col(name).cast("string") for name in df.columns]
    df.select(F.concat_ws(sep, *columns).alias("value")).write.mode(mode).text(path)


def print_rows(df: DataFrame) -> None:
    """Print on the executors, row by row; for debugging only."""
    df.foreach(print)


def to_console(df: DataFrame, rows: int = 10) -> DataStreamWriter:
    """First rows of every micro-batch on the driver's console."""
    return df.writeStream.format("console").option("numRows", rows).option("truncate", "false")


def per_batch(df: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str) -> DataStreamWriter:
    """Call ``action(batch, batch_id)`` for every micro-batch."""
    return df.writeStream.foreachBatch(action).option("checkpointLocation", checkpoint)
