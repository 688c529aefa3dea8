"""Batch and streaming readers of log lines, and of the other inputs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmeter.schema import LINES


def read_lines(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """Text lines of a file, folder or glob; ``recursive`` also takes those of nested folders."""
    return spark.read.option("recursiveFileLookup", str(recursive).lower()).text(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON records. Without a schema Spark reads the files once more to infer it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, for example one of a Hive metastore."""
    return spark.table(name)


def read_dimension(
    spark: SparkSession, url: str, table: str, user: str, password: str, columns: str = "*", **options: str
) -> DataFrame:
    """A dimension table of a relational database; filters on the result are pushed to it."""
    settings = dimension_options(url, table, user, password, columns) | options
    return as_dimension(spark.read.format("jdbc").options(**settings).load())


def as_dimension(table: DataFrame) -> DataFrame:
    """(type, bot_name) of a dimension table, whose database calls the bot ``botname``."""
    names = {c.lower(): c for c in table.columns}
    bot = names.get("bot_name") or names["botname"]
    return table.select(F.col(names["type"]).alias("type"), F.col(bot).alias("bot_name"))


def dimension_options(url: str, table: str, user: str, password: str, columns: str = "*") -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table if columns == "*" else f"(SELECT {columns} FROM {table}) AS dimension",
        "user": user,
        "password": password,
        "pushDownPredicate": "true",
    }


def kafka_options(
    brokers: str | list[str], topics: str | list[str], starting: str = "latest", max_per_trigger: int | None = None
) -> dict[str, str]:
    """Options of the Kafka source for one or more topics."""
    listed = [brokers] if isinstance(brokers, str) else brokers
    wanted = [topics] if isinstance(topics, str) else topics
    options = {
        "kafka.bootstrap.servers": ",".join(listed),
        "subscribe": ",".join(wanted),
        "startingOffsets": starting,
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def stream_kafka(spark: SparkSession, brokers, topics, **settings) -> DataFrame:
    """(topic, value) of Kafka messages; needs the Kafka connector on the class path."""
    source = spark.readStream.format("kafka").options(**kafka_options(brokers, topics, **settings)).load()
    return source.select("topic", F.col("value").cast("string").alias("value"))


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of the files that appear in a folder; ``topic=...`` subfolders give the topic."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """Rows of the parquet files of a table, be it a folder or a single file, as a stream.

    The path is given as a pattern for itself: the source takes a plain path to be a folder.
    """
    path = path.rstrip("/")
    last = "?" if path[-1] in "[]{}\\^!*" else f"[{path[-1]}]"
    path = re.sub(r"([\\*?\[\]{}])", r"\\\1", path[:-1]) + last
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP socket; for trying things out, since the source cannot be replayed."""
    return spark.readStream.format("socket").options(host=host, port=str(port)).load()


def as_lines(df: DataFrame, column: str) -> DataFrame:
    """Text column to lines, as a text file of it would give."""
    return df.select(F.explode(F.split(column, "\n")).alias("value")).to(LINES)
