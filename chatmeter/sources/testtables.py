"""The driver's tables as the inputs of this repo (FIXTURES.md §2): log lines, bots, people."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmeter.schema import TOPIC_LINES
from chatmeter.session import hadoop_path

FILE_LINES = 50_000  # most lines of a file of a part; no task can read less than a file's row group
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def log_lines(events: DataFrame, *also: str) -> DataFrame:
    """(topic, value): one chat-log line per event; ``also`` names columns of the events to keep.

    Prime divisors of the event id plant the defects, so that they overlap in a known way. Seconds
    are folded to 60 per day, so that several requests fall on one second.
    """
    day = F.col("ts").cast("date").cast("string")
    second = F.lpad((F.col("event_id") % 60).cast("string"), 2, "0")
    time = F.when(_every(17), "not-a-time").otherwise(F.concat(day, F.lit(" 00:00:"), second))
    kind = F.when(_every(11), "RESP").otherwise("REQ")
    user = F.col("user_id").cast("string")
    user_id = (
        F.when(_every(23), F.concat(F.lit("trio_test_"), user))
        .when(_every(29), F.concat(F.lit("Monitor"), user))
        .when(_every(31), "")
        .otherwise(F.concat(F.lit("u"), user))
    )
    bot_name = F.when(_every(37), "").otherwise(F.col("event_type"))
    json = F.to_json(F.struct(bot_name.alias("bot_name"), user_id.alias("user_id")))
    payload = F.when(_every(13), "{bad").otherwise(json)
    number = F.col("event_id").cast("string")
    short, whole = F.concat_ws("\t", time, kind, number), F.concat_ws("\t", time, kind, number, payload)
    line = F.col("user_id") % 3
    product = F.when(line == 0, "adult").when(line == 1, "children").otherwise("general")
    return events.select(
        F.concat(F.lit("chatlog_"), product).alias("topic"), F.when(_every(19), short).otherwise(whole).alias("value"), *also
    )


def write_parts(events: DataFrame, part: Column, root: str) -> None:
    """The lines of the events by part, in one scan and without an exchange: the tasks that read the table write.

    Files have a bounded number of lines, so the tasks that read a part grow in number with the table. As one file, whatever
    its size, a part would be one task's.
    """
    lines = log_lines(events.select("*", part.alias("part")), "part")
    lines.write.option("maxRecordsPerFile", FILE_LINES).partitionBy("part").parquet(f"{root}/parts")


def stream_of_part(spark: SparkSession, root: str, k: int) -> DataFrame | None:
    """Part ``k`` of ``write_parts`` put into the watched folder as it is, and a stream of all that is there; None if the part is empty."""
    watched, fs = hadoop_path(spark, f"{root}/in")
    fs.mkdirs(watched)
    here, _ = hadoop_path(spark, f"{root}/parts/part={k}")
    if not fs.exists(here):
        return None
    fs.rename(here, hadoop_path(spark, f"{root}/in/p{k}")[0])
    return spark.readStream.schema(TOPIC_LINES).parquet(f"{root}/in/*")


def extracted_lines(events: DataFrame) -> DataFrame:
    """Lines of the pre-extracted format, with the bot name in the second field."""
    return events.select(F.concat_ws("\t", F.col("event_id").cast("string"), "event_type").alias("value"))


def dim_bots(events: DataFrame) -> DataFrame:
    """Dimension (type, bot_name) of the bots that occur."""
    kind = (
        F.when(F.col("bot_name").isin("click", "purchase"), "adult")
        .when(F.col("bot_name").isin("view", "signup"), "children")
        .otherwise("general")
    )
    return events.select(F.col("event_type").alias("bot_name")).distinct().select(kind.alias("type"), "bot_name")


def people(customer: DataFrame) -> DataFrame:
    return customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").cast("bigint").alias("age"))


def people_lines(customer: DataFrame) -> DataFrame:
    """``name, age`` lines."""
    return customer.select(F.concat(F.col("c_name"), F.lit(", "), F.col("c_nationkey").cast("string")).alias("value"))


def pair_lines(customer: DataFrame) -> DataFrame:
    """``name number`` lines; every seventh has a third token, which disqualifies it."""
    extra = F.when(F.col("c_custkey") % 7 == 0, " x").otherwise("")
    name, number = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    return customer.select(F.concat(F.lit(" c"), name, F.lit(" "), number, extra).alias("value"))
