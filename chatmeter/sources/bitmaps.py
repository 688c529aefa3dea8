"""Users as dense numbers, and the users of a day as bitmaps of these, for exact UV over any span of days.

Each user of a bot gets the bot's next number, once and for good. The users of a (bot, day) are then bitmaps: bit
``n % 32768`` of bucket ``n // 32768``. Bitmaps of several days are merged by OR, so the distinct users of a week or a year
are counted from some kilobytes a bot and day, and never met again. Numbers are dense for each bot: a bot with few
users has one bitmap a day, and a large one a bit for each user at most.

Numbers are kept by key in buckets, so telling new users from known ones exchanges only the visits that came
in. New users are numbered in parts of a bot of bounded size, each counted before, so a bot with a third of all users is
many tasks' work. Bitmaps lie by day in a table like those of the store; its rows are merged on reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmeter.operators.kpi import USER
from chatmeter.schema import USERS_DAY
from chatmeter.session import scratch_table
from chatmeter.sources import deltas
from chatmeter.sources.clustered import BUCKETS, Clustered, unseen

PART = 500_000  # new users of a bot that one task numbers, about
NUMBERS = T.StructType([T.StructField("bot_name", T.StringType()), T.StructField("user_id", T.StringType()), T.StructField("number", T.LongType())])
BITS = T.StructType(
    [
        T.StructField("bot_name", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("bits", T.BinaryType()),
    ]
)


def merged(bits: DataFrame) -> DataFrame:
    """One bitmap for each bot, day and bucket."""
    return bits.groupBy("bot_name", "day", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmaps(numbered: DataFrame) -> DataFrame:
    """The bitmaps of (bot_name, day, number); numbers count from 1, as Spark's functions have it."""
    place = F.bitmap_bucket_number("number").alias("bucket")
    return numbered.groupBy("bot_name", "day", place).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def uv(bits: DataFrame, *keys: str | Column) -> DataFrame:
    """Exact UV of each key over all days in ``bits``, summed over the bots where the key names none."""
    one = bits.groupBy(*keys, *([] if "bot_name" in keys else ["bot_name"]), "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return one.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("uv"))


def rolling(bits: DataFrame, days: int) -> DataFrame:
    """``bits`` under each day whose span of ``days`` days, itself the last, they belong to; up to the last day there is."""
    last = F.lit(bits.agg(F.max("day")).first()[0]).cast("date")
    upto = F.explode(F.sequence("day", F.least(F.date_add("day", days - 1), last)))
    return bits.select("bot_name", "bucket", "bits", upto.alias("day"))


class UserBits:
    """The numbers and bitmaps that belong to a store's users by day."""

    def __init__(self, spark: SparkSession, users_day: str, root: str, buckets: int = BUCKETS):
        self.spark, self.users_day, self.bits_at = spark, users_day, f"{root}/bits"
        self.numbers = Clustered(spark, f"{root}/numbers", NUMBERS, USER, lambda df: df, buckets)

    def refresh(self) -> int:
        """Takes in the visits stored since the last refresh; gives the version.

        Numbers are committed before the bitmaps, and visits count as seen after them: what is repeated after a loss finds its users
        numbered and writes the same bits, which OR bears.
        """
        version, state = self.numbers.state()
        live = deltas.entries(self.spark, self.users_day)
        seen = {tuple(s) for s in state.get("seen", [])}
        fresh = unseen(seen, live)
        if not fresh:
            return version
        generations = state.get("generations", [])
        visits = deltas.rows_of(self.spark, self.users_day, USERS_DAY, fresh)
        with scratch_table(self.spark, visits.distinct(), "visits") as visits:
            new = visits.select(*USER).distinct().join(self.numbers.rows(generations).select(*USER), USER, "left_anti")
            with scratch_table(self.spark, new, "new-users") as new:
                if not new.isEmpty():
                    generations = [*generations, self.numbers.write(self._numbered(new, generations))]
                    self.numbers.commit(version, generations, seen=sorted(map(list, seen)))
                    version += 1
            known = visits.join(self.numbers.rows(generations), USER)
            deltas.write_delta(bitmaps(known), self.bits_at, "job", "bits", version, by_day=True)
        self.numbers.commit(version, generations, seen=sorted([w, e.first, e.last, e.data] for w, e in live))
        return version + 1

    def _numbered(self, new: DataFrame, generations: list[str]) -> DataFrame:
        """New users with the next numbers of their bots."""
        parts = new.groupBy("bot_name").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
        highest = self.numbers.rows(generations).groupBy("bot_name").agg(F.max("number").alias("highest"))
        dealt = new.join(parts, "bot_name").withColumn("part", F.pmod(F.xxhash64("user_id"), "parts").cast("int"))
        sizes = dealt.groupBy("bot_name", "part").agg(F.count("*").alias("n"))
        before = F.sum("n").over(Window.partitionBy("bot_name").orderBy("part")) - F.col("n")  # a row a part
        starts = sizes.join(highest, "bot_name", "left").select("bot_name", "part", (before + F.coalesce("highest", F.lit(0))).alias("start"))
        place = F.row_number().over(Window.partitionBy("bot_name", "part").orderBy("user_id"))
        return dealt.join(starts, ["bot_name", "part"]).select(*USER, (F.col("start") + place).alias("number"))

    def bits(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """The bitmaps of the days from ``first`` to ``last``; folders of other days are not opened."""
        rows = deltas.read_deltas(self.spark, self.bits_at, BITS)
        if first is not None:
            rows = rows.where(F.col("day") >= F.lit(first).cast("date"))
        if last is not None:
            rows = rows.where(F.col("day") <= F.lit(last).cast("date"))
        return rows

    def compact(self) -> int:
        return deltas.compact(self.spark, self.bits_at, deltas.writer("job", "bits"), BITS, merged, by_day=True)

    def vacuum(self, hours: float = 24.0) -> int:
        return self.numbers.vacuum(hours) + deltas.vacuum(self.spark, self.bits_at, hours)
