"""The KPI tables of one deployment: what the jobs append and what readers see."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmeter import schema
from chatmeter.operators import history, kpi, timed
from chatmeter.sources import deltas
from chatmeter.sources.bitmaps import UserBits
from chatmeter.sources.clustered import BUCKETS, Followed


def _sum(value: str, *keys: str):
    return lambda df: df.groupBy(*keys).agg(F.sum(value).alias(value))


def _earliest(df: DataFrame) -> DataFrame:
    """The day of the first arrival; of batches that arrived together, the earliest day."""
    day = F.min_by("day", F.struct("arrived", "day")).alias("day")
    return df.groupBy(*kpi.USER).agg(day, F.min("arrived").alias("arrived"))


class KpiStore:
    """Tables under one folder, corrected in place.

    Bot-level tables have no product in their key: a bot that occurs in two topics shares its
    counters.
    """

    # name -> (columns of the appended rows, what makes rows of several batches one)
    TABLES = {
        "pv_total": (schema.PV_TOTAL, _sum("pv", "bot_name")),
        "pv_day": (schema.PV_DAY, _sum("pv", "bot_name", "day")),
        "pv_history": (schema.PV_TOTAL, _sum("pv", "bot_name")),
        "qps": (schema.QPS_DELTA, _sum("requests", "product", "bot_name", "day", "second")),
        "users_day": (schema.USERS_DAY, lambda df: df.distinct()),
        "first_seen": (schema.FIRST_SEEN_DELTA, _earliest),
        "answers": (schema.ANSWERS, timed.first_answers),
        "sessions": (schema.SESSIONS, lambda df: df.distinct()),
        "user_sketches": (schema.SKETCHES, history.merged_users),
        "load_sketches": (schema.SKETCHES, history.merged_loads),
    }
    BY_DAY = ("pv_day", "qps", "users_day", "answers", "sessions", "user_sketches", "load_sketches")  # with a folder for each day inside a batch's data

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    # --- writing ---

    def append(
        self, table: str, df: DataFrame, source: str, batch: int = 0, kind: str = "stream", arrived: str | None = None
    ) -> None:
        columns = self.TABLES[table][0].fieldNames()
        deltas.write_delta(df.select(*columns), self.path(table), kind, source, batch, table in self.BY_DAY, arrived)

    def set_history(self, fresh: DataFrame, source: str, batch: int = 0, kind: str = "job") -> None:
        """Make the history PV of the bots in ``fresh`` equal to it, by appending the difference."""
        columns, fold = self.TABLES["pv_history"]
        others = deltas.read_deltas(self.spark, self.path("pv_history"), columns, without=deltas.writer(kind, source))
        taken_back = others.join(fresh, "bot_name", "left_semi").withColumn("pv", -F.col("pv"))
        self.append("pv_history", fold(fresh.select("bot_name", "pv").unionByName(taken_back)), source, batch, kind)

    def arrival(self, job: str, given: datetime | str | None = None) -> str:
        """When a job's rows arrived: as given, else as its first run noted, else now."""
        if given is None:
            given = deltas.recorded_arrival(self.spark, self.path("first_seen"), "job", job)
        return str(given) if given else self.spark.range(1).select(F.current_timestamp().cast("string")).first()[0]

    def correct(self, table: str, keys: DataFrame) -> None:
        """Drop what the table says under ``keys`` now; what is written later counts again."""
        deltas.mask(self.path(table), keys)

    def compact(self, source: str, kind: str = "stream", every: int | None = None) -> None:
        for table, (columns, fold) in self.TABLES.items():
            for of in deltas.runs(self.spark, self.path(table), kind, source):
                deltas.compact(self.spark, self.path(table), of, columns, fold, table in self.BY_DAY, every)

    def vacuum(self, hours: float = 24.0) -> int:
        gone = sum(deltas.vacuum(self.spark, self.path(table), hours) for table in self.TABLES)
        return gone + self.clustered_users().vacuum(hours) + self.user_bits().vacuum(hours)

    # --- made from the tables, in step with them by ``refresh`` ---

    def clustered_users(self, buckets: int = BUCKETS) -> Followed:
        """All users with their first arrival, by bucket of (bot, user): read without an exchange."""
        columns, fold = self.TABLES["first_seen"]
        return Followed(self.spark, self.path("first_seen"), f"{self.root}/clustered/first_seen", columns, kpi.USER, fold, buckets)

    def user_bits(self, buckets: int = BUCKETS) -> UserBits:
        """The users of each day as bitmaps, for UV over spans of days."""
        return UserBits(self.spark, self.path("users_day"), f"{self.root}/bitmaps", buckets)

    # --- reading ---

    def rows(self, table: str) -> DataFrame:
        return deltas.read_deltas(self.spark, self.path(table), self.TABLES[table][0])

    def folded(self, table: str) -> DataFrame:
        return self.TABLES[table][1](self.rows(table))

    def pv_total(self) -> DataFrame:
        return self.folded("pv_total")

    def pv_day(self) -> DataFrame:
        return self.folded("pv_day")

    def pv_history(self) -> DataFrame:
        return self.folded("pv_history")

    def users_total(self) -> DataFrame:
        return kpi.users_total(self.rows("first_seen"))

    def users_day(self) -> DataFrame:
        return self.folded("users_day")

    def new_users_day(self) -> DataFrame:
        """Each user under the day of the batch that brought the user first.

        Users of jobs that fill totals only have no day and never count as new.
        """
        first = self.folded("first_seen").where(F.col("day").isNotNull())
        return first.select("bot_name", "day", "user_id")

    def bot_registry(self) -> DataFrame:
        return kpi.bot_registry(self.rows("first_seen"))

    def qps_bot(self) -> DataFrame:
        return _sum("requests", "bot_name", "day", "second")(self.rows("qps"))

    def qps_product(self) -> DataFrame:
        return _sum("requests", "product", "day", "second")(self.rows("qps"))

    def overall_totals(self, users: DataFrame | None = None) -> DataFrame:
        """Total PV and UV over the bots; ``users`` holds each (bot, user) once where given."""
        uv = (self.users_total() if users is None else users).agg(F.lit(0).cast("bigint").alias("pv"), F.count(F.lit(1)).alias("uv"))
        pv = self.rows("pv_total").agg(F.coalesce(F.sum("pv"), F.lit(0)).alias("pv"), F.lit(0).cast("bigint").alias("uv"))
        return pv.unionByName(uv).agg(F.sum("pv").alias("pv"), F.sum("uv").alias("uv"))

    def overall_by_day(self) -> DataFrame:
        """PV, UV and new UV of each day over the bots, without a look at the log."""
        return kpi.overall_of(self.pv_day(), self.users_day(), self.new_users_day())
