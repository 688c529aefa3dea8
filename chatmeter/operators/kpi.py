"""The KPIs, from cleaned requests (``schema.REQUEST``) or from tables of an earlier step.

Counts group by bot and so combine on the map side before the shuffle: a bot with a third of all
requests costs one row per map task. User sets shuffle on bot *and* user, which spreads a hot bot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatmeter.session import materialize

USER = ["bot_name", "user_id"]


def _count(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


# --- page views ---------------------------------------------------------------------------------


def pv_total(requests: DataFrame) -> DataFrame:
    return _count(requests, ["bot_name"], "pv")


def pv_day(requests: DataFrame) -> DataFrame:
    return _count(requests, ["bot_name", "day"], "pv")


def pv_extracted(lines: DataFrame) -> DataFrame:
    """PV per bot of an extracted file, whose second tab field is the bot name; nothing is cleaned."""
    bot = F.get(F.split("value", "\t", 3), F.lit(1))
    return _count(lines.select(bot.alias("bot_name")).where(F.col("bot_name").isNotNull()), ["bot_name"], "pv")


def to_counters(pv: DataFrame, targets: tuple[str, ...]) -> DataFrame:
    """The same increments for several counter tables, from one aggregate."""
    return pv.select(F.explode(F.array(*map(F.lit, targets))).alias("target"), "bot_name", "pv")


# --- users --------------------------------------------------------------------------------------


def users_total(requests: DataFrame) -> DataFrame:
    return requests.select(*USER).distinct()


def users_day(requests: DataFrame) -> DataFrame:
    return requests.select("bot_name", "day", "user_id").distinct()


def merge_users(stored: DataFrame, requests: DataFrame) -> DataFrame:
    """Stored all-time users and those of the requests, made distinct in one shuffle."""
    return stored.select(*USER).unionByName(requests.select(*USER)).distinct()


def new_users(requests: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Users not in ``known``, with the earliest day of theirs in ``requests``.

    Both sides are hashed on (bot, user), unless the planner broadcasts a small ``known``; the
    aggregate's partitioning then serves the join as well.
    """
    first = requests.groupBy(*USER).agg(F.min("day").alias("day"))
    if known is not None:
        first = first.join(known.select(*USER), USER, "left_anti")
    return first.select("bot_name", "day", "user_id")


def bot_registry(new: DataFrame) -> DataFrame:
    """Bots for which a user was seen for the first time."""
    return new.select("bot_name").distinct()


def uv_total(users: DataFrame) -> DataFrame:
    """Set sizes; ``users`` holds each (bot, user) once."""
    return _count(users, ["bot_name"], "uv")


def uv_day(users: DataFrame) -> DataFrame:
    """Set sizes per day; ``users`` holds each (bot, day, user) once."""
    return _count(users, ["bot_name", "day"], "uv")


# --- requests per second ------------------------------------------------------------------------


def qps_bot(requests: DataFrame) -> DataFrame:
    return _count(requests, ["bot_name", "day", "second"], "requests")


def qps_product(requests: DataFrame) -> DataFrame:
    return _count(requests, ["product", "day", "second"], "requests")


def top_qps(qps: DataFrame, key: str) -> DataFrame:
    """Busiest second of each (key, day); of equally busy ones, the earliest."""
    rank = F.struct(-F.col("requests"), F.col("second"))
    return qps.groupBy(key, "day").agg(
        F.max("requests").alias("requests"), F.min_by("second", rank).alias("second")
    )


def busiest_first(qps: DataFrame) -> DataFrame:
    """The sorted-set order, highest count first."""
    return qps.orderBy(F.desc("requests"), "second")


# --- over all bots ------------------------------------------------------------------------------


def overall_totals(requests: DataFrame) -> DataFrame:
    """Total PV and UV. UV is the sum over the bots, so a user of two bots counts twice."""
    return _count(requests, USER, "n").agg(F.sum("n").alias("pv"), F.count(F.lit(1)).alias("uv"))


def overall_by_day(requests: DataFrame) -> DataFrame:
    """PV, UV and new UV of each day, summed over the bots.

    Daily visits are written once, so that the log is parsed once. First days come from a minimum that
    combines on the map side, and the counts of both are added up per day.
    """
    visits = materialize(requests.sparkSession, _count(requests, ["bot_name", "day", "user_id"], "n"), "visits")
    return overall_of(
        visits.groupBy("day").agg(F.sum("n").alias("pv")), visits, visits.groupBy(*USER).agg(F.min("day").alias("day"))
    )


def overall_of(pv: DataFrame, users: DataFrame, new: DataFrame) -> DataFrame:
    """The overall KPIs of each day, from the PV per day, the users per day, and the new users per day."""
    parts = [
        pv.groupBy("day").agg(F.sum("pv").alias("pv"), F.lit(0).alias("uv"), F.lit(0).alias("new_uv")),
        users.groupBy("day").agg(F.lit(0).alias("pv"), F.count(F.lit(1)).alias("uv"), F.lit(0).alias("new_uv")),
        new.groupBy("day").agg(F.lit(0).alias("pv"), F.lit(0).alias("uv"), F.count(F.lit(1)).alias("new_uv")),
    ]
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    sums = [F.sum(c).alias(c) for c in ("pv", "uv", "new_uv")]
    return together.groupBy("day").agg(*sums)
