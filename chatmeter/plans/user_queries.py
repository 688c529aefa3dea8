"""Registered queries on clustered users and on bitmaps of users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmeter.operators import kpi
from chatmeter.operators.clean import clean_events
from chatmeter.plans import jobs
from chatmeter.plans import registry as r
from chatmeter.plans.registry import query
from chatmeter.session import materialize, scratch_dir
from chatmeter.sources import bitmaps, testtables
from chatmeter.sources.store import KpiStore

BUCKETS = 8  # of these tables, whose users are some thousands
CUTS = (None, r.STORED_UNTIL, "2024-01-10", None)  # days between which each part of the visits lies
SPAN = ("2024-01-02", "2024-01-20")
DAYS = 7


def _parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The visits of each day, in three parts by day; the log is read and parsed once."""
    lines = testtables.log_lines(testtables.table(spark, sf_dir, "events"))
    visits = materialize(spark, kpi.users_day(clean_events(lines, strip_ids=True)), "visits")
    out = []
    for first, last in zip(CUTS, CUTS[1:]):
        part = visits
        if first:
            part = part.where(F.col("day") >= F.lit(first).cast("date"))
        if last:
            part = part.where(F.col("day") < F.lit(last).cast("date"))
        out.append(part)
    return out


def _first(visits: DataFrame, hour: int) -> DataFrame:
    arrived = F.lit(f"{r.AS_OF} {hour:02d}:00:00").cast("timestamp")
    return visits.groupBy(*kpi.USER).agg(F.min("day").alias("day")).withColumn("arrived", arrived)


@query(
    r.STRICT + f"""SELECT bot_name, count(DISTINCT user_id) AS uv FROM strict
    WHERE bot_name NOT IN {r.PURGED} OR day >= DATE '{r.STORED_UNTIL}' GROUP BY bot_name"""
)
def uv_total_clustered(spark, sf_dir):
    """Total UV from the buckets, refreshed after each of three loads, with bots purged after the first."""
    store = KpiStore(spark, scratch_dir(spark, "clustered"))
    users = store.clustered_users(BUCKETS)
    for k, part in enumerate(_parts(spark, sf_dir)):
        store.append("first_seen", _first(part, k), f"load{k}", kind="job")
        users.refresh()
        if k == 0:
            jobs.purge_bots(store, list(r.PURGED))
    return kpi.uv_total(users.folded())


@query(
    r.STRICT + f", {r.FIRST_SEEN} SELECT bot_name, day, user_id FROM first_seen WHERE day >= DATE '{r.STORED_UNTIL}'"
)
def new_users_clustered(spark, sf_dir):
    """Users not seen before: only the incoming ones are exchanged."""
    store = KpiStore(spark, scratch_dir(spark, "clustered"))
    known, *incoming = _parts(spark, sf_dir)
    store.append("first_seen", _first(known, 0), "load", kind="job")
    users = store.clustered_users(BUCKETS)
    users.refresh()
    return kpi.new_users(incoming[0].unionByName(incoming[1]), known=users.rows())


def _bits(spark: SparkSession, sf_dir: str) -> bitmaps.UserBits:
    """Bitmaps refreshed after each load; users of one are met again in the next."""
    store = KpiStore(spark, scratch_dir(spark, "bitmaps"))
    bits = store.user_bits(BUCKETS)
    for k, part in enumerate(_parts(spark, sf_dir)):
        store.append("users_day", part, f"load{k}", kind="job")
        bits.refresh()
    return bits


_ROLLING = f"""spans AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS last_day FROM strict),
  met AS (SELECT bot_name, user_id, last_day FROM strict JOIN spans ON day BETWEEN last_day - {DAYS - 1} AND last_day)"""


@query(
    r.STRICT + f", {_ROLLING} SELECT bot_name, last_day AS day, count(DISTINCT user_id) AS uv FROM met GROUP BY bot_name, last_day"
)
def uv_rolling_week(spark, sf_dir):
    """Distinct users of each bot in the seven days up to each day."""
    return bitmaps.uv(bitmaps.rolling(_bits(spark, sf_dir).bits(), DAYS), "bot_name", "day")


@query(
    r.STRICT + f", {_ROLLING} SELECT last_day AS day, count(DISTINCT (bot_name, user_id)) AS uv FROM met GROUP BY last_day"
)
def uv_rolling_week_overall(spark, sf_dir):
    """The same summed over the bots."""
    return bitmaps.uv(bitmaps.rolling(_bits(spark, sf_dir).bits(), DAYS), "day")


@query(
    r.STRICT + f"""SELECT bot_name, count(DISTINCT user_id) AS uv FROM strict
    WHERE day BETWEEN DATE '{SPAN[0]}' AND DATE '{SPAN[1]}' GROUP BY bot_name"""
)
def uv_of_span(spark, sf_dir):
    """Distinct users of a span of days, from the bitmaps of its days only, after they were folded."""
    bits = _bits(spark, sf_dir)
    bits.compact()
    return bitmaps.uv(bits.bits(*SPAN), "bot_name")
