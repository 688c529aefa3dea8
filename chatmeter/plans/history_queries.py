"""Registered queries on dated types, retention, sketches, and the changes between published versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmeter.operators import history, kpi, timed
from chatmeter.operators.clean import clean_events
from chatmeter.plans import jobs
from chatmeter.plans import registry as r
from chatmeter.plans.registry import query
from chatmeter.session import materialize, scratch_dir
from chatmeter.sources import bitmaps, testtables
from chatmeter.sources.store import KpiStore

DAYS = 7
SHARES = (0.5, 0.9, 0.99)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testtables.table(spark, sf_dir, "events")


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_events(testtables.log_lines(_events(spark, sf_dir)))


# --- types as they were ---------------------------------------------------------------------------

_DATED = """dated AS (
  SELECT event_type AS bot_name, CASE WHEN event_type IN ('click', 'purchase') THEN 'adult' ELSE 'children' END AS type,
    CASE event_type WHEN 'error' THEN TIMESTAMP '2024-01-05 00:00:30' ELSE TIMESTAMP '2023-12-01' END AS valid_from
  FROM (SELECT DISTINCT event_type FROM events)
  UNION ALL SELECT event_type, 'general', TIMESTAMP '2024-01-12 00:00:20' FROM (SELECT DISTINCT event_type FROM events)
  WHERE event_type IN ('click', 'view'))"""


def _dated_bots(events: DataFrame) -> DataFrame:
    """A dimension whose rows are valid from a time on: two bots change their type, one begins late."""
    bots = events.select(F.col("event_type").alias("bot_name")).distinct()
    bot = F.col("bot_name")
    start = F.when(bot == "error", "2024-01-05 00:00:30").otherwise("2023-12-01 00:00:00").cast("timestamp")
    first = bots.select("bot_name", F.when(bot.isin("click", "purchase"), "adult").otherwise("children").alias("type"), start.alias("valid_from"))
    changed = F.lit("2024-01-12 00:00:20").cast("timestamp").alias("valid_from")
    return first.unionByName(bots.where(bot.isin("click", "view")).select("bot_name", F.lit("general").alias("type"), changed))


@query(
    r.STRICT + f""", {_DATED}, moments AS (SELECT *, CAST(second AS TIMESTAMP) AS moment FROM strict)
    SELECT type, day, count(*) AS pv FROM moments ASOF LEFT JOIN dated
      ON moments.bot_name = dated.bot_name AND moments.moment >= dated.valid_from GROUP BY type, day"""
)
def pv_by_type_then(spark, sf_dir):
    """Page views of each day by the type that the bot had at the time of the request."""
    events = _events(spark, sf_dir)
    requests = timed.timed(testtables.log_lines(events))
    return history.types_then(requests, _dated_bots(events)).groupBy("type", "day").agg(F.count(F.lit(1)).alias("pv"))


# --- retention ------------------------------------------------------------------------------------


@query(
    r.STRICT + f""", {r.FIRST_SEEN}, visits AS (SELECT DISTINCT bot_name, user_id, day FROM strict),
    cohorts AS (SELECT bot_name, day AS first_day, count(*) AS cohort FROM first_seen GROUP BY bot_name, day),
    steps AS (SELECT *, unnest(range(least({history.UPTO}, (SELECT max(day) FROM strict) - first_day) + 1)) AS n FROM cohorts),
    met AS (SELECT v.bot_name, f.day AS first_day, v.day - f.day AS n, count(*) AS users
      FROM visits v JOIN first_seen f ON v.bot_name = f.bot_name AND v.user_id = f.user_id GROUP BY ALL)
    SELECT bot_name, first_day, CAST(n AS INTEGER) AS n, CAST(coalesce(users, 0) AS BIGINT) AS users, cohort
    FROM steps LEFT JOIN met USING (bot_name, first_day, n)"""
)
def retention(spark, sf_dir):
    return history.retention(materialize(spark, kpi.users_day(_clean(spark, sf_dir)), "visits"))


@query(
    r.STRICT + """, visits AS (SELECT DISTINCT bot_name, user_id, day FROM strict),
    gaps AS (SELECT bot_name, day, day - lag(day) OVER (PARTITION BY bot_name, user_id ORDER BY day) AS gap FROM visits)
    SELECT bot_name, day, count(*) AS returning, avg(gap) AS mean_days FROM gaps WHERE gap IS NOT NULL GROUP BY bot_name, day"""
)
def returning_users(spark, sf_dir):
    return history.returns(kpi.users_day(_clean(spark, sf_dir)))


# --- sketches -------------------------------------------------------------------------------------


@query(
    r.STRICT + f""", spans AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS last_day FROM strict)
    SELECT bot_name, last_day AS day, count(DISTINCT user_id) AS exact, TRUE AS within
    FROM strict JOIN spans ON day BETWEEN last_day - {DAYS - 1} AND last_day GROUP BY bot_name, last_day"""
)
def uv_week_sketched(spark, sf_dir):
    """UV of seven days from merged sketches of days, stored in two batches, next to the exact figure: it lies within the bound."""
    store = KpiStore(spark, scratch_dir(spark, "sketches"))
    requests = materialize(spark, _clean(spark, sf_dir).select("bot_name", "day", "user_id"), "requests")
    for k in range(2):
        part = requests.where(F.pmod(F.xxhash64("user_id", "day"), F.lit(2)) == k)
        store.append("user_sketches", history.user_sketches(part), "sketches", k, kind="job")
    sketches = store.rows("user_sketches").withColumn("bucket", F.lit(0)).withColumnRenamed("sketch", "bits")
    found = history.sketched_uv(bitmaps.rolling(sketches, DAYS).withColumnRenamed("bits", "sketch"), "bot_name", "day")
    upto = F.explode(F.sequence("day", F.least(F.date_add("day", DAYS - 1), F.lit(requests.agg(F.max("day")).first()[0]).cast("date"))))
    exact = requests.select("bot_name", "user_id", upto.alias("day")).groupBy("bot_name", "day").agg(F.count_distinct("user_id").alias("exact"))
    near = F.abs(F.col("uv") - F.col("exact")) <= F.greatest(F.lit(1.0), history.UV_ERROR * F.col("exact"))
    return exact.join(found, ["bot_name", "day"]).select("bot_name", "day", "exact", near.alias("within"))


@query(
    r.STRICT + """SELECT bot_name, count(*) AS seconds, TRUE AS within FROM (
      SELECT DISTINCT bot_name, day, second FROM strict) GROUP BY bot_name"""
)
def load_quantiles_sketched(spark, sf_dir):
    """Quantiles of requests per second over all days, from merged sketches of days: the true rank of each is within the bound."""
    store = KpiStore(spark, scratch_dir(spark, "sketches"))
    qps = materialize(spark, kpi.qps_bot(_clean(spark, sf_dir)), "qps")
    store.append("load_sketches", history.load_sketches(qps), "sketches", kind="job")
    found = history.sketched_loads(store.folded("load_sketches"), SHARES, "bot_name")
    joined = qps.join(found, "bot_name").groupBy("bot_name", "seconds")
    sides = []
    for share in SHARES:
        load = F.col(f"p{round(100 * share)}")
        sides.append(F.avg((F.col("requests") < load).cast("int")) <= share + history.RANK_ERROR)
        sides.append(F.avg((F.col("requests") <= load).cast("int")) >= share - history.RANK_ERROR)
    within = sides[0]
    for side in sides[1:]:
        within = within & side
    return joined.agg(within.alias("within")).select("bot_name", "seconds", "within")


# --- versions -------------------------------------------------------------------------------------


@query(
    r.STRICT + f""", {r.FIRST_SEEN} SELECT bot_name, day, user_id, CAST(CASE WHEN day = DATE '{r.ROLLBACK_DAY}' THEN -1 ELSE 1 END AS BIGINT) AS change
    FROM first_seen WHERE day = DATE '{r.ROLLBACK_DAY}' OR day >= DATE '2024-01-06'"""
)
def changes_of_new_users(spark, sf_dir):
    """What a roll-back and a later load changed in the published new users; days that did not change are not read."""
    root = scratch_dir(spark, "versions")
    store = KpiStore(spark, f"{root}/tables")
    visits = materialize(spark, kpi.users_day(_clean(spark, sf_dir)), "visits")
    first = visits.groupBy(*kpi.USER).agg(F.min("day").alias("day")).withColumn("arrived", F.lit(f"{r.AS_OF} 00:00:00").cast("timestamp"))
    early = F.col("day") < F.lit("2024-01-06").cast("date")
    store.append("first_seen", first.where(early), "early", kind="job")
    jobs.publish(store, f"{root}/published")
    jobs.rollback_day(store, r.ROLLBACK_DAY)
    store.append("first_seen", first.where(~early), "late", kind="job")
    jobs.publish(store, f"{root}/published")
    return jobs.changes(spark, f"{root}/published", "new_users_day", 1, 2)
