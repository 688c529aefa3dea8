"""Registered queries on answers, sessions, busiest spans and all levels, as batch jobs and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmeter.operators import timed
from chatmeter.plans import registry as r
from chatmeter.plans.registry import query
from chatmeter.session import ROCKSDB, scratch_dir
from chatmeter.sources import testtables
from chatmeter.sources.store import KpiStore
from chatmeter.streaming import pipeline
from chatmeter.streaming import timed as streams

GAP = 5  # seconds: the test lines of a day lie within one minute
SPAN = 10
DELAY = "1 day"
CUTS = (None, "2024-01-08", "2024-01-16", "2024-01-24", None)

_AT = "CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_seconds(CAST(event_id % 60 AS INT))"
_RESPONSES = f"""responses AS (SELECT DISTINCT event_type AS bot_name, 'u' || user_id AS user_id, {_AT} AS answered FROM events
  WHERE {r._BASE.replace('event_id % 11 <> 0', 'event_id % 11 = 0')} AND event_id % 29 <> 0 AND event_id % 17 <> 0)"""
_TIMED = "timed AS (SELECT *, CAST(second AS TIMESTAMP) AS moment FROM strict)"
_ANSWERS = f"""{_TIMED}, {_RESPONSES}, found AS (
  SELECT t.bot_name, t.user_id, t.day, t.moment AS asked, min(answered) AS answered
  FROM (SELECT DISTINCT bot_name, user_id, day, moment FROM timed) t LEFT JOIN responses s
    ON s.bot_name = t.bot_name AND s.user_id = t.user_id AND answered BETWEEN moment AND moment + INTERVAL {timed.WITHIN} SECOND
  GROUP BY ALL)"""
_SESSIONS = f"""{_TIMED},
  starts AS (SELECT *, CASE WHEN moment <= lag(moment) OVER (PARTITION BY bot_name, user_id ORDER BY moment) + INTERVAL {GAP} SECOND THEN 0 ELSE 1 END AS new
    FROM timed),
  runs AS (SELECT *, sum(new) OVER (PARTITION BY bot_name, user_id ORDER BY moment) AS run FROM starts),
  found AS (SELECT bot_name, user_id, CAST(min(moment) AS DATE) AS day, min(moment) AS started, max(moment) AS ended, count(*) AS requests
    FROM runs GROUP BY bot_name, user_id, run)"""
# What a stream has given by the end: days that the watermark has passed for sure.
_CLOSED = "WHERE day < (SELECT CAST(max(ts) AS DATE) FROM events) - 2"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testtables.log_lines(testtables.table(spark, sf_dir, "events"))


@query(r.STRICT + f", {_ANSWERS} SELECT * FROM found")
def answers(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    return timed.answers(timed.timed(lines), timed.timed(lines, timed.RESPONSE_KIND))


@query(
    r.STRICT + f""", {_ANSWERS} SELECT bot_name, day, count(*) AS requests, count(answered) AS answered,
    avg(epoch(answered) - epoch(asked)) AS mean_seconds, CAST(max(epoch(answered) - epoch(asked)) AS BIGINT) AS most_seconds
    FROM found GROUP BY bot_name, day"""
)
def answer_summary(spark, sf_dir):
    return timed.answer_summary(answers(spark, sf_dir))


@query(r.STRICT + f", {_SESSIONS} SELECT * REPLACE (CAST(requests AS BIGINT) AS requests) FROM found")
def sessions(spark, sf_dir):
    return timed.sessions(timed.timed(_lines(spark, sf_dir)), f"{GAP} seconds")


@query(
    r.STRICT + f""", {_SESSIONS} SELECT bot_name, day, count(*) AS sessions, CAST(sum(requests) AS BIGINT) AS requests,
    avg(epoch(ended) - epoch(started)) AS mean_seconds FROM found GROUP BY bot_name, day"""
)
def session_summary(spark, sf_dir):
    return timed.session_summary(sessions(spark, sf_dir))


_BUSIEST = """, {timed}, counts AS (SELECT {key}, moment, count(*) AS n FROM timed GROUP BY {key}, moment),
  sums AS (SELECT {key}, CAST(moment AS DATE) AS day, moment, sum(n) OVER (PARTITION BY {key} ORDER BY moment
    RANGE BETWEEN CURRENT ROW AND INTERVAL {last} SECOND FOLLOWING) AS requests FROM counts)
  SELECT {key}, day, CAST(requests AS BIGINT) AS requests, moment AS started FROM sums
  QUALIFY row_number() OVER (PARTITION BY {key}, day ORDER BY requests DESC, moment) = 1"""


@query(r.STRICT + _BUSIEST.format(timed=_TIMED, key="bot_name", last=timed.SPAN - 1))
def busiest_minute_bot(spark, sf_dir):
    return timed.busiest(timed.timed(_lines(spark, sf_dir)), "bot_name")


@query(r.STRICT + _BUSIEST.format(timed=_TIMED, key="product", last=SPAN - 1))
def busiest_seconds_product(spark, sf_dir):
    return timed.busiest(timed.timed(_lines(spark, sf_dir)), "product", SPAN)


@query(
    r.STRICT + """SELECT product, bot_name, day, CAST(grouping_id(product, bot_name, day) AS INT) AS level, count(*) AS pv,
    count(DISTINCT (strict.bot_name, user_id)) AS uv FROM strict GROUP BY CUBE (product, bot_name, day)"""
)
def all_levels(spark, sf_dir):
    return timed.all_levels(timed.clean_events(_lines(spark, sf_dir)))


def _run(spark: SparkSession, sf_dir: str, start, **options) -> KpiStore:
    """The lines in parts by day, written in one scan, each read by a new query that goes on from the checkpoint."""
    root = scratch_dir(spark, "timed")
    store = KpiStore(spark, f"{root}/tables")
    day = F.col("ts").cast("date")
    part = sum((F.when(day >= F.lit(cut).cast("date"), 1).otherwise(0) for cut in CUTS[1:-1]), F.lit(0))
    testtables.write_parts(testtables.table(spark, sf_dir, "events"), part, root)
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    try:
        spark.conf.set(provider, ROCKSDB)
        for k in range(len(CUTS) - 1):
            lines = testtables.stream_of_part(spark, root, k)
            if lines is None:
                continue
            start(lines, store, f"{root}/checkpoint", "timed", delay=DELAY, trigger=pipeline.ONCE, **options).awaitTermination()
    finally:
        spark.conf.set(provider, before)
    return store


def _closed(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    last = testtables.table(spark, sf_dir, "events").agg(F.max("ts").cast("date")).first()[0]
    return rows.where(F.col("day") < F.date_sub(F.lit(last).cast("date"), 2))


@query(r.STRICT + f", {_ANSWERS} SELECT * FROM found {_CLOSED}")
def stream_answers(spark, sf_dir):
    """Both kinds of lines in the state; requests come, with the first answer, when the watermark has passed."""
    return _closed(spark, sf_dir, _run(spark, sf_dir, streams.start_answers).folded("answers"))


@query(r.STRICT + f", {_SESSIONS} SELECT * REPLACE (CAST(requests AS BIGINT) AS requests) FROM found {_CLOSED}")
def stream_sessions(spark, sf_dir):
    return _closed(spark, sf_dir, _run(spark, sf_dir, streams.start_sessions, gap=f"{GAP} seconds").rows("sessions"))
