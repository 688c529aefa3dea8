"""Registered queries that run a stream to its end and return what it left in the tables.

The KPI streams take the events table itself as their source, so the log is not copied first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmeter.operators import kpi
from chatmeter.plans import registry as r
from chatmeter.plans.registry import query
from chatmeter.schema import TOPIC_LINES, WORD_COUNTS
from chatmeter.session import ROCKSDB, scratch_dir
from chatmeter.sources import deltas, testtables
from chatmeter.sources.readers import as_lines, stream_lines, stream_table
from chatmeter.sources.store import KpiStore
from chatmeter.streaming import pipeline


def _line_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = stream_table(spark, f"{sf_dir}/events.parquet", testtables.EVENTS)
    return testtables.log_lines(events)


def _run(spark: SparkSession, sf_dir: str, name: str, write) -> KpiStore:
    root = scratch_dir(spark, name)
    store = KpiStore(spark, f"{root}/tables")
    stream = pipeline.start_kpis(
        _line_stream(spark, sf_dir), store, f"{root}/checkpoint", name, write, trigger=pipeline.ONCE
    )
    stream.awaitTermination()
    return store


@query(r.STRICT + "SELECT bot_name, day, count(*) AS pv FROM strict GROUP BY bot_name, day")
def stream_pv(spark, sf_dir):
    return _run(spark, sf_dir, "stream_pv", pipeline.write_pv).pv_day()


@query(r.STRICT + "SELECT bot_name, day, second, count(*) AS requests FROM strict GROUP BY bot_name, day, second")
def stream_qps(spark, sf_dir):
    return _run(spark, sf_dir, "stream_qps", pipeline.write_qps).qps_bot()


@query(r.STRICT + f", {r.FIRST_SEEN} SELECT bot_name, day, user_id FROM first_seen")
def stream_new_users(spark, sf_dir):
    return _run(spark, sf_dir, "stream_new_users", pipeline.write_new_users).new_users_day()


@query(r.STRICT + "SELECT DISTINCT bot_name, day, user_id FROM strict")
def stream_users_day(spark, sf_dir):
    """With the seen users in the state store; the table has each once without a distinct."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    root = scratch_dir(spark, "stream_users_day")
    store = KpiStore(spark, f"{root}/tables")
    lines = _line_stream(spark, sf_dir)
    try:
        spark.conf.set(provider, ROCKSDB)
        pipeline.start_users_day(lines, store, f"{root}/checkpoint", "users", trigger=pipeline.ONCE).awaitTermination()
    finally:
        spark.conf.set(provider, before)
    return store.rows("users_day")


@query(
    r.STRICT + f""", {r.FIRST_SEEN}
    SELECT 'pv_total' AS kpi, bot_name AS key, 'all' AS day, count(*) AS value FROM strict GROUP BY bot_name
    UNION ALL SELECT 'pv_day', bot_name, CAST(day AS VARCHAR), count(*) FROM strict GROUP BY bot_name, day
    UNION ALL SELECT 'uv_total', bot_name, 'all', count(DISTINCT user_id) FROM strict GROUP BY bot_name
    UNION ALL SELECT 'uv_day', bot_name, CAST(day AS VARCHAR), count(DISTINCT user_id) FROM strict GROUP BY bot_name, day
    UNION ALL SELECT 'new_uv_day', bot_name, CAST(day AS VARCHAR), count(*) FROM first_seen GROUP BY bot_name, day
    UNION ALL SELECT 'top_qps_bot', bot_name, CAST(day AS VARCHAR), max(n) FROM (
      SELECT bot_name, day, second, count(*) AS n FROM strict GROUP BY bot_name, day, second) GROUP BY bot_name, day
    UNION ALL SELECT 'top_qps_product', product, CAST(day AS VARCHAR), max(n) FROM (
      SELECT product, day, second, count(*) AS n FROM strict GROUP BY product, day, second) GROUP BY product, day
    UNION ALL SELECT 'registered', bot_name, 'all', 1 FROM (SELECT DISTINCT bot_name FROM first_seen)"""
)
def stream_all(spark, sf_dir):
    """One stream fills every table; all KPIs are then read from the tables."""
    return _all_kpis(_run(spark, sf_dir, "stream_all", pipeline.write_all))


def _all_kpis(store: KpiStore) -> DataFrame:
    def named(name: str, df: DataFrame, key: str, value: str) -> DataFrame:
        day = F.col("day").cast("string") if "day" in df.columns else F.lit("all")
        return df.select(F.lit(name).alias("kpi"), F.col(key).alias("key"), day.alias("day"), F.col(value).alias("value"))

    parts = [
        named("pv_total", store.pv_total(), "bot_name", "pv"),
        named("pv_day", store.pv_day(), "bot_name", "pv"),
        named("uv_total", kpi.uv_total(store.users_total()), "bot_name", "uv"),
        named("uv_day", kpi.uv_day(store.users_day()), "bot_name", "uv"),
        named("new_uv_day", kpi.uv_day(store.new_users_day()), "bot_name", "uv"),
        named("top_qps_bot", kpi.top_qps(store.qps_bot(), "bot_name"), "bot_name", "requests"),
        named("top_qps_product", kpi.top_qps(store.qps_product(), "product"), "product", "requests"),
        named("registered", store.bot_registry().withColumn("one", F.lit(1).cast("bigint")), "bot_name", "one"),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# --- several micro-batches ------------------------------------------------------------------------


def _run_in_parts(spark: SparkSession, sf_dir: str, name: str, write, **cleaning) -> KpiStore:
    """The events in ``BATCHES`` parts by id, written in one scan; each part comes into the watched folder as it is, is one micro-batch
    whatever the number of its files, and is read by a new query from the checkpoint. Half way the batches are compacted."""
    root = scratch_dir(spark, name)
    store = KpiStore(spark, f"{root}/tables")
    events = testtables.table(spark, sf_dir, "events")
    top = events.agg(F.max("event_id") + 1).first()[0] or 1
    testtables.write_parts(events, F.floor(F.col("event_id") * r.BATCHES / top), root)
    for k in range(r.BATCHES):
        source = testtables.stream_of_part(spark, root, k)
        if source is None:
            continue
        stream = pipeline.start_kpis(source, store, f"{root}/checkpoint", name, write, trigger=pipeline.ONCE, **cleaning)
        stream.awaitTermination()
        if k == r.BATCHES // 2 - 1:
            store.compact(name)
    store.compact(name)
    return store


@query(r.BATCHED + "SELECT bot_name, day, user_id FROM first_arrival")
def stream_parts_new_users(spark, sf_dir):
    """First come, first kept: the day of a user is the earliest of the batch that brought the user."""
    return _run_in_parts(spark, sf_dir, "parts_new_users", pipeline.write_new_users).new_users_day()


@query(r.CASED + f"SELECT bot_name, DATE '{r.AS_OF}' AS day, count(*) AS pv FROM cased GROUP BY bot_name")
def stream_parts_pv_processing(spark, sf_dir):
    """By the clock of processing, which is given here."""
    rules = pipeline.PROCESSING_TIME_CASE_SENSITIVE | {"as_of": r.AS_OF}
    return _run_in_parts(spark, sf_dir, "parts_pv", pipeline.write_pv, **rules).pv_day()


@query(
    r.BATCHED + """, totals AS (SELECT day, count(*) AS pv, count(DISTINCT (bot_name, user_id)) AS uv FROM batched GROUP BY day)
    SELECT day, pv, uv, CAST(coalesce(new_uv, 0) AS BIGINT) AS new_uv FROM totals
    LEFT JOIN (SELECT day, count(*) AS new_uv FROM first_arrival GROUP BY day) USING (day)"""
)
def stream_parts_overall(spark, sf_dir):
    """Every table filled, and the overall KPIs of each day read from them."""
    return _run_in_parts(spark, sf_dir, "parts_all", pipeline.write_all).overall_by_day()


@query(
    """SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split(line, ' ')) AS word FROM (
      SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) GROUP BY word"""
)
def stream_wordcount(spark, sf_dir):
    """Over a folder of text files; the counts of the batches are summed here."""
    root = scratch_dir(spark, "stream_wordcount")
    as_lines(testtables.table(spark, sf_dir, "documents"), "text").write.text(f"{root}/texts")
    stream = pipeline.start_word_count(
        stream_lines(spark, f"{root}/texts"), f"{root}/counts", f"{root}/checkpoint", trigger=pipeline.ONCE
    )
    stream.awaitTermination()
    counts = deltas.read_deltas(spark, f"{root}/counts", WORD_COUNTS)
    return counts.groupBy("word").agg(F.sum("cnt").alias("cnt"))


@query(r.STRICT + "SELECT bot_name, day, count(*) AS pv FROM strict GROUP BY bot_name, day")
def stream_anew_pv(spark, sf_dir):
    """A stream that starts anew twice, the second time after a compaction: each start adds what it reads."""
    root = scratch_dir(spark, "stream_anew")
    store = KpiStore(spark, f"{root}/tables")
    events = testtables.table(spark, sf_dir, "events")
    for k in range(3):
        testtables.log_lines(events.where(F.col("event_id") % 3 == k)).write.parquet(f"{root}/in{k}")
        lines = spark.readStream.schema(TOPIC_LINES).parquet(f"{root}/in{k}")
        stream = pipeline.start_kpis(lines, store, f"{root}/checkpoint{k}", "anew", pipeline.write_pv, trigger=pipeline.ONCE)
        stream.awaitTermination()
        if k == 1:
            store.compact("anew")
    return store.pv_day()


@query(r.STRICT + "SELECT DISTINCT bot_name, day, user_id FROM strict")
def stream_users_day_bounded(spark, sf_dir):
    """Day-distinct users with a state that holds the days within the retention; earlier days reach the table past it."""
    root = scratch_dir(spark, "stream_users_day_bounded")
    store = KpiStore(spark, f"{root}/tables")
    events = testtables.table(spark, sf_dir, "events")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    try:
        spark.conf.set(provider, ROCKSDB)
        for k in range(3):
            testtables.log_lines(events.where(F.col("event_id") % 3 == k)).write.mode("append").parquet(f"{root}/in")
            lines = spark.readStream.schema(TOPIC_LINES).parquet(f"{root}/in")
            stream = pipeline.start_users_day(
                lines, store, f"{root}/checkpoint", "users", pipeline.ONCE, retention="20 days", clock=F.lit(r.AS_OF)
            )
            stream.awaitTermination()
    finally:
        spark.conf.set(provider, before)
    return store.users_day()
