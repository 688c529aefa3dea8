"""The KPI streams: cleaned requests in micro-batches, appended to the KPI tables.

Streams need no watermark: a late request is counted on its own day. No state is kept in the
stream either, except by ``start_users_day``, which can bound it by one; the tables are the state. A restarted query repeats
at most its last batch, under the same number, which takes the place of what it had written.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatmeter.operators import kpi
from chatmeter.operators.clean import clean_events
from chatmeter.operators.generic import word_count
from chatmeter.schema import WORD_COUNTS
from chatmeter.sources import deltas
from chatmeter.sources.sinks import per_batch
from chatmeter.sources.store import KpiStore

# Cleaning options of the streams in use, by the rules each applies.
EVENT_TIME = {}
PROCESSING_TIME = {"check_time": False, "day_mode": "processing"}
PROCESSING_TIME_CASE_SENSITIVE = PROCESSING_TIME | {"ignore_case": False}

EVERY_SECOND = {"processingTime": "1 second"}
ONCE = {"availableNow": True}
SKEW = "1 hour"  # by which the clocks of successive drivers of a stream may differ
UPKEEP = 100  # batches after which a stream compacts


def cleaned(lines: DataFrame, **options) -> DataFrame:
    """Cleaned requests with the time of their micro-batch, which a repeated batch keeps."""
    return clean_events(lines, **options).withColumn("arrived", F.current_timestamp())


# --- what one micro-batch writes ----------------------------------------------------------------


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` in memory, or on disk where that is short, while several tables are written from it."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def write_pv(store: KpiStore, requests: DataFrame, source: str, batch: int) -> None:
    with kept(kpi.pv_day(requests)) as by_day:
        _append_pv(store, by_day, source, batch)


def _append_pv(store: KpiStore, by_day: DataFrame, source: str, batch: int) -> None:
    store.append("pv_day", by_day, source, batch)
    store.append("pv_total", by_day.groupBy("bot_name").agg(F.sum("pv").alias("pv")), source, batch)


def per_second(requests: DataFrame) -> DataFrame:
    """Requests per product, bot and second, the common grain of both QPS tables and of the page views."""
    return requests.groupBy("product", "bot_name", "day", "second").agg(F.count(F.lit(1)).alias("requests"))


def write_qps(store: KpiStore, requests: DataFrame, source: str, batch: int) -> None:
    store.append("qps", per_second(requests), source, batch)


def write_new_users(store: KpiStore, requests: DataFrame, source: str, batch: int) -> None:
    """Users of the batch with their earliest day in it.

    Whether a user was known before is settled on reading, by the earliest arrival. A lookup here
    would read the table of all users ever seen for each batch.
    """
    first = requests.groupBy(*kpi.USER).agg(F.min("day").alias("day"), F.min("arrived").alias("arrived"))
    store.append("first_seen", first, source, batch)


def write_users(store: KpiStore, requests: DataFrame, source: str, batch: int) -> None:
    visits = requests.groupBy("bot_name", "day", "user_id").agg(F.min("arrived").alias("arrived"))
    with kept(visits) as visits:
        store.append("users_day", visits, source, batch)
        write_new_users(store, visits, source, batch)


def write_all(store: KpiStore, requests: DataFrame, source: str, batch: int) -> None:
    """All tables from one cleaned batch, which is parsed once and kept for the two branches.

    Page views are summed from the requests per second, not counted over the requests again.
    """
    with kept(requests) as requests:
        with kept(per_second(requests)) as seconds:
            store.append("qps", seconds, source, batch)
            _append_pv(store, seconds.groupBy("bot_name", "day").agg(F.sum("requests").alias("pv")), source, batch)
        write_users(store, requests, source, batch)


# --- queries ------------------------------------------------------------------------------------


def run_of(spark: SparkSession, source: str, checkpoint: str) -> str:
    """The writer of a stream's batches: its name and the id that Spark keeps in the checkpoint.

    From the same checkpoint a query goes on under its id and repeats no number but its last; from a new one it
    has a new id, and its batch 0 is not the one that is there.
    """
    return f"{source}@{json.loads(deltas.read_text(spark, f'{checkpoint}/metadata'))['id']}"


def _plain_name(source: str) -> None:
    if "@" in deltas.writer("stream", source):
        raise ValueError(f"a stream's name holds no '@': {source!r}")


def start_kpis(
    lines: DataFrame,
    store: KpiStore,
    checkpoint: str,
    source: str,
    write: Callable[[KpiStore, DataFrame, str, int], None] = write_all,
    trigger: dict = EVERY_SECOND,
    upkeep: int = UPKEEP,
    **cleaning,
) -> StreamingQuery:
    """Run ``write`` on each cleaned micro-batch of ``lines`` (topic, value).

    ``source`` names the stream. From ``checkpoint`` the query goes on where it stopped; where the folder is empty it
    starts anew, and what it then reads is added to what is there. Every ``upkeep``
    batches the stream compacts its batches by levels and deletes what is obsolete for a day; 0: never.
    """
    _plain_name(source)

    def action(batch: DataFrame, batch_id: int) -> None:
        write(store, batch, run_of(store.spark, source, checkpoint), batch_id)
        if upkeep and (batch_id + 1) % upkeep == 0:
            store.compact(source, every=upkeep)
            store.vacuum()

    return per_batch(cleaned(lines, **cleaning), action, checkpoint).queryName(source).trigger(**trigger).start()


def start_users_day(
    lines: DataFrame,
    store: KpiStore,
    checkpoint: str,
    source: str,
    trigger: dict = EVERY_SECOND,
    retention: str | None = None,
    clock: Column | None = None,
    **cleaning,
) -> StreamingQuery:
    """Users of each day, each written once in all, with the seen ones in the state store.

    A running aggregate combines on the map side before it meets the state, so a user with a large
    share of the requests costs one row per task; ``dropDuplicates``, within a watermark or not, would send all
    those rows to one task. First and last arrival are the same exactly in the batch that brings a user.

    Without ``retention`` the state holds every (bot, day, user) for good. With one (``'3 days'``) an event-time watermark
    follows the days and the state holds the users of the days within it. What the watermark may leave out goes past the
    state into the table, where a user of a day counts once however often written: all rows of days older than the clock less
    the retention. The watermark never passes that point, as days ahead of the clock move it no further than the clock; clocks of
    drivers may differ by ``SKEW``. ``clock`` is the time of arrival unless given, as for a replay of old
    logs, in which all days would be late.

    The state is hashed over the shuffle partitions of the first start; give it the RocksDB provider, as
    ``local_session`` does. ``write_users`` needs no state.
    """
    _plain_name(source)
    requests = cleaned(lines, **cleaning)
    if retention is None:
        out = _arrivals(requests.groupBy("bot_name", "day", "user_id")).withColumn("late", F.lit(False))
    else:
        now = F.col("arrived") if clock is None else clock.cast("timestamp")
        requests = requests.withColumn("at", F.least(F.col("day").cast("timestamp"), now))
        late = requests.where(F.col("at") <= now - F.expr(f"INTERVAL {retention}") + F.expr(f"INTERVAL {SKEW}"))
        late = late.select("bot_name", "day", "user_id", F.col("arrived").alias("first"), F.col("arrived").alias("last"), F.lit(True).alias("late"))
        held = _arrivals(requests.withWatermark("at", retention).groupBy("bot_name", "day", "user_id", "at"))
        out = held.drop("at").withColumn("late", F.lit(False)).unionByName(late)

    def action(batch: DataFrame, batch_id: int) -> None:
        new = batch.where("late or first = last")
        new = new if retention is None else new.select("bot_name", "day", "user_id").distinct()
        store.append("users_day", new, run_of(store.spark, source, checkpoint), batch_id)

    return per_batch(out, action, checkpoint).outputMode("update").trigger(**trigger).start()


def _arrivals(visits: GroupedData) -> DataFrame:
    return visits.agg(F.min("arrived").alias("first"), F.max("arrived").alias("last"))


def start_word_count(lines: DataFrame, table: str, checkpoint: str, trigger: dict = EVERY_SECOND) -> StreamingQuery:
    """Word counts of each micro-batch, no running total."""

    def action(batch: DataFrame, batch_id: int) -> None:
        of = run_of(lines.sparkSession, "words", checkpoint)
        deltas.write_delta(word_count(batch).to(WORD_COUNTS), table, "stream", of, batch_id)

    return per_batch(lines, action, checkpoint).trigger(**trigger).start()
