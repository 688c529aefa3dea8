"""Streams that wait for event time: answers to requests, and sessions of users.

Both keep state up to a watermark: the latest time met less ``delay``, which is how late a line may come and still be
matched. Lines later than that take no part here; the batch functions over the stored text count them. What a stream gives is
appended to the tables once, when it is final.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatmeter.operators import timed
from chatmeter.operators.kpi import USER
from chatmeter.sources.sinks import per_batch
from chatmeter.sources.store import KpiStore
from chatmeter.streaming.pipeline import EVERY_SECOND, run_of

DELAY = "10 minutes"


def _start(df: DataFrame, store: KpiStore, table: str, checkpoint: str, source: str, trigger: dict) -> StreamingQuery:
    def action(batch: DataFrame, batch_id: int) -> None:
        store.append(table, batch, run_of(store.spark, source, checkpoint), batch_id)

    return per_batch(df, action, checkpoint).outputMode("append").trigger(**trigger).start()


def start_answers(
    lines: DataFrame,
    store: KpiStore,
    checkpoint: str,
    source: str,
    within: int = timed.WITHIN,
    delay: str = DELAY,
    trigger: dict = EVERY_SECOND,
) -> StreamingQuery:
    """Requests with the first response to each, or without any: one row for each time at which a user asked.

    The state holds a row for each user and span of ``within`` seconds, with the times asked and answered in it, each time once. A
    response is met by the requests of its own span and of the one before, so it counts in both. Requests and responses combine on
    the map side. A user's lines of other times are never read again, however many, as a join by user would; nor is a request
    reported before the watermark has passed all its responses.
    """
    last = F.expr(f"INTERVAL {int(within)} SECONDS")
    none = F.lit(None)
    # Spans are of the latest time of an answer, ``due``; the watermark, which follows it, keeps to ``delay`` of the time itself.
    delay = f"{delay} {int(within)} seconds"
    asked = timed.timed(lines).select(*USER, (F.col("at") + last).alias("due"), F.struct("at", "day").alias("ask"), none.cast("timestamp").alias("answer"))
    given = timed.timed(lines, timed.RESPONSE_KIND).select(
        *USER, F.explode(F.array(F.col("at") + last, F.col("at"))).alias("due"), none.cast("struct<at: timestamp, day: date>").alias("ask"), F.col("at").alias("answer")
    )
    both = asked.withWatermark("due", delay).unionByName(given.withWatermark("due", delay))
    spans = both.groupBy(*USER, F.window("due", f"{max(int(within), 1)} seconds"))
    found = spans.agg(F.collect_set("ask").alias("asks"), F.collect_set("answer").alias("answers"))
    rows = found.select(*USER, "answers", F.explode("asks").alias("ask"))
    first = F.array_min(F.filter("answers", lambda t: t.between(F.col("ask.at"), F.col("ask.at") + last)))
    rows = rows.select(*USER, "ask.day", F.col("ask.at").alias("asked"), first.alias("answered"))
    return _start(rows, store, "answers", checkpoint, source, trigger)


def start_sessions(
    lines: DataFrame,
    store: KpiStore,
    checkpoint: str,
    source: str,
    gap: str = timed.GAP,
    delay: str = DELAY,
    trigger: dict = EVERY_SECOND,
) -> StreamingQuery:
    """Sessions of users, merged in the state while requests come in, each written when it is over for good.

    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` combines a user's requests on the map side.
    """
    windows = timed.timed(lines).withWatermark("at", delay).groupBy(*USER, F.session_window("at", gap))
    found = windows.agg(F.count(F.lit(1)).alias("requests"), F.max("at").alias("ended"))
    return _start(timed.session_rows(found), store, "sessions", checkpoint, source, trigger)
