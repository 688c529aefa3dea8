"""Where queries register themselves, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key], SQL[key] = function, sql
        return function

    return register


# What cleaning keeps of the test lines, said on the raw events (FIXTURES.md §2): no line is parsed
# here. `strict` checks the time, `loose` does not, `cased` also lets `Monitor...` users pass.
_BASE = """event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 19 <> 0 AND event_id % 37 <> 0
  AND event_id % 23 <> 0 AND (event_id % 29 = 0 OR event_id % 31 <> 0)"""
_COLUMNS = """CASE CAST(user_id % 3 AS INT) WHEN 0 THEN 'adult' WHEN 1 THEN 'children' ELSE 'general' END AS product,
  event_type AS bot_name, {user} AS user_id, CAST(ts AS DATE) AS day,
  {second} AS second"""
_CLOCK = "strftime(CAST(ts AS DATE), '%Y-%m-%d') || ' 00:00:' || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0')"
_RAW_CLOCK = f"CASE WHEN event_id % 17 = 0 THEN 'not-a-time' ELSE {_CLOCK} END"
_PLAIN_USER = "'u' || user_id"
_CASED_USER = "CASE WHEN event_id % 29 = 0 THEN 'Monitor' || user_id ELSE 'u' || user_id END"

STRICT = f"""WITH strict AS (SELECT {_COLUMNS.format(user=_PLAIN_USER, second=_CLOCK)}
  FROM events WHERE {_BASE} AND event_id % 29 <> 0 AND event_id % 17 <> 0)
"""
# The same with the micro-batch that brings a request, where the events come in so many parts by id.
BATCHES = 8
BATCHED = f"""WITH batched AS (SELECT {_COLUMNS.format(user=_PLAIN_USER, second=_CLOCK)},
    event_id * {BATCHES} // (SELECT max(event_id) + 1 FROM events) AS batch
  FROM events WHERE {_BASE} AND event_id % 29 <> 0 AND event_id % 17 <> 0),
arrivals AS (SELECT *, min(batch) OVER (PARTITION BY bot_name, user_id) AS first_batch FROM batched),
first_arrival AS (SELECT bot_name, user_id, min(day) AS day FROM arrivals WHERE batch = first_batch GROUP BY bot_name, user_id)
"""
LOOSE = f"""WITH loose AS (SELECT {_COLUMNS.format(user=_PLAIN_USER, second=_RAW_CLOCK)}
  FROM events WHERE {_BASE} AND event_id % 29 <> 0)
"""
CASED = f"""WITH cased AS (SELECT {_COLUMNS.format(user=_CASED_USER, second=_RAW_CLOCK)}
  FROM events WHERE {_BASE})
"""

# Parameters of the registered queries.
AS_OF = "2024-02-01"  # the clock of the processing-time queries
STORED_UNTIL = "2024-01-03"  # requests before this day make up the stored state
ROLLBACK_DAY = "2024-01-03"
BOT_TYPE = "children"
PURGED = ("error", "view")

FIRST_SEEN = "first_seen AS (SELECT bot_name, user_id, min(day) AS day FROM strict GROUP BY bot_name, user_id)"
DIM_BOT = """dim_bot AS (SELECT DISTINCT CASE WHEN event_type IN ('click', 'purchase') THEN 'adult'
  WHEN event_type IN ('view', 'signup') THEN 'children' ELSE 'general' END AS type, event_type AS bot_name FROM events)"""
