"""Schemas of the inputs and of the KPI tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "date": T.DateType(), "timestamp": T.TimestampType(), "binary": T.BinaryType()}


def _struct(columns: str) -> T.StructType:
    """Nullable columns from ``name type, ...``; unlike a DDL parse it needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in pairs])


LINES = _struct("value string")
TOPIC_LINES = _struct("topic string, value string")

# One cleaned request. `second` is the time text of the log line.
REQUEST = _struct("product string, bot_name string, user_id string, day date, second string")

PV_TOTAL = _struct("bot_name string, pv bigint")
PV_DAY = _struct("bot_name string, day date, pv bigint")
USERS_TOTAL = _struct("bot_name string, user_id string")
USERS_DAY = _struct("bot_name string, day date, user_id string")
QPS_BOT = _struct("bot_name string, day date, second string, requests bigint")
QPS_PRODUCT = _struct("product string, day date, second string, requests bigint")
DIM_BOT = _struct("type string, bot_name string")

# Rows as the jobs append them (see sources/deltas.py); the KPI tables are read-time aggregates.
QPS_DELTA = _struct("product string, bot_name string, day date, second string, requests bigint")
FIRST_SEEN_DELTA = _struct("bot_name string, user_id string, day date, arrived timestamp")
ANSWERS = _struct("bot_name string, user_id string, day date, asked timestamp, answered timestamp")
SESSIONS = _struct("bot_name string, user_id string, day date, started timestamp, ended timestamp, requests bigint")
SKETCHES = _struct("bot_name string, day date, sketch binary")

WORD_COUNTS = _struct("word string, cnt bigint")
PEOPLE_TEXT = _struct("name string, age string")
