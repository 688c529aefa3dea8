"""KPIs that need the time of a request: answer times, sessions, busiest spans, and all levels in one pass.

The functions take requests with ``at``, the time of the line's text; a text that is a time to Python's ``strptime`` only, such as one
with a 61st second, counts at the start of its minute's last second.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatmeter.functions.text import WHITESPACE
from chatmeter.operators.clean import clean_events
from chatmeter.operators.kpi import USER

WITHIN = 30  # seconds in which a request is answered
GAP = "30 minutes"  # without a request, after which a session is over
SPAN = 60  # seconds of a busiest span
RESPONSE_KIND = "RESP"  # fixed value of the log format
_BLANKS = "[" + WHITESPACE.replace(" ", r"\x20") + "]+"


def at_of(second: Column) -> Column:
    """The time of a valid time text, whose parts may have one digit and blanks between.

    Nearly all texts are read as they are; only the others meet the regular expressions, which cost more than the rest of cleaning.
    """
    text = F.regexp_replace(F.regexp_replace(second, r"- (\d)", "-$1"), _BLANKS, " ")
    text = F.regexp_replace(text, r":6[01]$", ":59")
    return F.coalesce(second.try_cast("timestamp"), text.try_cast("timestamp"))


def timed(lines: DataFrame, kind: str = "REQ", **options) -> DataFrame:
    """Cleaned lines of one kind (requests, or responses to them) with their time."""
    return clean_events(lines, kind=kind, **options).withColumn("at", at_of(F.col("second"))).where(F.col("at").isNotNull())


# --- answers --------------------------------------------------------------------------------------


def answers(requests: DataFrame, responses: DataFrame, within: int = WITHIN) -> DataFrame:
    """(bot_name, user_id, day, asked, answered): each time at which a user asked, and when the first response to that user
    came within so many seconds; null where none did.

    The join is by user and span of time, so a user with a third of all lines is spread over the spans. A response
    is met by the requests of its own span and of the one before.
    """
    asked = requests.select(*USER, "day", F.col("at").alias("asked")).distinct()
    given = responses.select(*USER, F.col("at").alias("answered")).distinct()
    given = given.select("*", F.floor(F.unix_timestamp("answered") / within).alias("span"))
    span = F.floor(F.unix_timestamp("asked") / within)
    near = asked.select("*", F.explode(F.array(span, span + 1)).alias("span")).join(given, [*USER, "span"])
    first = near.where(_seconds().between(0, within)).select(*USER, "day", "asked", "answered")
    # Those without an answer come in by union and a minimum, which passes over nulls: no second join.
    return first_answers(asked.select("*", F.lit(None).cast("timestamp").alias("answered")).unionByName(first))


def _seconds() -> Column:
    return F.unix_timestamp("answered") - F.unix_timestamp("asked")


def first_answers(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*USER, "day", "asked").agg(F.min("answered").alias("answered"))


def answer_summary(found: DataFrame) -> DataFrame:
    """Of each bot and day: requests, answered ones, and the mean and highest seconds to an answer."""
    counts = [F.count(F.lit(1)).alias("requests"), F.count("answered").alias("answered")]
    return found.groupBy("bot_name", "day").agg(*counts, F.avg(_seconds()).alias("mean_seconds"), F.max(_seconds()).alias("most_seconds"))


# --- sessions -------------------------------------------------------------------------------------


def sessions(requests: DataFrame, gap: str = GAP) -> DataFrame:
    """(bot_name, user_id, day, started, ended, requests): runs of a user's requests with ``gap`` at most between; the day is
    that of the start.

    Requests of one second are counted on the map side first, so a user costs at most a row a second.
    """
    seconds = requests.groupBy(*USER, "at").agg(F.count(F.lit(1)).alias("n"))
    found = seconds.groupBy(*USER, F.session_window("at", gap)).agg(F.sum("n").alias("requests"), F.max("at").alias("ended"))
    return session_rows(found)


def session_rows(found: DataFrame) -> DataFrame:
    started = F.col("session_window.start")
    return found.select(*USER, F.to_date(started).alias("day"), started.alias("started"), "ended", "requests")


def session_summary(found: DataFrame) -> DataFrame:
    """Of each bot and day: sessions that began, their requests, and their mean length in seconds."""
    length = F.unix_timestamp("ended") - F.unix_timestamp("started")
    return found.groupBy("bot_name", "day").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("requests").alias("requests"), F.avg(length).alias("mean_seconds")
    )


# --- busiest spans --------------------------------------------------------------------------------


def busiest(requests: DataFrame, key: str, span: int = SPAN) -> DataFrame:
    """(key, day, requests, started): the span of so many seconds with the most requests that begins on each day; of equally
    busy ones the earliest. A span begins with a request and may reach into the next day.

    Sums run over counts per second. A window holds one hour of one key, and the first seconds of the next
    hour along with it, so no day and no key is one task.
    """
    counts = requests.groupBy(key, F.unix_timestamp("at").alias("second")).agg(F.count(F.lit(1)).alias("n"))
    return busiest_of(counts, key, span)


def busiest_of(counts: DataFrame, key: str, span: int = SPAN) -> DataFrame:
    """The same from counts (key, second, n), the second in unix time."""
    if not 0 < span <= 3600:
        raise ValueError(f"a span has 1 to 3600 seconds, not {span}")
    hour = F.floor(F.col("second") / 3600)
    carried = F.when(F.col("second") % 3600 < span - 1, F.array(hour, hour - 1)).otherwise(F.array(hour))
    rows = counts.select("*", hour.alias("own"), F.explode(carried).alias("hour"))
    frame = Window.partitionBy(key, "hour").orderBy("second").rangeBetween(0, span - 1)
    sums = rows.withColumn("requests", F.sum("n").over(frame)).where(F.col("own") == F.col("hour"))
    started = F.timestamp_seconds("second")
    best = F.struct(-F.col("requests"), F.col("second"))
    return sums.groupBy(key, F.to_date(started).alias("day")).agg(
        F.max("requests").alias("requests"), F.min_by(started, best).alias("started")
    )


# --- all levels -----------------------------------------------------------------------------------

LEVELS = ("product", "bot_name", "day")


def all_levels(requests: DataFrame) -> DataFrame:
    """PV and UV of every level over product, bot and day, in one pass; ``level`` is the grouping id, whose bit is 1 for
    a column that the level leaves out (4 product, 2 bot, 1 day). UV counts (bot, user), as all UV over bots do.

    Requests are counted per user first, so what is expanded to the eight levels are users of a day, and users are
    told apart per level by an exchange on level and user, which spreads a hot bot.
    """
    visits = requests.groupBy(*LEVELS, "user_id").agg(F.count(F.lit(1)).alias("n")).withColumn("of", F.col("bot_name"))
    sets = [[F.col(c) for c in some] for k in range(len(LEVELS), -1, -1) for some in combinations(LEVELS, k)]
    level = F.grouping_id().cast("int").alias("level")
    return visits.groupingSets(sets, *[F.col(c) for c in LEVELS]).agg(
        level, F.sum("n").alias("pv"), F.count_distinct("of", "user_id").alias("uv")
    )
