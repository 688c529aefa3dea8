"""KPIs over a user's or a bot's history: types as they were, retention, and sketches that merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatmeter.operators.kpi import USER

SLICE = 86_400  # seconds of a bot's time that one task sorts
UPTO = 14  # days after the first that retention looks at
LG_CONFIG = 12  # of the distinct sketches: 2^12 registers, an error of 1.6 % (one standard deviation)
UV_ERROR = 0.06  # within which a sketched UV lies, nearly four deviations
K = 200  # of the quantile sketches: a rank error of 1.65 % at 99 %
RANK_ERROR = 0.025


# --- the type valid then --------------------------------------------------------------------------


def types_then(requests: DataFrame, dimension: DataFrame, slice_seconds: int = SLICE) -> DataFrame:
    """``requests`` with ``type``: that of the dimension's latest row (bot_name, type, valid_from) up to their time ``at``; null where
    the dimension is silent. Of rows with one bot and time the greatest type counts.

    Both sides are sorted together by time and the last type met is carried on. A bot's time is cut in slices, into each of which
    every row is put that is valid there, so a hot bot is as many tasks' work as it has slices.
    """
    own = requests.columns
    low, high = requests.agg(F.min("at"), F.max("at")).first()
    if low is None:
        return requests.withColumn("type", F.lit(None).cast("string"))

    def slice_of(moment: Column) -> Column:
        return F.floor(F.unix_timestamp(moment) / slice_seconds)

    rows = dimension.where(F.col("bot_name").isNotNull() & F.col("valid_from").isNotNull())
    rows = rows.groupBy("bot_name", F.col("valid_from").cast("timestamp").alias("moment")).agg(F.max("type").alias("type"))
    until = F.lead("moment").over(Window.partitionBy("bot_name").orderBy("moment"))  # a bot's changes of type are few
    rows = rows.withColumn("until", until).where((F.col("moment") <= F.lit(high)) & (F.col("until").isNull() | (F.col("until") > F.lit(low))))
    first = slice_of(F.greatest(F.col("moment"), F.lit(low)))
    last = slice_of(F.least(F.coalesce("until", F.lit(high)), F.lit(high)))
    rows = rows.select("bot_name", "moment", "type", F.explode(F.sequence(first, last)).alias("slice"))
    mixed = rows.select("bot_name", "slice", "moment", F.lit(0).alias("place"), "type", F.lit(None).cast(requests.select(F.struct(*own)).schema[0].dataType).alias("row"))
    asked = requests.select("bot_name", slice_of(F.col("at")).alias("slice"), F.col("at").alias("moment"), F.lit(1).alias("place"), F.lit(None).cast("string").alias("type"), F.struct(*own).alias("row"))
    order = Window.partitionBy("bot_name", "slice").orderBy("moment", "place")
    met = mixed.unionByName(asked).withColumn("then", F.last("type", ignorenulls=True).over(order)).where("place = 1")
    return met.select("row.*", F.col("then").alias("type"))


# --- retention ------------------------------------------------------------------------------------


def retention(visits: DataFrame, upto: int = UPTO) -> DataFrame:
    """(bot_name, first_day, n, users, cohort): how many of the users who first came on a day came on the n-th day after; days
    without any are there as zero, up to the last day that there is.

    ``visits`` holds each (bot, day, user) once. A user's days meet in one exchange; the matrix is small.
    """
    first = F.min("day").over(Window.partitionBy(*USER))
    days = visits.select(*USER, "day", first.alias("first_day"))
    counts = days.groupBy("bot_name", "first_day", F.date_diff("day", "first_day").alias("n")).agg(F.count(F.lit(1)).alias("users"))
    last = F.max("day").alias("last")
    cohorts = days.where(F.col("day") == F.col("first_day")).groupBy("bot_name", "first_day").agg(F.count(F.lit(1)).alias("cohort"))
    end = F.lit(visits.agg(last).first()[0]).cast("date")
    steps = F.explode(F.sequence(F.lit(0), F.least(F.lit(upto), F.date_diff(end, F.col("first_day"))))).alias("n")
    matrix = cohorts.select("*", steps).join(counts, ["bot_name", "first_day", "n"], "left")
    return matrix.select("bot_name", "first_day", "n", F.coalesce("users", F.lit(0)).alias("users"), "cohort")


def returns(visits: DataFrame) -> DataFrame:
    """(bot_name, day, returning, mean_days): users of a day who had come before, and the mean days since they last had."""
    before = F.lag("day").over(Window.partitionBy(*USER).orderBy("day"))
    gaps = visits.select("bot_name", "day", F.date_diff(F.col("day"), before).alias("gap")).where(F.col("gap").isNotNull())
    return gaps.groupBy("bot_name", "day").agg(F.count(F.lit(1)).alias("returning"), F.avg("gap").alias("mean_days"))


# --- sketches -------------------------------------------------------------------------------------


def user_sketches(requests: DataFrame) -> DataFrame:
    """(bot_name, day, sketch) of the distinct users; a few kilobytes whatever their number."""
    return requests.groupBy("bot_name", "day").agg(F.hll_sketch_agg("user_id", LG_CONFIG).alias("sketch"))


def merged_users(sketches: DataFrame) -> DataFrame:
    return sketches.groupBy("bot_name", "day").agg(F.hll_union_agg("sketch").alias("sketch"))


def sketched_uv(sketches: DataFrame, *keys: str) -> DataFrame:
    """UV of each key over all days in ``sketches``, within ``UV_ERROR`` of the exact figure."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("uv"))


def load_sketches(qps: DataFrame) -> DataFrame:
    """(bot_name, day, sketch) of the requests per second of a day's seconds with any."""
    return qps.groupBy("bot_name", "day").agg(F.kll_sketch_agg_bigint("requests", F.lit(K)).alias("sketch"))


def merged_loads(sketches: DataFrame) -> DataFrame:
    return sketches.groupBy("bot_name", "day").agg(F.kll_merge_agg_bigint("sketch", F.lit(K)).alias("sketch"))


def sketched_loads(sketches: DataFrame, shares: tuple[float, ...], *keys: str) -> DataFrame:
    """Requests per second that so large a share of the seconds stay within, over all days in ``sketches``; the rank of each
    is within ``RANK_ERROR`` of its share."""
    one = sketches.groupBy(*keys).agg(F.kll_merge_agg_bigint("sketch", F.lit(K)).alias("sketch"))
    loads = [F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(s))).alias(f"p{round(100 * s)}") for s in shares]
    return one.select(*keys, F.kll_sketch_get_n_bigint("sketch").alias("seconds"), *loads)
