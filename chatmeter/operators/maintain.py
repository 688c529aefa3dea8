"""What corrections of the KPI tables are about; ``plans.jobs`` carries them out on a store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bots_of_type(dim_bot: DataFrame, bot_type: str) -> DataFrame:
    """Bot names of one type; on a database the predicate runs in the database."""
    return dim_bot.where(F.col("type") == bot_type).select("bot_name").distinct()


def users_to_roll_back(new_users: DataFrame, day: str, bots: DataFrame | None = None) -> DataFrame:
    """New users of the day, of all bots or of the given ones.

    Of a published table one day's folder is read. ``bots`` comes from the dimension table; the planner
    broadcasts it when the table's size allows and else sorts both sides, where adaptive
    execution splits a hot bot.
    """
    removed = new_users.where(F.col("day") == F.lit(day).cast("date"))
    if bots is not None:
        removed = removed.join(bots, "bot_name", "left_semi")
    return removed.select("bot_name", "day", "user_id")
