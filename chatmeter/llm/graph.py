"""Connected components of a link table, by alternating star contractions.

Each round replaces a node's links by links to the smallest node in reach. What a round gives is
written to the shared scratch folder, so the plan stays short and survives lost executors. All steps
are joins and reduced groupings on a node; no component is ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatmeter.llm.tables import saved


def _large_star(links: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node that it sees."""
    both = links.unionByName(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    return (
        links.join(least, links.low == least.node)  # only neighbours above the node matter
        .select(F.col("high"), F.col("least").alias("low"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of these."""
    least = links.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))
    own = least.select(F.col("node").alias("high"), F.col("least").alias("low"))
    moved = links.join(least, links.high == least.node).select(F.col("low").alias("high"), F.col("least").alias("low"))
    return own.unionByName(moved.where(F.col("high") != F.col("low")))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has a link: root is the smallest node in reach.

    Self-links, repeated links and either direction are fine; nulls are ignored. No links give an
    empty table.
    """
    now = (
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
        .distinct()
    )
    now, before = saved(now, "links"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.hash("high", "low").cast("long")), F.sum(F.xxhash64("high", "low") % 1_000_003)).first()
        if state == before or state[0] == 0:
            return now.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
                now.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
            )
        before = state
        # The neighbours of a hub mostly see the same smallest node: told apart by both ends, they leave the hub few rows.
        now = saved(_small_star(_large_star(now).distinct()).distinct(), "links")
