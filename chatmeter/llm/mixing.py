"""Temperature mixing of sources, realised as budgeted permutations of blocks.

Source token shares are raised to an exponent between 0 (all alike) and 1 (as they are), which is bisected
on a fixed grid: the largest exponent that still has the wished entropy, or the smallest one at
which no source is read more often than a limit. A round of bisection weighs many candidates at once in one
small grouping over the sources.

Documents fall by hash into at most ``BLOCKS`` blocks a source, so the schedule has a bounded number of rows a
source however large the source is. In each pass over a source its blocks come in another random order. A
source's share of the token budget gives it whole passes and then the first blocks of one more, to
within half a block. A block's place in the mix is how far its source is through its budget, so
every stretch of the order holds the sources by their weights.

All steps are DataFrame expressions. Edge cases: a null source is a source of its own; a null text has
no tokens; a null doc_id has a block like any other; repeated rows are scheduled alike; sources without
tokens are read once; an empty table gives an empty table; other columns are carried along.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatmeter.llm.tables import saved

BLOCKS = 1024
GRID = 1 << 16  # exponents are multiples of 1 / GRID
PROBES = 16  # intervals that a round of bisection tells apart
SMALL = 200_000  # rows of a schedule that may be broadcast


def tokens_by_bytes(text: Column) -> Column:
    """A document's tokens, taken as a quarter of its UTF-8 bytes, rounded up."""
    return F.floor((F.octet_length(F.coalesce(text.cast("string"), F.lit(""))) + 3) / 4).cast("long")


def _hashed(*parts: Column | str) -> Column:
    """32 even bits of what is given, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 8), 16, 10).cast("long")


@dataclass
class Target:
    """What the exponent is chosen by: ``entropy``, as a share of the largest possible one, or
    ``repeats``, the most passes over a source. ``budget`` in tokens; None: as few as read all once."""

    entropy: float | None = None
    repeats: float | None = None
    budget: int | None = None
    seed: str = "mix"


def _keyed(docs: DataFrame, seed: str) -> DataFrame:
    return docs.withColumns(
        {
            "_source": F.coalesce(F.concat(F.lit("="), docs["source"].cast("string")), F.lit("null")),
            "_block": _hashed(F.lit(seed), F.coalesce(docs["doc_id"].cast("string"), F.lit("null"))) % BLOCKS,
            "_tokens": tokens_by_bytes(docs["text"]),
        }
    )


def exponent(sources: DataFrame, total: int, number: int, target: Target) -> tuple[float, float, float]:
    """(exponent, sum of the powers, budget) for ``sources`` with their share ``p``."""

    def measured(grid: list[int]) -> dict[int, tuple]:
        a = F.col("k") / F.lit(GRID)
        power = F.pow("p", a)
        probes = sources.select("p", F.explode(F.array(*[F.lit(k) for k in grid])).alias("k"))
        rows = probes.groupBy("k").agg(F.sum(power), F.sum(power * F.log("p")), F.max(power / F.col("p")), F.min(power / F.col("p"))).collect()
        return {r[0]: r[1:] for r in rows}

    def good(k: int, z: float, zl: float, most: float, least: float) -> bool:
        """True below the exponent that is sought (entropy), or from it on (repeats)."""
        if target.entropy is not None:
            return math.log(z) - k / GRID * zl / z >= target.entropy * math.log(number)
        return (most / least if target.budget is None else most / z * target.budget / total) <= target.repeats

    low, high = 0, GRID  # good(low) and not good(high), or the other way round, unless an end is the answer
    wanted = target.entropy is not None
    ends = measured([low, high])
    if good(high, *ends[high]) == wanted or not wanted and not good(high, *ends[high]):
        low = high
    elif good(low, *ends[low]) != wanted:
        high = low
    while high - low > 1:
        grid = sorted({low + (high - low) * i // PROBES for i in range(1, PROBES)} - {low})
        seen = measured(grid)
        for k in grid:
            if good(k, *seen[k]) == wanted:
                low = k
            else:
                high = k
                break
    k = low if wanted else high
    z, _, _, least = measured([k])[k]
    budget = target.budget if target.budget is not None else total * z / least
    return k / GRID, z, budget


def schedule(docs: DataFrame, target: Target) -> DataFrame:
    """(_source, _block, _epoch, _place) of every reading of a block."""
    docs = docs.select("doc_id", "source", "text")
    blocks = saved(_keyed(docs, target.seed).groupBy("_source", "_block").agg(F.sum("_tokens").alias("n")), "blocks")
    sources = saved(blocks.groupBy("_source").agg(F.sum("n").alias("all")), "sources")
    total, number = sources.where("all > 0").agg(F.sum("all"), F.count("*")).first()
    if not total:
        return blocks.select("_source", "_block", F.lit(0).alias("_epoch"), F.lit(0.0).alias("_place"))
    shares = sources.where("all > 0").withColumn("p", F.col("all") / F.lit(total))
    a, z, budget = exponent(shares, total, max(2, number), target)
    passes = F.when(F.col("all") > 0, F.pow(F.col("all") / F.lit(total), F.lit(a)) / F.lit(z) * F.lit(float(budget)) / F.col("all")).otherwise(1.0)
    # Rounding must not take the last block of a source that is to be read a whole number of times.
    wanted = sources.select("_source", "all", F.round(passes, 9).alias("passes"))
    turns = blocks.join(wanted, "_source").withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.floor("passes").cast("int"))))
    order = Window.partitionBy("_source", "_epoch").orderBy("_turn", "_block")
    turns = turns.withColumn("_turn", _hashed(F.lit(target.seed), F.col("_epoch"), "_source", "_block"))
    turns = turns.withColumn("_before", F.sum("n").over(order) - F.col("n"))
    part = F.floor((F.col("passes") - F.floor("passes")) * F.col("all"))
    whole = F.col("_epoch") < F.floor("passes")
    kept = turns.where(whole | ((part > 0) & (2 * F.col("_before") + F.col("n") <= 2 * part)))
    place = F.when(F.col("all") > 0, (F.col("_epoch") + F.col("_before") / F.col("all")) / F.col("passes")).otherwise(0.0)
    return kept.select("_source", "_block", "_epoch", place.alias("_place"))


def mixed(docs: DataFrame, target: Target) -> DataFrame:
    """The columns of ``docs`` followed by ``mix_epoch`` and ``mix_place``: a row for each reading of a document."""
    plan = saved(schedule(docs, target), "schedule")
    if plan.count() <= SMALL:  # sources times blocks times passes; checked, as sources may be many
        plan = F.broadcast(plan)
    # A row travels as one struct, so no name in it can clash.
    rows = _keyed(docs.select(F.struct("*").alias("_row"), "doc_id", "source", "text"), target.seed).drop("text")
    return rows.join(plan, ["_source", "_block"]).select("_row.*", F.col("_epoch").alias("mix_epoch"), F.col("_place").alias("mix_place"))


def counted(docs: DataFrame, target: Target) -> DataFrame:
    """(doc_id, source, tokens, block, copies): how often the mix reads each document, 0 included."""
    plan = saved(schedule(docs, target).groupBy("_source", "_block").agg(F.count("*").alias("copies")), "copies")
    rows = _keyed(docs.select("doc_id", "source", "text"), target.seed)
    rows = rows.select("doc_id", "source", F.col("_tokens").alias("tokens"), "_source", "_block")
    if plan.count() <= SMALL:
        plan = F.broadcast(plan)
    rows = rows.join(plan, ["_source", "_block"], "left")
    return rows.select("doc_id", "source", "tokens", F.col("_block").alias("block"), F.coalesce("copies", F.lit(0)).cast("long").alias("copies"))
