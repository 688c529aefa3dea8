"""Shards of near equal bytes by histogram sort.

Rows are ordered by a hash of their text, so equal texts lie together, and then by doc_id. A splitter is
found without sorting: each round counts the bytes below evenly spaced probe keys, in the intervals
that still hold a splitter, and goes on in the part where the target lies. A round is one grouping
that is reduced before the exchange and gives the driver ``2 ** BITS`` numbers a splitter at most.
A splitter between two texts is taken as soon as it meets the tolerance; only a group of equal texts
larger than that is split, by the same search over its doc_ids. Then each row's shard follows from
comparisons, and rows are exchanged once, for their places within the shards.

All steps are DataFrame expressions. Edge cases: a null text has one byte of size and the hash of an
empty one; a null doc_id comes first; rows equal in text and doc_id cannot be told apart and stay
together; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatmeter.llm.tables import saved, spread

BITS = 10  # of the key, that a round of probes tells apart
FLIP = -(1 << 63)  # makes signed order the order of unsigned keys


def _prefix(key: Column, bits: int) -> Column:
    """The leading bits of a key of 64, as an unsigned number."""
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def _search(rows: DataFrame, targets: dict[int, int], slack: float, key: str, below: int = 0) -> dict[int, tuple[int, int, bool]]:
    """For each splitter its key, as an unsigned number that rows of its right side reach, the bytes
    before it, and whether these are within ``slack`` of the target; else it is the start of the one
    key that holds the target. ``rows`` has ``key`` (signed, in unsigned order when shifted) and size."""
    found: dict[int, tuple[int, int, bool]] = {}
    inside = {i: (0, below) for i in targets}  # the prefix where a splitter lies, and the bytes before it
    bits = 0
    while inside:
        deeper = min(64, bits + BITS)
        prefix = _prefix(F.col(key), bits)
        some = rows.where(prefix.isin(sorted({p for p, _ in inside.values()}))) if bits else rows
        counted: dict[int, list[tuple[int, int]]] = {}
        for probe, size in some.groupBy(_prefix(F.col(key), deeper).alias("probe")).agg(F.sum("size")).collect():
            probe &= (1 << 64) - 1
            counted.setdefault(probe >> (deeper - bits), []).append((probe, size))
        going = {}
        for i, (p, before) in inside.items():
            for probe, size in sorted(counted.get(p, [])):
                if before + size > targets[i]:
                    break
                before += size
            else:  # all lies below the target
                found[i] = ((p + 1) << (64 - bits) if bits else 1 << 64, before, True)
                continue
            ends = [(probe << (64 - deeper), before), ((probe + 1) << (64 - deeper), before + size)]
            at, total = min(ends, key=lambda e: abs(e[1] - targets[i]))
            if abs(total - targets[i]) <= slack:
                found[i] = (at, total, True)
            elif deeper == 64:
                found[i] = (at, total, False) if key == "k2" else (*ends[0], False)
            else:
                going[i] = (probe, before)
        inside, bits = going, deeper
    return found


def splitters(keys: DataFrame, shards: int, tolerance: float = 0.001) -> list[tuple[int, int]]:
    """(k1, k2) for each boundary, unsigned: rows at or above it are right of it."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    targets = {i: total * i // shards for i in range(1, shards)}
    slack = tolerance * total / shards
    found = _search(keys, targets, slack, "k1") if total else {}
    out = {i: (at, 0) for i, (at, _, good) in found.items() if good}
    groups: dict[int, list[int]] = {}
    for i, (at, _, good) in found.items():
        if not good:
            groups.setdefault(at, []).append(i)
    for at, members in groups.items():  # one large group of equal texts each, fewer than shards
        one = keys.where(F.col("k1") == F.lit(at - (1 << 64) if at >> 63 else at))
        inner = _search(one, {i: targets[i] for i in members}, slack, "k2", found[members[0]][1])
        # Equal rows cannot be told apart: the boundary is before or after them, whichever is nearer.
        out |= {i: (at, k2) if k2 < 1 << 64 else (at + 1, 0) for i, (k2, _, _) in inner.items()}
    return sorted(out.values())


def _signed(key: int) -> int:
    """An unsigned key in an order that comparisons of signed numbers follow."""
    return min(key, (1 << 64) - 1) + FLIP


def _shard(bounds: list[tuple[int, int]], first: int = 0) -> Column:
    """The number of boundaries at or below a row's key, by halving the list."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    a, b = bounds[middle]
    k1, k2 = F.col("k1").bitwiseXOR(F.lit(FLIP)), F.col("k2").bitwiseXOR(F.lit(FLIP))
    if a >= 1 << 64:
        return _shard(bounds[:middle], first)
    right = (k1 > _signed(a)) | ((k1 == _signed(a)) & (k2 >= _signed(b)))
    return F.when(right, _shard(bounds[middle + 1 :], first + middle + 1)).otherwise(_shard(bounds[:middle], first))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, k1, k2) of every row."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("k1"),
        F.coalesce(docs["doc_id"].cast("long").bitwiseXOR(F.lit(FLIP)), F.lit(0)).alias("k2"),
    )


def slots(rows: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """``rows`` with ``slot``, gapless from 0 in each shard. Rows are numbered in hash buckets of bounded
    size, each from where the buckets before it end, so no shard is sorted in one task."""
    total = rows.count()
    rows = spread(rows, "doc_id", total)
    sizes = rows.groupBy(shard, "_bucket").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(shard).orderBy("_bucket")) - F.col("_n")
    sizes = saved(sizes.select(shard, "_bucket", before.alias("_before")), "slots")
    place = F.row_number().over(Window.partitionBy(shard, "_bucket").orderBy(*order)) - 1
    return rows.join(sizes, [shard, "_bucket"]).withColumn("slot", F.col("_before") + place).drop("_bucket", "_before")


def shards(docs: DataFrame, number: int = 8, tolerance: float = 0.001) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): shards of near equal bytes, equal texts together."""
    keys = saved(keyed(docs), "keys")
    bounds = splitters(keys, number, tolerance)
    rows = keys.withColumn("shard", _shard(bounds).cast("int"))
    return slots(rows, "shard", ["k1", "k2", "size"]).select("doc_id", "size", "text_crc32", "shard", "slot")


def write(docs: DataFrame, path: str, number: int = 8, tolerance: float = 0.001) -> None:
    """The rows of ``docs``, whole, in one folder for each shard; rows go out of the scan as they are."""
    bounds = splitters(saved(keyed(docs), "keys"), number, tolerance)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.withColumns({"k1": F.xxhash64(text), "k2": F.coalesce(F.col("doc_id").cast("long").bitwiseXOR(F.lit(FLIP)), F.lit(0))})
    rows.withColumn("shard", _shard(bounds).cast("int")).drop("k1", "k2").hint("rebalance", "shard").write.partitionBy("shard").parquet(path)

