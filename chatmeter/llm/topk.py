"""Exact top-k search over binary codes by incremental multi-index hashing.

A code holds the signs of all components, in as many 64-bit words as the longest vector needs; a component that a shorter
vector lacks counts as one that is not over 0. Codes are cut into segments of about log2(rows) bits, and each row's code is listed under each of its
segment values. Rows with the same code are kept as their smallest ids, 2k rows and at most k of one id, as no others can be among
k results when a query's own id is left out. A query looks up, segment by segment, the values at Hamming distance r from its own, for r = 0, 1, ...
When all segments are searched to radius r, every code nearer than segments * (r + 1) has been
met. A query ends as soon as its k-th verified distance is under that; the others search on.

The index of a segment is cut into cells by the leading bits of its values; a query goes to the cells whose
bits are within the radius, and looks up the rest of its ball there. So a ball is enumerated in the tasks that
hold the rows, and only the best candidates of a query leave a cell. Equal query codes are
searched once. Ties go to the smaller id, and a query's own row is no result of it.

Edge cases: vectors that are null, empty or hold null components have no code: they are neither found nor
answered; rows without id are left out; with fewer than k other rows all are returned; of rows that
repeat an id each counts (k at most can be results), but for the query's own id; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatmeter.llm.tables import saved

WORD = 64  # bits of a word of a code
CELL = 8192  # rows of a cell of the index, about


def sign_code(vector: Column, words: int = 1) -> Column:
    """The signs of the components as bits of ``words`` longs: 1 where a component is over 0."""

    def word(k: int) -> Column:
        part = F.slice(vector, WORD * k + 1, WORD)
        zero = F.lit(0).cast("long")
        bits = F.transform(part, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(zero))
        return F.aggregate(bits, zero, lambda a, x: a.bitwiseOR(x))

    return F.array(*[word(k) for k in range(words)])


def _segments(rows: int, words: int = 1) -> list[tuple[int, int, int]]:
    """(word, offset, width) of each segment; none reaches over words."""
    number = max(2, min(8, round(WORD / max(8.0, math.log2(max(2, rows))))))
    widths = [WORD // number + (i < WORD % number) for i in range(number)]
    return [(k, sum(widths[:i]), w) for k in range(words) for i, w in enumerate(widths)]


def _value(code: Column, word: int, offset: int, width: int) -> Column:
    return F.shiftrightunsigned(F.get(code, F.lit(word)), offset).bitwiseAND(F.lit((1 << width) - 1))


def _best(rows: DataFrame, k: int) -> DataFrame:
    """The nearest 2k rows of each query code, k of an id at most; a row that was met several times counts once."""
    of_id = Window.partitionBy("q", "id").orderBy("distance", "copy")
    order = Window.partitionBy("q").orderBy("distance", "id", "copy")
    some = rows.distinct().withColumn("_n", F.row_number().over(of_id)).where(F.col("_n") <= k)
    return some.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= 2 * k).drop("_n")


def _fewest(codes: DataFrame, k: int) -> DataFrame:
    """Of rows with the same code those of the smallest ids, k of an id and 2k in all; hot codes are cut in salted parts first."""
    of_id = Window.partitionBy("code", "id").orderBy("copy")
    part = Window.partitionBy("code", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id", "copy")
    all_ = Window.partitionBy("code").orderBy("id", "copy")
    some = codes
    for window, most in ((of_id, k), (part, 2 * k), (all_, 2 * k)):
        some = some.withColumn("_n", F.row_number().over(window)).where(F.col("_n") <= most).drop("_n")
    return some


def _patterns(width: int, radius: int) -> np.ndarray:
    """All numbers of ``width`` bits of which ``radius`` are set."""
    return np.array([sum(1 << i for i in picked) for picked in combinations(range(width), radius)], np.int64)


def _asked(parts: list, prefix: int, radius: int):
    """Sends a query code, for each segment, to all prefixes within the radius, with the radius left for the rest."""
    near = [(x, bin(x).count("1")) for x in range(1 << prefix)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("q")
            q = codes.flatten().to_numpy().reshape(len(codes), -1).view(np.uint64)
            for n, (word, offset, width) in parts:
                value = (q[:, word] >> np.uint64(offset) & np.uint64((1 << width) - 1)).astype(np.int64)
                for x, used in near:
                    if used <= radius and radius - used <= width - prefix:
                        cell = (value >> (width - prefix) ^ x) + (n << 40)
                        rest = value & ((1 << (width - prefix)) - 1)
                        left = np.full(len(q), radius - used, np.int32)
                        yield pa.record_batch([pa.array(cell), codes, pa.array(rest), pa.array(left)], ["cell", "q", "rest", "left"])

    return run


def _probe(widths: dict[int, int], k: int):
    """Looks the ball around each query up in one cell of the index, verifies, and keeps the best."""

    def run(index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(index) and len(asked):
            index = index.sort_values("rest", kind="stable")
            rest, code = index["rest"].to_numpy(), np.stack(index["code"].to_list()).astype(np.int64).view(np.uint64)
            ids, copies = index["id"].to_numpy(), index["copy"].to_numpy()
            width, balls = widths[int(index["cell"].iloc[0]) >> 40], {}
            for q, own, left in asked[["q", "rest", "left"]].itertuples(index=False):
                if math.comb(width, left) > len(rest):  # fewer rows than patterns: look at the rows
                    at = np.flatnonzero(np.bitwise_count(rest ^ own) == left)
                else:
                    if left not in balls:
                        balls[left] = _patterns(width, left)
                    keys = balls[left] ^ own
                    first, last = np.searchsorted(rest, keys, "left"), np.searchsorted(rest, keys, "right")
                    n = last - first
                    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
                if not len(at):
                    continue
                distance = np.bitwise_count(code[at] ^ np.asarray(q, np.int64).view(np.uint64)).sum(axis=1).astype(np.int32)
                best = np.lexsort((copies[at], ids[at], distance))
                if len(best) > 2 * k:
                    # Rows of one id come in order of distance, so the first k of it are kept.
                    by_id = best[np.argsort(ids[at][best], kind="stable")]
                    new = np.flatnonzero(np.diff(ids[at][by_id], prepend=ids[at][by_id][0] - 1))
                    place = np.empty(len(at), np.int64)
                    place[by_id] = np.arange(len(at)) - np.repeat(new, np.diff(np.append(new, len(at))))
                    best = best[place[best] < k][: 2 * k]
                found = {"q": [q] * len(best), "id": ids[at][best], "copy": copies[at][best], "distance": distance[best]}
                out.append(pd.DataFrame(found))
        return pd.concat(out) if out else pd.DataFrame({"q": pd.Series([], dtype=object), "id": [], "copy": [], "distance": []})

    return run


def search(
    vectors: DataFrame, queries: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", cell: int = CELL
) -> DataFrame:
    """(vec_id, rank, neighbor_id, distance) of the rows for which ``queries`` is true."""
    v = F.col(vector).cast("array<double>")
    fine = F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull()), F.lit(False)) & F.col(vec_id).isNotNull()
    rows = vectors.where(fine).select(F.col(vec_id).cast("long").alias("id"), v.alias("v"), queries.alias("asks"))
    words = -(-(rows.agg(F.max(F.size("v"))).first()[0] or 1) // WORD)
    # Rows are numbered once, as the table is written.
    codes = rows.select("id", sign_code(F.col("v"), words).alias("code"), "asks", F.monotonically_increasing_id().alias("copy"))
    codes = saved(codes, "codes")
    # Rows of the query's own id, of which k at most are kept, are among what is found, and dropped in the end.
    need = 2 * k
    table = saved(_fewest(codes.select("id", "code", "copy"), k), "table")
    number = table.count()
    parts = list(enumerate(_segments(number, words)))
    prefix = min(12, max(0, (number // cell).bit_length()))  # bits of a segment that name a cell of the index
    places = [
        F.struct(
            (F.shiftright(_value(F.col("code"), m, o, w), w - prefix) + F.lit(n << 40)).alias("cell"),
            _value(F.col("code"), m, o, w).bitwiseAND(F.lit((1 << (w - prefix)) - 1)).alias("rest"),
        )
        for n, (m, o, w) in parts
    ]
    index = saved(table.select("id", "code", "copy", F.inline(F.array(*places))), "index")
    # Cells of many rows are cut into parts, to each of which their queries go.
    sizes = saved(index.groupBy("cell").agg(F.ceil(F.count("*") / (8 * cell)).cast("int").alias("parts")).where("parts > 1"), "sizes")
    split = F.coalesce("parts", F.lit(1))
    index = saved(index.join(sizes, "cell", "left").withColumn("part", F.pmod(F.xxhash64("id"), split).cast("int")).drop("parts"), "index")
    open_ = saved(codes.where("asks").select(F.col("code").alias("q")).distinct(), "open")
    held, done, radius = None, [], 0
    probe = _probe({n: w - prefix for n, (_, _, w) in parts}, k)
    while not open_.isEmpty():
        asked = open_.mapInArrow(_asked(parts, prefix, radius), "cell long, q array<long>, rest long, left int")
        asked = asked.join(sizes, "cell", "left").withColumn("part", F.explode(F.sequence(F.lit(0), split - 1))).drop("parts")
        met = index.groupBy("cell", "part").cogroup(asked.groupBy("cell", "part")).applyInPandas(probe, "q array<long>, id long, copy long, distance int")
        held = met if held is None else held.unionByName(met)
        covered = len(parts) * (radius + 1) - 1  # all codes up to this distance have been met
        held = saved(_best(held, k), "held")
        state = held.groupBy("q").agg(F.count("*").alias("n"), F.max("distance").alias("far"))
        ready = (F.coalesce("n", F.lit(0)) >= need) & (F.col("far") <= covered) | F.lit(covered >= WORD * words)
        state = saved(open_.join(state, "q", "left").select("q", F.coalesce(ready, F.lit(False)).alias("ready")), "state")
        done.append(held.join(state.where("ready"), "q", "left_semi"))
        open_ = state.where(~F.col("ready")).select("q")
        held = held.join(open_, "q", "left_semi")
        radius += 1
    asking = codes.where("asks").select(F.col("id").alias("vec_id"), F.col("code").alias("q")).distinct()
    if not done:
        return asking.select("vec_id", F.lit(0).alias("rank"), F.col("vec_id").alias("neighbor_id"), F.lit(0).alias("distance"))
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    order = Window.partitionBy("vec_id").orderBy("distance", "id", "copy")
    out = asking.join(found, "q").where(F.col("id") != F.col("vec_id")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return out.select("vec_id", "rank", F.col("id").alias("neighbor_id"), "distance")
