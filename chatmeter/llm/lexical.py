"""Ranked lexical search of all documents for each of a set of items, by dual-tree search.

A document is a vector over terms: the coordinate of a term is what one occurrence weight of it is worth there, (10^9 tf) div
(1000 tf + 20 m), where m grows with the document's length. An item is a vector of its terms' weights, and a score is
the product of both. Two hierarchies hold coordinate maxima: nodes of items (the weight of each term that any
item below has) and nodes of documents (the highest coordinate of each term below). The product of two nodes bounds every
score between them. A pair of nodes is left out when its bound is below the weakest k-th score among the items of the
node, so a whole batch of items skips a whole batch of documents; else both are opened. Bounds are integers and
nothing else is left out, so the ranking is exact, ties included.

Documents are read once: each is cut into terms, and the terms that any item has are kept with their counts. Weights
need the numbers of documents and terms of the whole corpus, which Spark counts. A search over one in ``SEED`` documents
gives each item a first k-th score; it can only lie below the true one, so it prunes but drops nothing. Then every
task searches its documents, batch by batch, and hands on at most k rows for an item; Spark ranks these.

Items are searched in blocks of about ``BLOCK`` bytes of text, which bounds the terms that tasks are sent.

Edge cases: a null text has no terms; documents without terms are not counted and never found; items without terms
give no rows. Each row of the documents is ranked, repeated or not; rows of one item_id and text are one item. A null
doc_id comes last among equal scores. Other columns are ignored; empty tables give an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatmeter.llm.tables import saved, slices

BLOCK = 8 << 20  # bytes of items' text that are searched together
SEED = 32  # one document in so many gives the first k-th scores
POSTINGS = 1 << 20  # terms of documents under one hierarchy, one document at least
DOC_FAN, ITEM_FAN = 16, 8  # children of a node
STEP = 16  # nodes opened together, those of highest bounds first
MATCHED = "doc_id long, n long, terms array<int>, counts array<int>"
NO_ID = np.iinfo(np.int64).max

# Digits, letters and all bytes from 0x80 on belong to terms; only A-Z are lower-cased.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


# --- hierarchies ----------------------------------------------------------------------------------


@dataclass
class Level:
    """Sparse rows: row i has ``terms[first[i]:first[i + 1]]`` with ``values`` beside them."""

    first: np.ndarray
    terms: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    def products(self, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The product of each row with a dense vector."""
        size = self.first[rows + 1] - self.first[rows]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[rows] - (ends - size), size)
        sums = np.concatenate(([0], np.cumsum(weights[self.terms[at]] * self.values[at])))
        return sums[ends] - sums[ends - size]


def _level(rows: np.ndarray, terms: np.ndarray, values: np.ndarray, number: int) -> Level:
    """The highest value of each (row, term); ``number`` rows."""
    order = np.lexsort((terms, rows))
    rows, terms, values = rows[order], terms[order], values[order]
    starts = np.flatnonzero(np.concatenate(([True], (rows[1:] != rows[:-1]) | (terms[1:] != terms[:-1])))) if len(rows) else np.zeros(0, int)
    highest = np.maximum.reduceat(values, starts) if len(starts) else values
    return Level(np.searchsorted(rows[starts], np.arange(number + 1)), terms[starts], highest)


def hierarchy(leaf: Level, fan: int) -> list[Level]:
    """Levels from the leaves up to one root; node i has the nodes ``i * fan`` to ``i * fan + fan - 1`` below it."""
    levels = [leaf]
    while len(levels[-1]) > 1:
        below = levels[-1]
        rows = np.repeat(np.arange(len(below)) // fan, np.diff(below.first))
        levels.append(_level(rows, below.terms, below.values, -(-len(below) // fan)))
    return levels


def _children(nodes: np.ndarray, fan: int, number: int) -> np.ndarray:
    below = (nodes[:, None] * fan + np.arange(fan)).ravel()
    return below[below < number]


def _alike(level: Level, marks: np.ndarray) -> np.ndarray:
    """An order of the rows that brings those with the same outstanding terms together: by the terms of highest mark."""
    rows = np.repeat(np.arange(len(level)), np.diff(level.first))
    order = np.lexsort((-marks, rows))
    ordered, size = level.terms[order], np.diff(level.first)
    keys = []
    for place in range(3):
        at = np.minimum(level.first[:-1] + place, level.first[1:] - 1)
        keys.append(np.where(size > place, ordered[np.maximum(at, 0)] if len(ordered) else 0, -1))
    return np.lexsort(keys[::-1])


def _picked(level: Level, order: np.ndarray) -> Level:
    size = np.diff(level.first)[order]
    first = np.concatenate(([0], np.cumsum(size)))
    at = np.arange(first[-1]) + np.repeat(level.first[:-1][order] - first[:-1], size)
    return Level(first, level.terms[at], level.values[at])


# --- search ---------------------------------------------------------------------------------------


class Search:
    """The items of a block and the k best documents that each has met so far."""

    def __init__(self, items: list[list[int]], weights: np.ndarray, k: int, floors: np.ndarray | None = None):
        rows = np.repeat(np.arange(len(items)), list(map(len, items)))
        terms = np.array([t for own in items for t in own], np.int64)
        leaf = _level(rows, terms, weights[terms], len(items))
        # Frequent terms bring items of one language together, whose bounds meet the same documents.
        self.number = _alike(leaf, -leaf.values)  # of the item at each leaf
        self.levels = hierarchy(_picked(leaf, self.number), ITEM_FAN)
        self.k, self.weights = k, weights
        self.scratch = np.zeros(len(weights), np.int64)
        self.floors = np.zeros(len(items), np.int64) if floors is None else floors[self.number]
        nothing = np.zeros(0, np.int64)
        self.best = [(nothing, nothing)] * len(items)  # scores and doc_ids by leaf

    def _floor(self, level: int, node: int) -> int:
        span = ITEM_FAN**level
        return self.floors[node * span : (node + 1) * span].min()

    def add(self, doc_ids: np.ndarray, docs: Level) -> None:
        """Lets the items meet a batch of documents, whose rows hold coordinates."""
        order = _alike(docs, self.weights[docs.terms] * docs.values)
        self.doc_ids, self.docs = doc_ids[order], hierarchy(_picked(docs, order), DOC_FAN)
        if len(docs) and self.best:
            self._visit(len(self.levels) - 1, 0, len(self.docs) - 1, np.zeros(1, np.int64))

    def _visit(self, item_level: int, item: int, doc_level: int, docs: np.ndarray) -> None:
        own = self.levels[item_level]
        at = slice(own.first[item], own.first[item + 1])
        self.scratch[own.terms[at]] = own.values[at]
        bounds = self.docs[doc_level].products(docs, self.scratch)
        self.scratch[own.terms[at]] = 0
        if item_level == doc_level == 0:
            self._meet(item, docs, bounds)
            return
        order = np.argsort(-bounds, kind="stable")
        docs, bounds = docs[order], bounds[order]
        while True:
            # The floor rises while the nodes of higher bounds are searched.
            left = np.searchsorted(-bounds, -max(1, self._floor(item_level, item)), "right")
            if not left:
                return
            some, docs, bounds = docs[: min(left, STEP)], docs[min(left, STEP) : left], bounds[min(left, STEP) : left]
            if doc_level:
                some = _children(some, DOC_FAN, len(self.docs[doc_level - 1]))
            if item_level:
                for below in range(item * ITEM_FAN, min((item + 1) * ITEM_FAN, len(self.levels[item_level - 1]))):
                    self._visit(item_level - 1, below, max(doc_level - 1, 0), some)
            else:
                self._visit(0, item, doc_level - 1, some)

    def _meet(self, item: int, docs: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= max(1, self.floors[item])
        if not good.any():
            return
        known, ids = self.best[item]
        scores, ids = np.concatenate((known, scores[good])), np.concatenate((ids, self.doc_ids[docs[good]]))
        order = np.lexsort((ids, -scores))[: self.k]
        self.best[item] = scores[order], ids[order]
        if len(order) == self.k:
            self.floors[item] = max(self.floors[item], scores[order[-1]])

    def rows(self) -> pa.RecordBatch:
        """(item, doc_id, score) of what is kept; items by their number."""
        size = [len(scores) for scores, _ in self.best]
        items = np.repeat(self.number, size)
        scores = np.concatenate([s for s, _ in self.best]) if self.best else np.zeros(0, np.int64)
        ids = np.concatenate([i for _, i in self.best]) if self.best else scores
        doc_ids = pa.array(ids, pa.int64(), mask=ids == NO_ID)
        return pa.record_batch([pa.array(items, pa.int32()), doc_ids, pa.array(scores, pa.int64())], ["item", "doc_id", "score"])


# --- on Spark -------------------------------------------------------------------------------------


def matched(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Each document's number of terms, and those of the vocabulary with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, terms, counts = [], [], []
            for text in batch.column("text").to_pylist():
                words = terms_of(text)
                found = np.array([i for i in map(vocabulary.get, words) if i is not None], np.int32)
                own, times = np.unique(found, return_counts=True)
                sizes.append(len(words))
                terms.append(own)
                counts.append(times.astype(np.int32))
            lists = [pa.array(x, pa.list_(pa.int32())) for x in (terms, counts)]
            yield pa.record_batch([batch.column("doc_id"), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, MATCHED)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut so that each holds about ``POSTINGS`` terms."""
    for batch in batches:
        ends, start = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy()), 0
        while start < len(batch):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + POSTINGS, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def _searched(rows: DataFrame, items: list[list[int]], weights: np.ndarray, total: tuple[int, int], k: int, floors) -> DataFrame:
    """At most k rows of each item from every task."""
    number, length = total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(items, weights, k, floors)
        for batch in _batches(batches):
            size = pc.list_value_length(batch.column("terms")).to_numpy()
            terms = batch.column("terms").flatten().to_numpy().astype(np.int64)
            times = batch.column("counts").flatten().to_numpy().astype(np.int64)
            m = 100 - 50 + 50 * batch.column("n").to_numpy() * number // length
            values = 1_000_000_000 * times // (1000 * times + 20 * np.repeat(m, size))
            search.add(batch.column("doc_id").fill_null(NO_ID).to_numpy(), Level(np.concatenate(([0], np.cumsum(size))), terms, values))
        yield search.rows()

    return rows.mapInArrow(run, "item int, doc_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def _of_block(docs: DataFrame, block: list[list[bytes]], k: int) -> DataFrame:
    """(item, rank, doc_id, score) for items given by their terms."""
    vocabulary = {t: i for i, t in enumerate(sorted({t for own in block for t in own}))}
    items = [sorted({vocabulary[t] for t in own}) for own in block]
    rows = saved(matched(docs, vocabulary), "matched")
    number, length = rows.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    rows = rows.where(F.size("terms") > 0)
    df = np.zeros(len(vocabulary), np.int64)
    for term, n in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row a term of the block
        df[term] = n
    weights = np.array([math.floor(1000 * math.log((2 * number + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    total = number, max(length or 0, 1)

    seeds = rows.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(SEED)) == 0)
    floors = np.zeros(len(items), np.int64)
    first = _best(_searched(seeds, items, weights, total, k, None), k)
    for item, score in first.where(F.col("rank") == k).select("item", "score").collect():  # one row an item of the block
        floors[item] = score
    return _best(_searched(rows, items, weights, total, k, floors), k)


def ranked(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above 0 for each item."""
    spark = docs.sparkSession
    items = saved(items.select("item_id", F.col("text").cast("string").alias("text")).distinct(), "items")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK) or 1
    schema = f"item int, item_id {items.schema['item_id'].dataType.simpleString()}"
    out = None
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()  # about BLOCK bytes
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(own)], schema)
        found = saved(_of_block(docs, [terms_of(r.text) for r in own], k), "ranked").join(names, "item")
        found = found.select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return out
