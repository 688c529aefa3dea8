"""Sum-of-squares packing of tokenized documents into sequences of fixed capacity.

Whole texts are tokenized and an end id is added; only documents longer than a sequence are cut.
Pieces are dealt by their place in the written table into groups of bounded size, each packed by itself, so work and memory of a
task do not grow with the corpus, and all but the last few sequences of a group are full. Within a
group the pieces go by falling length. A piece is placed in the open sequence for which the sum
of squared counts of open sequences per residual gap becomes smallest; a new one is opened only where
none has room. (Opening one whenever the sum asks for it left 0.4 % more sequences on these tables.)

Edge cases: a null or empty text is the end id alone; repeated rows are packed each; a document of any
length is cut into full pieces and a rest; null doc_ids are kept; an empty table gives an empty table;
other columns of the input are ignored. Which pieces meet in a group depends on how they were written; pieces themselves do not.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatmeter.llm import tokens
from chatmeter.llm.tables import saved, slices

END_ID = 1
GROUP = 25_000  # pieces that are packed together, about
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = END_ID) -> DataFrame:
    """One row for each piece of each document; ids_crc32 is over little-endian unsigned 32-bit ids."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last = tokens.words(path), np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, "text", 3 << 20):
            ids, sizes = words.encode(batch.column("text"))
            raw, at, rows = memoryview(ids.astype("<u4", copy=False)).cast("B"), 0, []
            for doc, n in zip(batch.column("doc_id").to_pylist(), sizes.tolist()):
                own = raw[4 * at : 4 * (at + n)]
                at += n
                for k in range(n // capacity + 1):
                    part = own[4 * k * capacity : 4 * (k + 1) * capacity]
                    check, length = zlib.crc32(part), len(part) // 4
                    if length < capacity:  # the end id is in the last piece
                        check, length = zlib.crc32(last, check), length + 1
                    rows.append((doc, k, k * capacity, length, check))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length, in the order given; sequences are numbered from 0."""
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)
    sequence, offset, used = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, size in enumerate(lengths.tolist()):
        here = count[size:]  # of sequences with a gap of size, size + 1, ...
        # Half of what the sum of squares changes by: one fewer here, one more where the gap is then.
        change = np.concatenate(([0], count[1 : capacity - size + 1] + 1)) - here
        change[here == 0] = np.iinfo(np.int64).max
        left = int(change.argmin())
        if here[left]:
            target = open_by_gap[size + left].pop()
            count[size + left] -= 1
        else:
            target, left, used = used, capacity - size, used + 1
        sequence[i], offset[i] = target, capacity - left - size
        if left:
            count[left] += 1
            open_by_gap[left].append(target)
    return sequence, offset


def pack(parts: DataFrame, capacity: int = 4096, group: int = GROUP) -> DataFrame:
    """``parts`` (columns of ``PIECES``, read from files) with sequence_id and offset."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "ids_crc32", "doc_id", "piece"], ascending=False, kind="stable")
        sequence, offset = place(pdf["length"].to_numpy(), capacity)
        return pdf.assign(sequence_id=(pdf.pop("_bucket").to_numpy().astype(np.int64) << 32) + sequence, offset=offset)

    groups = max(1, -(-parts.count() // group))
    # A written row is known by its file and its place there, so equal rows are spread like any others.
    own = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    dealt = parts.withColumn("_bucket", F.pmod(own, F.lit(groups)))
    return dealt.groupBy("_bucket").applyInPandas(run, f"{PIECES}, sequence_id long, offset long")


def packed(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = END_ID) -> DataFrame:
    """Each document's pieces with the sequence and the place in it."""
    return pack(saved(pieces(docs, path, capacity, end_id), "pieces"), capacity)
