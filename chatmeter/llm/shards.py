"""Token sequences written in training order, as binary shards of fixed stride.

The documents of an input partition are tokenized, each followed by the end id, and cut into sequences of equal
length; only the last of a partition is padded, with an id that no token has. The sequences are written once, compressed; a written
row's file and place there number all of them without gaps, and stay the same when a task is repeated. A keyed Feistel network permutes the numbers: four rounds over
the next even power of two, walked on until the value lies in range again, so it is a permutation for any
count, computed by each task for itself. The permuted number is the sequence's slot.

Slots are exchanged once, by shard; a shard holds as many slots as every other (the last may hold fewer), sorted.
A sequence takes ``2 * length + 2`` bytes: little-endian unsigned 16-bit ids and a closing zero. So slot s
starts at byte ``(s % per_shard) * stride`` of shard ``s // per_shard``, and a run can go on from any slot.

Edge cases: a null or empty text gives its end id alone; repeated rows are written each; an
empty table gives no shards; other columns are ignored. A vocabulary with ids of ``PAD_ID`` or more is refused.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatmeter.llm import tokens
from chatmeter.llm.tables import saved, slices

END_ID = 1
PAD_ID = 0xFFFF  # of no token: ids of a vocabulary that is written here are lower
SLICE = 4 << 20  # bytes of text that are tokenized together
PER_SHARD = 8192


def stride(length: int) -> int:
    return 2 * length + 2


def permuted(numbers: np.ndarray, count: int, seed: int, rounds: int = 4) -> np.ndarray:
    """The slots of ``numbers``, all under ``count``: a permutation that ``seed`` picks."""
    half = max(1, (max(1, count - 1).bit_length() + 1) // 2)
    mask, out = np.uint64((1 << half) - 1), numbers.astype(np.uint64)
    keys = np.random.SeedSequence(seed).generate_state(rounds, np.uint64)
    outside = np.ones(len(out), bool)
    while outside.any():
        left, right = out[outside] >> np.uint64(half), out[outside] & mask
        for key in keys:
            mixed = (right ^ key) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        out[outside] = left << np.uint64(half) | right
        outside = out >= count
    return out.astype(np.int64)


def check_vocabulary(tokenizer: str) -> None:
    """Ids are written in 16 bits, so wider ones would come back as others."""
    widest = max(max(tokens.words(tokenizer).tokenizer.get_vocab().values()), END_ID)
    tokens.forget()  # the driver tokenizes nothing
    if widest >= PAD_ID:
        raise ValueError(f"{tokenizer} has ids up to {widest}; shards hold ids under {PAD_ID}")


def _sequences(batches: Iterator[pa.RecordBatch], path: str, length: int) -> Iterator[np.ndarray]:
    """Blocks of whole sequences of a partition, as rows of ids; the last row padded."""
    words, rest = tokens.words(path), np.zeros(0, np.uint32)
    for batch in slices(batches, "text", SLICE):
        ids, sizes = words.encode(batch.column("text"))
        ids = np.insert(ids, np.cumsum(sizes), END_ID)
        ids = np.concatenate((rest, ids))
        whole = len(ids) // length * length
        if whole:
            yield ids[:whole].reshape(-1, length)
        rest = ids[whole:]
    if len(rest):
        yield np.pad(rest, (0, length - len(rest)), constant_values=PAD_ID).reshape(1, -1)


def _by_frequency(docs: DataFrame, tokenizer: str) -> np.ndarray:
    """All 16-bit ids, those that are frequent in a few texts first: what is stored between the steps is coded by place in
    this order, which any order would allow and this one makes short."""
    some = [r.text for r in docs.select(F.substring(F.col("text").cast("string"), 1, 5000).alias("text")).limit(200).collect()]
    ids, _ = tokens.words(tokenizer).encode(pa.array(some, pa.string()))
    tokens.forget()  # the driver tokenizes no more
    return np.argsort(-np.bincount(ids, minlength=1 << 16), kind="stable").astype("<u2")


def _squeezed(ids: np.ndarray, place: np.ndarray) -> list[bytes]:
    """Each row of ids compressed by their places, low bytes before high ones, which are mostly zero."""
    planes = place[ids].view(np.uint8).reshape(len(ids), -1, 2).transpose(0, 2, 1)
    pack = zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=True).compress
    return [pack(row.tobytes()) for row in planes]


def _unsqueezed(rows: list[bytes], length: int, order: np.ndarray) -> np.ndarray:
    unpack = zstandard.ZstdDecompressor().decompress
    planes = np.frombuffer(b"".join(map(unpack, rows)), np.uint8).reshape(len(rows), 2, length)
    return order[np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u2").reshape(len(rows), length)]


def _binary(rows: np.ndarray, size: int) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(size), len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def write(docs: DataFrame, path: str, tokenizer: str, length: int = 1024, per_shard: int = PER_SHARD, seed: int = 0) -> int:
    """Writes the shards under ``path``; gives the number of sequences."""
    check_vocabulary(tokenizer)
    order = _by_frequency(docs, tokenizer)
    places = np.empty(1 << 16, "<u2")
    places[order] = np.arange(1 << 16)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids in _sequences(batches, tokenizer, length):
            yield pa.record_batch([pa.array(_squeezed(ids, places), pa.binary())], ["ids"])

    rows = saved(docs.select(F.col("text").cast("string").alias("text")).mapInArrow(cut, "ids binary"), "sequences")
    # A written row is known by its file and its place there; the files are as many as there were tasks.
    files = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
    files = saved(files, "files")
    total = files.agg(F.sum("n")).first()[0] or 0
    first = (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("first")
    files = saved(files.select("file", first), "firsts")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = permuted(batch.column("number").to_numpy(), total, seed)
            yield pa.record_batch([pa.array(slots), pa.array(slots // per_shard), batch.column("ids")], ["slot", "shard", "ids"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()  # this worker may have tokenized before
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                ids = _unsqueezed(part.column("ids").to_pylist(), length, order)
                yield pa.record_batch([*part.columns[:2], _binary(ids, 2 * length)], ["slot", "shard", "ids"])

    own = rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), "ids")
    numbered = own.join(files, "file").select((F.col("first") + F.col("row")).alias("number"), "ids")
    layout = "slot long, shard long, ids binary"
    number = max(1, -(-total // per_shard))
    placed = numbered.mapInArrow(place, layout).repartition(min(number, 200_000), "shard")
    placed = placed.mapInArrow(whole, layout).sortWithinPartitions("shard", "slot")
    # The text writer copies bytes as they are, and its line separator closes each sequence.
    placed.select(F.col("ids").cast("string").alias("value"), "shard").write.partitionBy("shard").option("lineSep", "\0\0").text(path)
    return total


def read(spark: SparkSession, path: str, length: int = 1024, per_shard: int = PER_SHARD, start: int = 0) -> DataFrame:
    """(slot, shard, byte_offset, ids) of all sequences from slot ``start`` on; earlier shards are not opened."""
    files = spark.read.format("binaryFile").load(path).select("content", F.col("shard").cast("long").alias("shard"))
    step, size = stride(length), F.octet_length("content")
    whole = F.when(size % step == 0, size / step).otherwise(F.raise_error(F.lit("a shard ends within a sequence")).cast("long")).cast("int")
    place = F.explode(F.sequence(F.lit(0), whole - 1)).alias("place")
    # Cut where the files are read, so no task holds more than a file at once.
    rows = files.where((F.col("shard") >= start // per_shard) & (size > 0)).select("content", "shard", place)
    rows = rows.withColumn("slot", F.col("shard") * per_shard + F.col("place")).where(F.col("slot") >= start)
    offset = F.col("place").cast("long") * step
    return rows.select("slot", "shard", offset.alias("byte_offset"), F.substring("content", (offset + 1).cast("int"), F.lit(2 * length)).alias("ids"))


def digests(sequences: DataFrame) -> DataFrame:
    """(slot, shard, byte_offset, n_ids, ids_crc32): ids that aren't padding, and a checksum over 32-bit ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, checks = [], []
            for raw in batch.column("ids"):
                ids = np.frombuffer(raw.as_buffer(), "<u2")
                ids = ids[ids != PAD_ID].astype("<u4")
                n.append(len(ids))
                checks.append(zlib.crc32(ids.tobytes()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n, pa.int32()), pa.array(checks, pa.int64())], ["slot", "shard", "byte_offset", "n_ids", "ids_crc32"])

    return sequences.mapInArrow(run, "slot long, shard long, byte_offset long, n_ids int, ids_crc32 long")
