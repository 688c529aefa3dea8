"""SimHash near-duplicates by multi-index hashing.

A fingerprint sums the hash bits of all word shingles of a whole text. Equal fingerprints collapse
to one node first, so a group of copies of any size is one row. Distinct fingerprints are cut into
segments: two fingerprints at most ``max_bits`` apart agree, in some segment, up to a small radius.
The table has each fingerprint under each exact segment; the probes enumerate the Hamming ball around
each segment, meet the table by an exchange on the segment value, and complete distances decide.

A segment value shared by very many fingerprints is split into blocks of bounded size, each its own
task row group. A block reports its links as a spanning forest, so dense groups cost links in
proportion to their members.

Edge cases: a null text and a text without words have fingerprint zero; fewer words than a shingle
give one shingle; repeated rows are members like any other; an empty table gives an empty table;
other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmeter.llm.graph import components
from chatmeter.llm.tables import saved, slices

SEED = 42
BLOCK = 4096  # table fingerprints that one task row group holds at most


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The SimHash of a whole text; hashes are counted in steps, so memory stays bounded."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # splits on space and \x09-\x0D
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    starts, ends = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    total, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), 32768):
        hashes = np.array([digest(line[i:j], SEED) for i, j in zip(starts[at : at + 32768], ends[at : at + 32768])], "<u8")
        for part in np.array_split(hashes, -(-len(hashes) // 255)):  # bits of 255 hashes fit a byte
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return int(np.packbits(total * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp): one row for each row of ``docs``; fp as a signed long with the same bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = np.array([fingerprint(x, shingle) for x in batch.column("text").to_pylist()], np.uint64)
            yield pa.record_batch([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def plan(max_bits: int, segments: int) -> list[tuple[int, int, int]]:
    """(offset, width, radius) of each segment. Of fingerprints within ``max_bits``, at least one
    segment is within its radius: else they'd differ by the sum of all radii plus one each."""
    each, rest = divmod(max_bits, segments)
    widths = [64 // segments + (i < 64 % segments) for i in range(segments)]
    radii = [each if i <= rest else each - 1 for i in range(segments)]
    return [(sum(widths[:i]), w, r) for i, (w, r) in enumerate(zip(widths, radii)) if r >= 0]


def _ball(width: int, radius: int) -> list[int]:
    return [sum(1 << i for i in picked) for r in range(radius + 1) for picked in combinations(range(width), r)]


def _bucket(fp: Column, number: int, offset: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, offset).bitwiseAND(F.lit((1 << width) - 1)) + F.lit(number << 40)


def _forest(table: tuple, probes: tuple, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what the pairs of one row group connect: every member to the least in reach."""
    out = []
    for i in range(0, len(table[0]), 1024):
        t_fp, t = table[0][i : i + 1024], table[1][i : i + 1024]
        for j in range(0, len(probes[0]), 1024):
            p_fp, p = probes[0][j : j + 1024], probes[1][j : j + 1024]
            near = np.bitwise_count(p_fp[:, None] ^ t_fp[None, :]) <= max_bits
            least_t, least_p, top = t.copy(), p.copy(), np.iinfo(np.int64).max
            while True:
                new_p = np.minimum(least_p, np.where(near, least_t[None, :], top).min(axis=1))
                new_t = np.minimum(least_t, np.where(near, new_p[:, None], top).min(axis=0))
                if (new_p == least_p).all() and (new_t == least_t).all():
                    break
                least_t, least_p = new_t, new_p
            out += [(p[least_p < p], least_p[least_p < p]), (t[least_t < t], least_t[least_t < t])]
    return out


def _matches(max_bits: int):
    """Over rows sorted by bucket, block and table-first: links of probes with table rows of their bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            bucket, block, probe, fp, rep = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            fp = fp.view(np.uint64)
            if held is not None and len(bucket) and held[0][0] == bucket[0] and held[1][0] == block[0]:
                bucket, block, probe, fp, rep = (np.concatenate(x) for x in zip(held, (bucket, block, probe, fp, rep)))
            if not len(bucket):
                continue
            new = np.flatnonzero((bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1])) + 1
            first, last = np.concatenate(([0], new)), np.concatenate((new, [len(bucket)]))
            tables = np.add.reduceat(probe == 0, first)
            keep = slice(first[-1], first[-1] + tables[-1])  # the table of a bucket that may go on
            held = tuple(x[keep].copy() for x in (bucket, block, probe, fp, rep)) if tables[-1] else None
            pairs = tables * (last - first - tables)
            out = []
            for k in np.flatnonzero(pairs > 256):
                m = first[k] + tables[k]
                out += _forest((fp[first[k] : m], rep[first[k] : m]), (fp[m : last[k]], rep[m : last[k]]), max_bits)
            small = np.flatnonzero((pairs > 0) & (pairs <= 256))
            for part in np.array_split(small, max(1, -(-int(pairs[small].sum()) // 2_000_000))):
                n = pairs[part]
                of = np.repeat(np.arange(len(part)), n)
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                t = first[part][of] + at % tables[part][of]
                p = first[part][of] + tables[part][of] + at // tables[part][of]
                near = (rep[p] > rep[t]) & (np.bitwise_count(fp[p] ^ fp[t]) <= max_bits)
                out.append((rep[p[near]], rep[t[near]]))
            if out:
                a, b = (np.concatenate(x) for x in zip(*out))
                if len(a):
                    yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def links(nodes: DataFrame, max_bits: int = 4, segments: int = 3) -> DataFrame:
    """Links (a, b) between the ``rep`` of distinct ``fp`` that connect all within ``max_bits``."""
    parts = list(enumerate(plan(max_bits, segments)))
    table = nodes.select("fp", "rep", F.explode(F.array(*[_bucket(F.col("fp"), k, o, w) for k, (o, w, _) in parts])).alias("bucket"))
    around = [_bucket(F.col("fp"), k, o, w).bitwiseXOR(F.lit(m)) for k, (o, w, r) in parts for m in _ball(w, r)]
    probes = nodes.select("fp", "rep", F.explode(F.array(*around)).alias("bucket"))
    # Buckets of many fingerprints, as a table that the planner broadcasts only under its threshold.
    crowded = saved(
        table.groupBy("bucket").count().where(F.col("count") > BLOCK).select("bucket", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")),
        "crowded",
    )
    if not crowded.isEmpty():
        one = F.coalesce("blocks", F.lit(1))
        table = table.join(crowded, "bucket", "left").withColumn("block", F.pmod(F.xxhash64("fp"), one).cast("int"))
        probes = probes.join(crowded, "bucket", "left").withColumn("block", F.explode(F.sequence(F.lit(0), one - 1)))
    else:
        table, probes = table.withColumn("block", F.lit(0)), probes.withColumn("block", F.lit(0))
    rows = table.withColumn("probe", F.lit(0)).unionByName(probes.withColumn("probe", F.lit(1)))
    rows = rows.select("bucket", "block", "probe", "fp", "rep")
    return (
        rows.repartition("bucket", "block")
        .sortWithinPartitions("bucket", "block", "probe")
        .mapInArrow(_matches(max_bits), "a long, b long")
    )


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, segments: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for each row: the smallest doc_id that links reach, itself included.

    Rows without a doc_id are left out, as nothing can be said about them.
    """
    marks = saved(fingerprints(docs.where(F.col("doc_id").isNotNull()), shingle), "fingerprints")
    nodes = saved(marks.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    roots = components(links(nodes, max_bits, segments), "a", "b")
    classes = nodes.join(roots, nodes.rep == roots.node, "left").select("fp", F.coalesce("root", "rep").alias("component_id"))
    return marks.join(classes, "fp").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` but those near to one of smaller doc_id. Of a repeated doc_id one row stays;
    rows without a doc_id all stay."""
    marks = near_duplicates(docs, shingle, max_bits)
    first = F.col("doc_id") == F.col("component_id")
    ids = saved(marks.groupBy("doc_id").agg(F.max(first).alias("kept"), (F.count("*") > 1).alias("repeated")), "ids")
    out = docs.join(ids.where(~F.col("kept")).select("doc_id"), "doc_id", "left_anti")
    again = ids.where("kept and repeated").select("doc_id")
    if not again.isEmpty():
        one = out.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        out = out.join(again, "doc_id", "left_anti").unionByName(one)
    return out.select(*docs.columns)
