"""KPI tables as append-only parquet data with a commit log for each writer.

A batch of a writer is written to a folder of its own, ``<table>/data/batch=<id>``, and counts once the
writer's next log version, ``<table>/_log/<writer>/<version>.json``, lists it. A version lists all live
batches of its writer, and few old versions are kept, so a reader opens one small file for each writer
whatever the number of batches. A repeated batch takes the place of its first attempt; data that no version
lists are what a failed write left, and are not read. What a table says is an aggregate over its
rows: a sum for counters, a distinct for sets, the earliest arrival for first visits. So a write never
reads the table, and costs the same on the first day as after years.

A correction is a small table of keys that no longer count. It is noted at the batches that exist, and stays
with them when they are repeated; rows under these keys are left out on reading, until ``compact`` drops
them for good. Later batches bring such keys back.

Each writer is one job, or one run of a stream from its checkpoint, ``<source>@<id of the query>``: a stream that starts
anew numbers its batches from 0 again, and they are other batches. Writers run once at a time. Corrections and compactions change the log of the
writers too: stop the streams for a correction; a stream compacts its own batches itself.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from chatmeter.session import hadoop_path

KINDS = ("job", "stream")
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_.-")
_VERSIONS_KEPT = 5


@dataclass(frozen=True)
class Entry:
    """Batches ``first`` to ``last`` of a writer in one data folder."""

    first: int
    last: int
    data: str
    days: tuple[str, ...] = ()  # of tables that lie by day
    arrived: str | None = None
    masks: tuple[str, ...] = ()  # corrections that apply
    settled: tuple[str, ...] = ()  # corrections that a fold has carried out


def writer(kind: str, source: str) -> str:
    """Jobs and streams of the same name are different writers, as are runs ``name@run`` of a stream."""
    parts = source.split("@", 1)
    if kind not in KINDS or not all(x and set(x) <= _LETTERS for x in parts):
        raise ValueError(f"a source name may hold letters, digits, '_', '-' and '.' only: {source!r}")
    return f"{kind}={source}"


# --- the log --------------------------------------------------------------------------------------


def listed(spark: SparkSession, path: str) -> list:
    hpath, fs = hadoop_path(spark, path)
    return list(fs.listStatus(hpath)) if fs.exists(hpath) else []


def read_text(spark: SparkSession, path: str) -> str:
    hpath, fs = hadoop_path(spark, path)
    stream = fs.open(hpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A new file, there whole or not at all; an existing one is an error."""
    hpath, fs = hadoop_path(spark, path)
    aside, _ = hadoop_path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(aside)
    stream.write(bytearray(text.encode()))
    stream.close()
    if fs.exists(hpath) or not fs.rename(aside, hpath):
        fs.delete(aside, False)
        raise RuntimeError(f"{path} was written by another run")


def versions(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """(number, path) of the versions in a log folder, in order."""
    names = [(s.getPath().getName(), s.getPath().toString()) for s in listed(spark, folder)]
    return sorted((int(n.removesuffix(".json")), p) for n, p in names if n.endswith(".json"))


def _log(table: str, of: str) -> str:
    return f"{table}/_log/{of}"


def _state(spark: SparkSession, table: str, of: str) -> tuple[int, list[Entry]]:
    found = versions(spark, _log(table, of))
    if not found:
        return 0, []
    rows = json.loads(read_text(spark, found[-1][1]))
    return found[-1][0], [Entry(**{k: tuple(v) if isinstance(v, list) else v for k, v in r.items()}) for r in rows]


def _commit(spark: SparkSession, table: str, of: str, version: int, entries: list[Entry]) -> None:
    folder = _log(table, of)
    entries = sorted(entries, key=lambda e: e.first)
    put_text(spark, f"{folder}/{version + 1:012d}.json", json.dumps([asdict(e) for e in entries]))
    for number, path in versions(spark, folder):
        if number <= version - _VERSIONS_KEPT:
            hpath, fs = hadoop_path(spark, path)
            fs.delete(hpath, False)


def writers(spark: SparkSession, table: str) -> list[str]:
    return sorted(s.getPath().getName() for s in listed(spark, f"{table}/_log"))


def runs(spark: SparkSession, table: str, kind: str, source: str) -> list[str]:
    """The writers of a job or stream: itself, and its runs."""
    of = writer(kind, source)
    return [w for w in writers(spark, table) if w == of or w.startswith(f"{of}@")]


def entries(spark: SparkSession, table: str) -> list[tuple[str, Entry]]:
    """(writer, entry) of all that counts."""
    return [(w, e) for w in writers(spark, table) for e in _state(spark, table, w)[1]]


# --- rows -----------------------------------------------------------------------------------------


def _write_data(df: DataFrame, table: str, by_day: bool) -> tuple[str, tuple[str, ...]]:
    """(data folder, its days). Rows are rebalanced, so small batches give one file and large ones even files."""
    data = uuid.uuid4().hex
    path = f"{table}/data/batch={data}"
    if by_day:
        df.hint("rebalance", "day").write.partitionBy("day").parquet(path)
    else:
        df.hint("rebalance").write.parquet(path)
    names = [s.getPath().getName() for s in listed(df.sparkSession, path)] if by_day else []
    return data, tuple(sorted(n.removeprefix("day=") for n in names if n.startswith("day=")))


def recorded_arrival(spark: SparkSession, table: str, kind: str, source: str, batch: int = 0) -> str | None:
    """The arrival that the first run of a batch noted."""
    return next((e.arrived for e in _state(spark, table, writer(kind, source))[1] if e.first <= batch <= e.last), None)


def write_delta(
    df: DataFrame, table: str, kind: str, source: str, batch: int, by_day: bool = False, arrived: str | None = None
) -> None:
    """Write the rows of one batch. A repeated batch takes the place of its first attempt, under the same
    corrections; one that was folded into a wider entry is there already."""
    spark, of = df.sparkSession, writer(kind, source)
    if any(e.first <= batch <= e.last and e.first < e.last for e in _state(spark, table, of)[1]):
        return
    data, days = _write_data(df, table, by_day)
    version, live = _state(spark, table, of)
    old = next((e for e in live if e.first == e.last == batch), None)
    new = Entry(batch, batch, data, days, arrived or (old.arrived if old else None), old.masks if old else ())
    _commit(spark, table, of, version, [e for e in live if e is not old] + [new])


def rows_of(spark: SparkSession, table: str, schema: T.StructType, some: list[Entry]) -> DataFrame:
    """The rows of some entries, without those that corrections take out."""
    out = None
    for masks in sorted({e.masks for e in some}):
        paths = [f"{table}/data/batch={e.data}" for e in some if e.masks == masks]
        rows = spark.read.schema(schema).option("basePath", f"{table}/data").parquet(*paths).select(*schema.fieldNames())
        for mask in masks:
            keys = spark.read.parquet(f"{table}/masks/{mask}")
            rows = rows.join(keys, keys.columns, "left_anti").select(*schema.fieldNames())
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], schema) if out is None else out


def read_deltas(spark: SparkSession, table: str, schema: T.StructType, without: str | None = None) -> DataFrame:
    """All rows of the table, once each, but for those of one writer; an unwritten table is empty."""
    return rows_of(spark, table, schema, [e for w, e in entries(spark, table) if w != without])


def mask(table: str, keys: DataFrame) -> None:
    """Let the rows that exist under ``keys`` (some columns of the table) no longer count."""
    spark, name = keys.sparkSession, uuid.uuid4().hex
    keys.write.parquet(f"{table}/masks/{name}")
    for of in writers(spark, table):
        version, live = _state(spark, table, of)
        _commit(spark, table, of, version, [replace(e, masks=(*e.masks, name)) for e in live])


# --- upkeep ---------------------------------------------------------------------------------------

Fold = Callable[[DataFrame], DataFrame]


def _fold(spark: SparkSession, table: str, of: str, schema: T.StructType, fold: Fold, some: list[Entry], by_day: bool) -> None:
    data, days = _write_data(fold(rows_of(spark, table, schema, some)), table, by_day)
    version, live = _state(spark, table, of)
    gone = {e.data for e in some}
    settled = tuple(sorted({m for e in some for m in (*e.masks, *e.settled)}))
    new = Entry(min(e.first for e in some), max(e.last for e in some), data, days, settled=settled)
    _commit(spark, table, of, version, [e for e in live if e.data not in gone] + [new])


def compact(
    spark: SparkSession, table: str, of: str, schema: T.StructType, fold: Fold, by_day: bool = False, every: int | None = None
) -> int:
    """Fold the batches of a writer into one entry; returns how many entries there are then.

    ``every`` folds by levels instead: so many single batches into one entry, so many of these into a
    wider one, and so on. Each row is then rewritten once a level, and a writer keeps few entries
    however long it runs. ``fold`` must keep the table's meaning.
    """
    live = _state(spark, table, of)[1]
    if every is None:
        if len(live) > 1:
            _fold(spark, table, of, schema, fold, live, by_day)
    else:
        size = 1
        while any(e.last - e.first + 1 >= size for e in live):
            level = [e for e in live if size <= e.last - e.first + 1 < size * every]
            if len(level) >= every:
                _fold(spark, table, of, schema, fold, level, by_day)
                live = _state(spark, table, of)[1]
            size *= every
    return len(_state(spark, table, of)[1])


def vacuum(spark: SparkSession, table: str, hours: float = 24.0) -> int:
    """Delete data and corrections that no log lists and that are older than ``hours``, which spares writes
    and reads under way; returns how many."""
    live = [e for _, e in entries(spark, table)]
    used = {f"batch={e.data}" for e in live} | {m for e in live for m in e.masks}
    latest, gone = (time.time() - hours * 3600) * 1000, 0
    for folder in ("data", "masks"):
        for status in listed(spark, f"{table}/{folder}"):
            if status.getPath().getName() not in used and status.getModificationTime() <= latest:
                hpath, fs = hadoop_path(spark, status.getPath().toString())
                fs.delete(hpath, True)
                gone += 1
    return gone
