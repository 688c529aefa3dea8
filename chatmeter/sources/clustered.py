"""Tables hashed by key into buckets, so that a grouping or join on the key meets no exchange of them.

A clustered table is a Spark bucketed table in generations: each is a folder of one file for each bucket, and a
partition of the table. A version file lists the generations that count and what they were made from, and is put there last, so readers
never meet half of a refresh. Spark knows from the catalog how the files are dealt; a grouping by the key reads the files of a
bucket in one task, whatever their generations, and settles there what rows with the same key mean. Appending
exchanges the new rows only. When generations have become many they are rewritten as one, bucket by bucket, without an exchange.

``Followed`` keeps such a table in step with a table of the KPI store. What is stored there stays as it is; the
clustered rows can be made again at any time.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmeter.session import hadoop_path
from chatmeter.sources import deltas

BUCKETS = 64  # for a new table; choose so that one bucket's rows fit a task
MOST = 8  # generations before they are rewritten as one

Fold = Callable[[DataFrame], DataFrame]


class Clustered:
    """A table of ``schema`` under ``path``, hashed by ``keys``; ``fold`` makes rows with the same key one."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], fold: Fold, buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.keys, self.fold = spark, path.rstrip("/"), schema, keys, fold
        _, state = self.state()
        self.buckets = state.get("buckets", buckets)  # of an existing table they stay
        self.name = "chatmeter_" + hashlib.md5(self.path.encode()).hexdigest()[:20]

    def state(self) -> tuple[int, dict]:
        found = deltas.versions(self.spark, f"{self.path}/_versions")
        return (found[-1][0], json.loads(deltas.read_text(self.spark, found[-1][1]))) if found else (0, {})

    def commit(self, version: int, generations: list[str], **more) -> None:
        state = {"buckets": self.buckets, "generations": generations, **more}
        deltas.put_text(self.spark, f"{self.path}/_versions/{version + 1:012d}.json", json.dumps(state))

    def write(self, df: DataFrame, exchange: bool = True) -> str:
        """A generation with the rows of ``df``, which counts once it is committed. Without an exchange
        ``df`` must come from the buckets as they are."""
        generation = uuid.uuid4().hex
        rows = df.select(*self.schema.fieldNames())
        if exchange:
            rows = rows.repartition(self.buckets, *self.keys)
        writer = rows.write.format("parquet").bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        aside = f"{self.name}_{generation}"
        try:
            writer.option("path", f"{self.path}/data/generation={generation}").saveAsTable(aside)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {aside}")  # the files stay
        return generation

    def rows(self, generations: list[str] | None = None) -> DataFrame:
        """All rows of the generations that count, with Spark's knowledge of the buckets."""
        wanted = self.state()[1].get("generations", []) if generations is None else generations
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        keys = ", ".join(f"`{k}`" for k in self.keys)
        place = f"{self.path}/data".replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, generation STRING) USING parquet PARTITIONED BY (generation) "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )
        there = {r[0].removeprefix("generation=") for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()}
        new = [f"PARTITION (generation='{g}')" for g in sorted(set(wanted) - there)]
        if new:
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {' '.join(new)}")
        # Other generations may be known to the catalog for other versions; they are pruned.
        return self.spark.table(self.name).where(F.col("generation").isin(wanted)).select(*self.schema.fieldNames())

    def folded(self) -> DataFrame:
        return self.fold(self.rows())

    def vacuum(self, hours: float = 24.0) -> int:
        """Deletes generations that do not count and are older than ``hours``; returns how many."""
        live, gone = set(self.state()[1].get("generations", [])), 0
        latest = (time.time() - hours * 3600) * 1000
        for status in deltas.listed(self.spark, f"{self.path}/data"):
            name = status.getPath().getName().removeprefix("generation=")
            if name not in live and status.getModificationTime() <= latest:
                hpath, fs = hadoop_path(self.spark, status.getPath().toString())
                fs.delete(hpath, True)
                gone += 1
        return gone


class Followed(Clustered):
    """A clustered copy of a table of the KPI store whose meaning bears repeated rows: a distinct, an earliest."""

    def __init__(self, spark: SparkSession, table: str, path: str, schema: T.StructType, keys: list[str], fold: Fold, buckets: int = BUCKETS):
        super().__init__(spark, path, schema, keys, fold, buckets)
        self.table = table

    def refresh(self) -> int:
        """Takes in what has been stored, corrected or folded since the last refresh; gives the version.

        Only new entries are read and exchanged. Corrections made since then are carried out on all that is
        there, bucket by bucket. A job that was run again, or a correction whose keys are gone, makes all anew.
        """
        version, state = self.state()
        live = deltas.entries(self.spark, self.table)
        seen = {(w, first, last, data) for w, first, last, data in state.get("seen", [])}
        now = {(w, e.first, e.last, e.data) for w, e in live}
        masks = {m for _, e in live for m in (*e.masks, *e.settled)}
        if seen == now and masks == set(state.get("masks", [])):
            return version
        generations = state.get("generations", [])
        new_masks = sorted(masks - set(state.get("masks", [])))
        kept = {s.getPath().getName() for s in deltas.listed(self.spark, f"{self.table}/masks")} if new_masks else set()
        if not fits(seen, live) or not kept.issuperset(new_masks):
            seen, generations, new_masks = set(), [], []
        if generations and (new_masks or len(generations) >= MOST):
            rows = self.folded()
            for mask in new_masks:
                keys = self.spark.read.parquet(f"{self.table}/masks/{mask}")
                rows = rows.join(keys, keys.columns, "left_anti")
            generations = [self.write(rows, exchange=False)]
        fresh = unseen(seen, live)
        if fresh:
            generations = [*generations, self.write(self.fold(deltas.rows_of(self.spark, self.table, self.schema, fresh)))]
        self.commit(version, generations, seen=sorted(map(list, now)), masks=sorted(masks))
        return version + 1


def _ranges(seen: set[tuple]) -> dict[str, list[tuple[int, int]]]:
    """The batches of each writer that were seen, as ranges that neither meet nor touch."""
    out: dict[str, list[tuple[int, int]]] = {}
    for w, first, last in sorted((w, first, last) for w, first, last, _ in seen):
        of = out.setdefault(w, [])
        if of and first <= of[-1][1] + 1:
            of[-1] = (of[-1][0], max(last, of[-1][1]))
        else:
            of.append((first, last))
    return out


def fits(seen: set[tuple], live: list[tuple[str, deltas.Entry]]) -> bool:
    """Whether all that was seen still stands, as it was or folded into a wider entry."""
    now = {(w, e.first, e.last, e.data) for w, e in live}
    return all(
        s in now or any(w == s[0] and e.first <= s[1] and s[2] <= e.last and e.first < e.last for w, e in live) for s in seen
    )


def unseen(seen: set[tuple], live: list[tuple[str, deltas.Entry]]) -> list[deltas.Entry]:
    """The entries that bring batches which were not seen. A fold brings those that it has beside seen ones again."""
    ranges = _ranges(seen)
    return [
        e
        for w, e in live
        if (w, e.first, e.last, e.data) not in seen and not any(a <= e.first and e.last <= b for a, b in ranges.get(w, []))
    ]
