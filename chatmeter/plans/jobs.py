"""Batch jobs over log files, corrections of the stored tables, and their publication.

A backfill reads its text once: one aggregate per (bot, user) holds the page views and the users
alike, is written to a scratch table, and every KPI table is filled from there. ``job`` names the
run; running it again replaces what it wrote. Corrections change the store in place, and hold
when what they corrected is written again; stop the streams of the store while one runs.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmeter.operators import kpi, maintain
from chatmeter.operators.clean import clean_events
from chatmeter.session import hadoop_path, scratch_table
from chatmeter.sources import deltas
from chatmeter.sources.clustered import Followed
from chatmeter.sources.readers import read_lines
from chatmeter.sources.store import KpiStore


def _fill(store: KpiStore, requests: DataFrame, day: Column, job: str, given) -> None:
    arrived = store.arrival(job, given)
    visits = requests.groupBy(*kpi.USER).agg(F.count(F.lit(1)).alias("pv"), F.min(day).alias("day"))
    with scratch_table(store.spark, visits, "visits") as visits:
        seen = visits.withColumn("arrived", F.lit(arrived).cast("timestamp"))
        store.append("first_seen", seen, job, kind="job", arrived=arrived)
        store.append("pv_total", visits.groupBy("bot_name").agg(F.sum("pv").alias("pv")), job, kind="job")


def backfill_totals(store: KpiStore, path: str, job: str, arrived=None, recursive: bool = False) -> None:
    """Total PV and all-time users of log files; the users count as new on no day."""
    requests = clean_events(read_lines(store.spark, path, recursive), strip_ids=True)
    _fill(store, requests, F.lit(None).cast("date"), job, arrived)


def backfill_days(store: KpiStore, path: str, job: str, arrived=None, recursive: bool = False) -> None:
    """Total PV, all-time users and new users per day of log files. The figures per day (``pv_day``, ``users_day``) are left to
    the streams, which may have counted the same days."""
    requests = clean_events(read_lines(store.spark, path, recursive), strip_ids=True)
    _fill(store, requests, F.col("day"), job, arrived)


def backfill_pv(store: KpiStore, path: str, job: str, recursive: bool = False) -> None:
    """PV of log files, added to the totals and to the history; times are not checked."""
    requests = clean_events(read_lines(store.spark, path, recursive), check_time=False)
    with scratch_table(store.spark, kpi.pv_total(requests), "pv") as pv:
        for table in ("pv_total", "pv_history"):
            store.append(table, pv, job, kind="job")


def rebuild_history(store: KpiStore, path: str, job: str, recursive: bool = False) -> None:
    """History PV of the bots in an extracted file, in place of what they had."""
    with scratch_table(store.spark, kpi.pv_extracted(read_lines(store.spark, path, recursive)), "pv") as pv:
        store.set_history(pv, job)


def merge_history(store: KpiStore, job: str = "history") -> None:
    """Add the history PV to the live PV; a second run under the same name adds nothing."""
    store.append("pv_total", store.pv_history(), job, kind="job")


def rollback_day(store: KpiStore, day: str, bots: DataFrame | None = None) -> None:
    """Forget the users who were new on a day, of all bots or of the given ones, so that they can be new again."""
    store.correct("first_seen", maintain.users_to_roll_back(store.new_users_day(), day, bots).select(*kpi.USER))


def purge_bots(store: KpiStore, bots: list[str]) -> None:
    """Forget all users of the listed bots."""
    if bots:
        store.correct("first_seen", _listed(store, bots))


def purge_pv(store: KpiStore, bots: list[str]) -> None:
    """Drop the total PV of the listed bots; the PV per day stays."""
    if bots:
        store.correct("pv_total", _listed(store, bots))


def _listed(store: KpiStore, bots: list[str]) -> DataFrame:
    return store.spark.createDataFrame([(b,) for b in sorted(set(bots))], "bot_name string")


# --- published tables -----------------------------------------------------------------------------

# Tables with a day, and the stored table that each comes from. New users have no day of their own in it.
DAILY = {"pv_day": "pv_day", "users_day": "users_day", "qps_bot": "qps", "qps_product": "qps", "new_users_day": None}
WHOLE = ("pv_total", "pv_history", "bot_registry", "overall_totals", "overall_by_day")
CLUSTERED = "users_total"  # by bucket of (bot, user), in generations


def _published(spark: SparkSession, out: str, version: int | None = None) -> tuple[int, dict]:
    found = deltas.versions(spark, f"{out}/_versions")
    if version is not None:
        found = [f for f in found if f[0] == version]
        if not found:
            raise FileNotFoundError(f"version {version} is not published in {out}")
    return (found[-1][0], json.loads(deltas.read_text(spark, found[-1][1]))) if found else (0, {})


def _published_users(spark: SparkSession, stored: str, out: str) -> Followed:
    columns, fold = KpiStore.TABLES["first_seen"]
    return Followed(spark, stored, f"{out}/users", columns, kpi.USER, fold)


def _marks(rows: DataFrame, *keys: str) -> dict[str, list]:
    """Number of rows and sum of their hashes, of each key or of all."""
    hashed = F.sum(F.xxhash64(*rows.columns).cast("decimal(20,0)")).cast("string")
    found = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), hashed.alias("h")).collect()  # a row a day
    return {str(r[keys[0]]) if keys else "": [r.n, r.h] for r in found}


def publish(store: KpiStore, out: str) -> int:
    """Write the KPI tables for readers, as a new version that shows when it is complete; gives its number.

    Of tables by day only those days are written whose batches have changed since the last version; a day
    that has become empty goes. All users are kept by bucket: what came in since the last version is added as a generation, and the
    tables about users are read from the buckets without an exchange. New users are compared by day, and only days that differ are
    written; of the small tables only those that differ. ``read_published`` follows the versions, so readers never meet a half
    written table.
    """
    spark = store.spark
    version, before = _published(spark, out)
    users = _published_users(spark, store.path("first_seen"), out)
    users.refresh()
    first = users.folded()
    new = first.where(F.col("day").isNotNull()).select("bot_name", "day", "user_id")
    now: dict = {CLUSTERED: {"generations": users.state()[1].get("generations", [])}}
    for name, stored in DAILY.items():
        old = before.get(name, {"batches": [], "days": {}})
        kept, batches, of, marks = {}, [], {}, {}
        if stored:
            rows = getattr(store, name)()
            live = deltas.entries(spark, store.path(stored))
            batches = [[w, e.data, *e.masks] for w, e in live]
            changed = {d for w, e in live if [w, e.data, *e.masks] not in old["batches"] for d in e.days}
            changed |= {d for b in old["batches"] if b not in batches for d in old["of"].get(b[1], [])}
            of = {e.data: list(e.days) for _, e in live}
        else:
            rows, marks = new, _marks(new, "day")
            then = old.get("marks", {})
            changed = {d for d in marks.keys() | then.keys() if marks.get(d) != then.get(d)}
        kept = {d: at for d, at in old["days"].items() if d not in changed}
        days = dict(kept)
        if changed:
            rows = rows.where(F.col("day").isin([F.lit(d).cast("date") for d in sorted(changed)]))
            path = f"{out}/data/table={name}/version={version + 1}"
            rows.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(path)
            names = [s.getPath().getName() for s in deltas.listed(spark, path)]
            days |= {n.removeprefix("day="): version + 1 for n in names if n.startswith("day=")}
        now[name] = {"batches": batches, "days": days, "of": of, "marks": marks, "schema": rows.schema.jsonValue()}
    totals = {
        "bot_registry": lambda: first.select("bot_name").distinct(),
        "overall_totals": lambda: store.overall_totals(first),
        "overall_by_day": lambda: kpi.overall_of(store.pv_day(), store.users_day(), new),
    }
    for name in WHOLE:
        path = f"{out}/data/table={name}/version={version + 1}"
        totals.get(name, getattr(store, name))().hint("rebalance").write.mode("overwrite").parquet(path)
        mark, old = _marks(spark.read.parquet(path)), before.get(name, {})
        if old and old.get("mark") == mark:
            _delete(spark, path)
            now[name] = old
        else:
            now[name] = {"version": version + 1, "mark": mark}
    deltas.put_text(spark, f"{out}/_versions/{version + 1:012d}.json", json.dumps(now))
    return version + 1


def _delete(spark: SparkSession, path: str) -> None:
    hpath, fs = hadoop_path(spark, path)
    fs.delete(hpath, True)


def _days_of(spark: SparkSession, out: str, name: str, table: dict, some: set[str] | None = None) -> DataFrame:
    base, schema = f"{out}/data/table={name}", T.StructType.fromJson(table["schema"])
    paths = [f"{base}/version={at}/day={day}" for day, at in sorted(table["days"].items()) if some is None or day in some]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.fieldNames())


def read_published(spark: SparkSession, out: str, name: str, version: int | None = None) -> DataFrame:
    """A published table as its latest version has it, or the given one."""
    number, tables = _published(spark, out, version)
    if not number:
        raise FileNotFoundError(f"nothing is published in {out}")
    if name == CLUSTERED:
        users = _published_users(spark, "", out)
        return users.fold(users.rows(tables[name]["generations"])).select(*kpi.USER)
    if name in WHOLE:
        return spark.read.parquet(f"{out}/data/table={name}/version={tables[name]['version']}")
    return _days_of(spark, out, name, tables[name])


def changes(spark: SparkSession, out: str, name: str, older: int, newer: int) -> DataFrame:
    """The rows of a published table that two versions do not share, with ``change``: how many more the newer one has.

    Of tables by day only the folders are read that differ; where a table is the same file in both, nothing is. Rows of both
    are told apart by one sum over all columns.
    """
    tables = [_published(spark, out, v)[1][name] for v in (older, newer)]
    if name in DAILY:
        days = [t["days"] for t in tables]
        some = {d for d in days[0].keys() | days[1].keys() if days[0].get(d) != days[1].get(d)}
        sides = [_days_of(spark, out, name, t, some) for t in tables]
    else:
        sides = [read_published(spark, out, name, v) for v in (older, newer)]
        if tables[0] == tables[1]:
            sides = [s.limit(0) for s in sides]
    signed = [s.withColumn("change", F.lit(n).cast("long")) for s, n in zip(sides, (-1, 1))]
    total = signed[0].unionByName(signed[1]).groupBy(*sides[0].columns).agg(F.sum("change").alias("change"))
    return total.where(F.col("change") != 0)


def vacuum_published(spark: SparkSession, out: str, keep: int = 5) -> int:
    """Delete published versions but the last ones, and the files that none of these refers to; returns how many folders went."""
    found = deltas.versions(spark, f"{out}/_versions")
    for _, path in found[: -max(1, keep)]:
        _delete(spark, path)
    live: set[str] = set()
    for number, _ in found[-max(1, keep) :]:
        for name, table in _published(spark, out, number)[1].items():
            if name == CLUSTERED:
                live |= {f"users/data/generation={g}" for g in table["generations"]}
            elif name in WHOLE:
                live.add(f"data/table={name}/version={table['version']}")
            else:
                live |= {f"data/table={name}/version={at}/day={day}" for day, at in table["days"].items()}
    versions = {path.rsplit("/day=", 1)[0] for path in live}
    folders = [f"users/data/{s.getPath().getName()}" for s in deltas.listed(spark, f"{out}/users/data")]
    for table in deltas.listed(spark, f"{out}/data"):
        of = f"data/{table.getPath().getName()}"
        for one in deltas.listed(spark, f"{out}/{of}"):
            place = f"{of}/{one.getPath().getName()}"
            days = [f"{place}/{s.getPath().getName()}" for s in deltas.listed(spark, f"{out}/{place}")]
            folders += [d for d in days if "/day=" in d] if place in versions and place not in live else [place]
    gone = [f for f in folders if f not in live]
    for folder in gone:
        _delete(spark, f"{out}/{folder}")
    return len(gone)
