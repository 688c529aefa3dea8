"""Clustered users and bitmaps: plans without an exchange of the stored rows, refreshes, corrections, hot bots."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from chatmeter.operators import kpi
from chatmeter.plans import jobs
from chatmeter.sources import bitmaps, clustered, deltas
from chatmeter.sources.store import KpiStore

D = [dt.date(2024, 1, d) for d in range(1, 32)]
T = dt.datetime(2024, 2, 1)


@pytest.fixture
def store(spark, tmp_path):
    return KpiStore(spark, str(tmp_path / "kpi"))


def first(spark, rows):
    return spark.createDataFrame([(b, u, D[d], T + dt.timedelta(hours=h)) for b, u, d, h in rows], "bot_name string, user_id string, day date, arrived timestamp")


def visits(spark, rows):
    return spark.createDataFrame([(b, D[d], u) for b, d, u in rows], "bot_name string, day date, user_id string")


def seen(users):
    return sorted((r.bot_name, r.user_id, r.day.day - 1) for r in users.folded().collect())


def plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_clustered_users_follow_the_store(spark, store):
    users = store.clustered_users(4)
    assert users.refresh() == 0 and users.folded().count() == 0
    store.append("first_seen", first(spark, [("a", "u1", 3, 5), ("b", "u1", 4, 5)]), "x", 0)
    store.append("first_seen", first(spark, [("a", "u1", 1, 6), ("a", "u2", 2, 6)]), "x", 1)
    assert users.refresh() == 1
    assert seen(users) == [("a", "u1", 3), ("a", "u2", 2), ("b", "u1", 4)]
    assert users.refresh() == 1  # nothing new: nothing written
    store.append("first_seen", first(spark, [("a", "u1", 0, 4), ("c", "u1", 9, 4)]), "y", 0)
    store.compact("x")  # what was seen lies in a wider entry now
    users.refresh()
    assert seen(users) == [("a", "u1", 0), ("a", "u2", 2), ("b", "u1", 4), ("c", "u1", 9)]
    assert len(users.state()[1]["generations"]) == 2
    assert seen(users) == sorted((r.bot_name, r.user_id, r.day.day - 1) for r in store.folded("first_seen").collect())


def test_corrections_reach_clustered_users(spark, store):
    users = store.clustered_users(4)
    store.append("first_seen", first(spark, [("a", "u1", 3, 5), ("b", "u1", 4, 5), ("b", "u2", 4, 5)]), "x", 0)
    users.refresh()
    jobs.purge_bots(store, ["b"])
    store.append("first_seen", first(spark, [("b", "u2", 7, 6)]), "x", 1)
    store.compact("x")  # carries the correction out, so that no entry shows it any more
    users.refresh()
    assert seen(users) == [("a", "u1", 3), ("b", "u2", 7)]
    jobs.rollback_day(store, "2024-01-04")
    users.refresh()
    assert seen(users) == [("b", "u2", 7)]
    store.append("first_seen", first(spark, [("a", "u1", 8, 9)]), "x", 2)
    users.refresh()
    assert seen(users) == [("a", "u1", 8), ("b", "u2", 7)]


def test_job_that_runs_again_makes_all_anew(spark, store):
    users = store.clustered_users(4)
    store.append("first_seen", first(spark, [("a", "u1", 3, 5)]), "load", kind="job")
    users.refresh()
    store.append("first_seen", first(spark, [("a", "u2", 3, 5)]), "load", kind="job")
    users.refresh()
    assert seen(users) == [("a", "u2", 3)]


def test_many_generations_become_one(spark, store, monkeypatch):
    monkeypatch.setattr(clustered, "MOST", 2)
    users = store.clustered_users(4)
    for k in range(5):
        store.append("first_seen", first(spark, [("a", f"u{k}", k, 5), ("a", "u", 9 - k, 5 - k)]), "x", k)
        users.refresh()
    assert len(users.state()[1]["generations"]) <= 3
    assert seen(users) == [("a", "u", 5), *(("a", f"u{k}", k) for k in range(5))]
    assert users.vacuum(hours=0) > 0
    assert seen(users) == [("a", "u", 5), *(("a", f"u{k}", k) for k in range(5))]
    again = KpiStore(spark, store.root).clustered_users()
    assert again.buckets == 4 and seen(again) == seen(users)


def test_stored_users_are_not_exchanged(spark, store, capsys):
    """Total UV exchanges counts, and telling new users exchanges the incoming ones, over several generations."""
    users = store.clustered_users(4)
    for k in range(3):
        store.append("first_seen", first(spark, [("a", f"u{i}", k, k) for i in range(50)]), "x", k)
        users.refresh()
    counted = plan(kpi.uv_total(users.folded()), capsys)
    assert counted.count("Exchange") == 1 and "hashpartitioning(bot_name#" in counted and "Bucketed: true" in counted
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, "-1")
        known = users.rows().distinct()
        new = plan(kpi.new_users(visits(spark, [("a", 3, "u1"), ("b", 3, "u1")]), known=known), capsys)
    finally:
        spark.conf.set(threshold, before)
    stored = re.search(r"FileScan parquet .*?\[bot_name#(\d+)", new)[1]
    assert "Bucketed: true" in new and f"Exchange hashpartitioning(bot_name#{stored}" not in new


@pytest.mark.parametrize("part", [500_000, 7])
def test_bitmaps_count_distinct_users(spark, store, monkeypatch, part):
    """A bot with most users, numbered in parts; users that come again; a repeated refresh; folded entries."""
    monkeypatch.setattr(bitmaps, "PART", part)
    bits = store.user_bits(4)
    assert bits.refresh() == 0 and bitmaps.uv(bits.bits(), "bot_name").count() == 0
    loads = [
        [("hot", d, f"u{i}") for d in range(3) for i in range(0, 90, d + 1)] + [("cold", 1, "u1"), (None, 1, "u1"), ("cold", 1, None)],
        [("hot", d, f"u{i}") for d in (2, 9) for i in range(40, 140)] + [("cold", 9, "u1"), ("new", 9, "u5")],
    ]
    kept = []
    for k, rows in enumerate(loads):
        kept += [r for r in rows if None not in r]
        store.append("users_day", visits(spark, rows), "x", k)
        bits.refresh()
        assert bits.refresh() == bits.numbers.state()[0]
    numbers = {}
    for r in bits.numbers.rows().collect():
        numbers.setdefault(r.bot_name, []).append(r.number)
    assert all(sorted(n) == list(range(1, len(n) + 1)) for n in numbers.values())  # dense, each once

    def want(a, b):
        return sorted((bot, len({u for x, d, u in kept if x == bot and a <= d <= b})) for bot in {x for x, d, _ in kept if a <= d <= b})

    for a, b in ((0, 30), (2, 9), (1, 1), (3, 8)):
        assert sorted(map(tuple, bitmaps.uv(bits.bits(str(D[a]), str(D[b])), "bot_name").collect())) == want(a, b)
    store.compact("x")
    bits.refresh()
    bits.compact()
    assert sorted(map(tuple, bitmaps.uv(bits.bits(), "bot_name").collect())) == want(0, 30)
    rolled = {(r.bot_name, r.day): r.uv for r in bitmaps.uv(bitmaps.rolling(bits.bits(), 3), "bot_name", "day").collect()}
    for end in range(10):
        for bot, uv in want(max(0, end - 2), end):
            assert rolled.pop((bot, D[end])) == uv
    assert not rolled


def test_more_than_one_bucket_of_bits(spark, store):
    users = spark.range(70_000).select(F.lit("a").alias("bot_name"), F.lit(D[0]).alias("day"), F.concat(F.lit("u"), "id").alias("user_id"))
    store.append("users_day", users.unionByName(users.withColumn("day", F.lit(D[1])).limit(10)), "x")
    bits = store.user_bits(4)
    bits.refresh()
    assert bits.bits().where(F.col("day") == D[0]).count() == 3
    assert bitmaps.uv(bits.bits(), "bot_name").collect()[0].uv == 70_000


def test_a_lost_refresh_is_made_good(spark, store, monkeypatch):
    """Numbers were committed, bitmaps not: the next refresh finds the numbers and writes the bits."""
    store.append("users_day", visits(spark, [("a", 1, "u1"), ("a", 2, "u2")]), "x")
    bits = store.user_bits(4)
    with monkeypatch.context() as m:
        m.setattr(deltas, "write_delta", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            bits.refresh()
    bits.refresh()
    assert bits.numbers.rows().count() == 2
    assert bitmaps.uv(bits.bits(), "bot_name").collect()[0].uv == 2
