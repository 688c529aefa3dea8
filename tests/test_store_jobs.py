"""Delta tables, backfill jobs and corrections of a store."""

import datetime as dt
import json
import pathlib

import pytest

from chatmeter import session
from chatmeter.operators import maintain
from chatmeter.plans import jobs
from chatmeter.schema import PV_DAY, PV_TOTAL, QPS_DELTA
from chatmeter.sources import deltas
from chatmeter.sources.store import KpiStore

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def pv(spark, *data):
    return spark.createDataFrame(data, PV_TOTAL)


def log(bot, user, day="2024-01-01", time="10:00:00"):
    return f'{day} {time}\tREQ\tx\t{{"bot_name":"{bot}","user_id":"{user}"}}'


@pytest.fixture
def store(spark, tmp_path):
    return KpiStore(spark, str(tmp_path / "store"))


@pytest.fixture
def write(tmp_path):
    def to_file(name, *lines):
        path = tmp_path / name
        path.write_text("\n".join(lines) + "\n", encoding="utf-8")
        return str(path)

    return to_file


# --- delta tables -------------------------------------------------------------------------------


def test_unwritten_table_is_empty(store, rows):
    assert rows(store.pv_total()) == [] and rows(store.users_total()) == []


def test_batches_add_up_and_a_repeated_batch_replaces_itself(spark, store, rows):
    store.append("pv_total", pv(spark, ("a", 1), ("b", 1)), "s", 0)
    store.append("pv_total", pv(spark, ("a", 2)), "s", 1)
    store.append("pv_total", pv(spark, ("a", 2)), "s", 1)
    store.append("pv_total", pv(spark, ("a", 10)), "t", 1)
    assert rows(store.pv_total()) == [("a", 13), ("b", 1)]


def spans(spark, store, table):
    """(writer, first, last) of what counts."""
    return sorted((w, e.first, e.last) for w, e in deltas.entries(spark, store.path(table)))


def test_compaction_changes_nothing_but_the_folders(spark, store, rows):
    for batch in range(4):
        store.append("pv_total", pv(spark, ("a", 1), ("b", batch)), "s", batch)
    store.append("pv_total", pv(spark, ("a", 100)), "t", 0)
    want = rows(store.pv_total())
    store.compact("s")
    assert spans(spark, store, "pv_total") == [("stream=s", 0, 3), ("stream=t", 0, 0)]
    assert rows(store.pv_total()) == want
    store.append("pv_total", pv(spark, ("a", 50)), "s", 3)  # repeated, and folded already
    store.append("pv_total", pv(spark, ("c", 5)), "s", 4)
    assert rows(store.pv_total()) == want + [("c", 5)]
    assert store.vacuum() == 0 and store.vacuum(hours=0) == 4
    assert rows(store.pv_total()) == want + [("c", 5)]
    store.compact("s")
    store.compact("s")
    assert spans(spark, store, "pv_total") == [("stream=s", 0, 4), ("stream=t", 0, 0)]
    assert rows(store.pv_total()) == want + [("c", 5)]


def test_compaction_by_levels_keeps_few_entries(spark, store, rows):
    for batch in range(14):
        store.append("pv_total", pv(spark, ("a", 1)), "s", batch)
        store.compact("s", every=3)
    assert spans(spark, store, "pv_total") == [("stream=s", 0, 8), ("stream=s", 9, 11), ("stream=s", 12, 12), ("stream=s", 13, 13)]
    assert rows(store.pv_total()) == [("a", 14)]


def test_a_reader_opens_one_log_file_however_many_batches_there_were(spark, store, rows, tmp_path):
    version, entry = 10_000, [{"first": 0, "last": 9_999, "data": "x", "days": [], "arrived": None, "masks": []}]
    log = tmp_path / "store/pv_total/_log/stream=s"
    log.mkdir(parents=True)
    (log / f"{version:012d}.json").write_text(json.dumps(entry))
    pv(spark, ("a", 10_000)).write.parquet(str(tmp_path / "store/pv_total/data/batch=x"))
    for batch in range(10_000, 10_020):
        store.append("pv_total", pv(spark, ("a", 1)), "s", batch)
    assert rows(store.pv_total()) == [("a", 10_020)]
    assert len(list(log.glob("*.json"))) <= 6


def test_an_unfinished_batch_is_not_read_and_no_marker_file_is_needed(spark, store, rows, tmp_path):
    store.append("pv_total", pv(spark, ("a", 1)), "s", 0)
    pv(spark, ("a", 2)).write.parquet(str(tmp_path / "store/pv_total/data/batch=lost"))
    for marker in (tmp_path / "store").rglob("*_SUCCESS*"):
        marker.unlink()
    assert rows(store.pv_total()) == [("a", 1)]


def test_a_job_and_a_stream_of_one_name_are_kept_apart(spark, store, write, rows):
    store.append("pv_total", pv(spark, ("b", 100)), "adult", 0)
    jobs.backfill_days(store, write("a.log", log("b", "u1")), "adult")
    assert rows(store.pv_total()) == [("b", 101)]


def test_a_small_batch_is_one_file_a_table(spark, store, tmp_path):
    seconds = spark.createDataFrame([("x", f"b{i}", D1, "t", 1) for i in range(40)], QPS_DELTA).repartition(50)
    store.append("qps", seconds, "s", 0)
    store.append("pv_total", seconds.groupBy("bot_name").agg({"requests": "sum"}).toDF("bot_name", "pv"), "s", 0)
    assert len(list((tmp_path / "store/qps").rglob("part-*.parquet"))) == 1
    assert len(list((tmp_path / "store/pv_total").rglob("part-*.parquet"))) == 1


def test_source_names_are_checked(spark, store):
    with pytest.raises(ValueError):
        store.append("pv_total", pv(spark, ("a", 1)), "a/b", 0)


def test_set_history_overwrites_the_bots_it_names(spark, store, rows):
    store.append("pv_history", pv(spark, ("a", 1), ("b", 2)), "s", 0)
    store.append("pv_history", pv(spark, ("b", 3)), "s", 1)
    for _ in range(2):
        store.set_history(pv(spark, ("b", 50), ("c", 7)), "extract")
        assert rows(store.pv_history()) == [("a", 1), ("b", 50), ("c", 7)]


# --- backfills ----------------------------------------------------------------------------------


def test_backfill_of_days(store, write, rows):
    path = write("a.log", log("b", " u1 "), log("b", "u1", "2024-01-02"), log("b", "u2", "2024-01-02"), "junk")
    for _ in range(2):
        jobs.backfill_days(store, path, "first", arrived="2024-02-01 00:00:00")
        assert rows(store.pv_total()) == [("b", 3)]
        assert rows(store.new_users_day()) == [("b", D1, "u1"), ("b", D2, "u2")]
        assert rows(store.users_total()) == [("b", "u1"), ("b", "u2")]
    later = write("b.log", log("b", "u1", "2024-01-01"), log("b", "u3", "2024-01-02"), log("b", "u2", "2024-01-01"))
    jobs.backfill_days(store, later, "second", arrived="2024-02-02 00:00:00")
    # u2 was seen before on the 2nd and stays there, though this file has an earlier day.
    assert rows(store.new_users_day()) == [("b", D1, "u1"), ("b", D2, "u2"), ("b", D2, "u3")]
    assert rows(store.pv_total()) == [("b", 6)]
    assert rows(store.bot_registry()) == [("b",)]


def test_backfill_of_totals_makes_users_known_but_not_new(store, write, rows):
    jobs.backfill_totals(store, write("a.log", log("b", "u1")), "totals", arrived="2024-02-01 00:00:00")
    jobs.backfill_days(store, write("b.log", log("b", "u1"), log("b", "u2")), "days", arrived="2024-02-02 00:00:00")
    assert rows(store.users_total()) == [("b", "u1"), ("b", "u2")]
    assert rows(store.new_users_day()) == [("b", D1, "u2")]
    assert rows(store.pv_total()) == [("b", 3)]
    assert rows(store.pv_day()) == []


def test_backfill_of_pv_fills_live_and_history(store, write, rows):
    jobs.backfill_pv(store, write("a.log", log("b", "u1", "no", "time"), log("b", "Monitor1"), log("c", "u1")), "pv")
    assert rows(store.pv_total()) == rows(store.pv_history()) == [("b", 1), ("c", 1)]
    assert rows(store.users_total()) == []


def test_history_from_an_extracted_file_and_its_merge(spark, store, write, rows):
    store.append("pv_history", pv(spark, ("a", 9), ("z", 4)), "old")
    store.append("pv_total", pv(spark, ("a", 1)), "stream")
    jobs.rebuild_history(store, write("x.tsv", "1\ta", "2\ta", "3\tb"), "extract")
    assert rows(store.pv_history()) == [("a", 2), ("b", 1), ("z", 4)]
    for _ in range(2):
        jobs.merge_history(store)
        assert rows(store.pv_total()) == [("a", 3), ("b", 1), ("z", 4)]


def test_backfill_of_a_folder_of_files(store, write, rows, tmp_path):
    write("part-1.log", log("b", "u1"))
    write("part-2.log", log("b", "u2"))
    jobs.backfill_days(store, str(tmp_path / "*.log"), "folder")
    assert rows(store.pv_total()) == [("b", 2)]


# --- corrections --------------------------------------------------------------------------------


def test_rolled_back_users_can_be_new_again(spark, store, write, rows):
    path = write("a.log", log("a", "u1"), log("a", "u2", "2024-01-02"), log("b", "u2", "2024-01-02"))
    jobs.backfill_days(store, path, "first", arrived="2024-02-01 00:00:00")
    jobs.rollback_day(store, "2024-01-02", spark.createDataFrame([("b",)], "bot_name string"))
    assert rows(store.users_total()) == [("a", "u1"), ("a", "u2")]
    for _ in range(2):
        jobs.rollback_day(store, "2024-01-02")
        assert rows(store.users_total()) == rows(store.new_users_day(), "bot_name", "user_id") == [("a", "u1")]
    assert rows(store.pv_total()) == [("a", 2), ("b", 1)]
    jobs.backfill_days(store, write("b.log", log("a", "u2", "2024-01-01")), "later", arrived="2024-02-03 00:00:00")
    assert rows(store.new_users_day()) == [("a", D1, "u1"), ("a", D1, "u2")]


def test_purges(store, write, rows):
    jobs.backfill_days(store, write("a.log", log("a", "u1"), log("b", "u2")), "first")
    jobs.purge_pv(store, [])
    assert rows(store.pv_total()) == [("a", 1), ("b", 1)]
    jobs.purge_bots(store, ["b"])
    jobs.purge_pv(store, ["a"])
    assert rows(store.users_total()) == [("a", "u1")]
    assert rows(store.pv_total()) == [("b", 1)]


@pytest.mark.parametrize("compacted", [False, True])
def test_repeats_after_a_correction_change_nothing(spark, store, write, rows, compacted):
    path = write("a.log", log("a", "u1"), log("a", "u2", "2024-01-02"), log("b", "u3"))
    later = write("b.log", log("a", "u2"), log("b", "u4"))
    history = write("x.tsv", "1\ta", "2\tb", "3\tb")
    stream = [pv(spark, ("a", 10)), pv(spark, ("b", 5))]

    def work():
        jobs.backfill_days(store, path, "first")
        jobs.backfill_days(store, later, "second")
        jobs.rebuild_history(store, history, "extract")
        jobs.merge_history(store)
        store.append("pv_total", stream[1], "live", 1)

    def state():
        return [rows(t) for t in (store.pv_total(), store.pv_history(), store.users_total(), store.new_users_day())]

    store.append("pv_total", stream[0], "live", 0)
    work()
    for correct in (
        lambda: jobs.purge_pv(store, ["a"]),
        lambda: jobs.rollback_day(store, "2024-01-02"),
        lambda: jobs.purge_bots(store, ["b"]),
    ):
        correct()
        if compacted:
            store.compact("live")
            store.compact("first", "job")
            store.vacuum(hours=0)
        want = state()
        work()
        assert state() == want
    assert want == [[("b", 9)], [("a", 1), ("b", 2)], [("a", "u1")], [("a", D1, "u1")]]


def test_repeating_a_backfill_moves_no_first_day(store, write, rows):
    first, second = write("a.log", log("a", "u1", "2024-01-02")), write("b.log", log("a", "u1", "2024-01-01"))
    jobs.backfill_days(store, first, "a")
    jobs.backfill_days(store, second, "b")
    jobs.backfill_days(store, first, "a")
    assert rows(store.new_users_day()) == [("a", D2, "u1")]


def test_of_batches_that_arrive_together_the_earliest_day_counts(store, write, rows):
    for name, day in (("a", "2024-01-02"), ("b", "2024-01-01")):
        jobs.backfill_days(store, write(name, log("a", "u1", day)), name, arrived="2024-02-01 00:00:00")
    assert rows(store.new_users_day()) == [("a", D1, "u1")]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_publish_writes_new_versions_of_what_changed(spark, store, write, rows, tmp_path, mode):
    requests = [("a", D1, 3), ("b", D2, 4)]
    out = str(tmp_path / "published")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        jobs.backfill_days(store, write("a.log", log("a", "u1"), log("a", "u2", "2024-01-02")), "first")
        for batch, row in enumerate(requests):
            store.append("pv_day", spark.createDataFrame([row], PV_DAY), "live", batch)
        jobs.publish(store, out)
        assert rows(jobs.read_published(spark, out, "pv_day")) == requests
        jobs.rollback_day(store, "2024-01-02")
        store.append("pv_day", spark.createDataFrame([("a", D2, 1)], PV_DAY), "live", 2)
        jobs.publish(store, out)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    # The emptied day is gone, the untouched day was not written again, and nothing else is lost.
    new = jobs.read_published(spark, out, "new_users_day")
    assert rows(new, "bot_name", "day", "user_id") == rows(store.new_users_day()) == [("a", D1, "u1")]
    assert rows(jobs.read_published(spark, out, "pv_day")) == rows(store.pv_day()) == [("a", D1, 3), ("a", D2, 1), ("b", D2, 4)]
    assert {p.name for p in (tmp_path / "published/data/table=pv_day/version=2").glob("day=*")} == {"day=2024-01-02"}
    assert rows(jobs.read_published(spark, out, "pv_total")) == [("a", 2)]
    assert rows(jobs.read_published(spark, out, "users_day")) == []
    assert rows(jobs.read_published(spark, out, "overall_totals")) == [(2, 1)]


def test_a_rollback_reads_one_day_of_the_published_table(spark, store, write, tmp_path, capsys):
    jobs.backfill_days(store, write("a.log", log("a", "u1"), log("a", "u2", "2024-01-02")), "first")
    jobs.publish(store, str(tmp_path / "published"))
    new = jobs.read_published(spark, str(tmp_path / "published"), "new_users_day")
    maintain.users_to_roll_back(new, "2024-01-02").explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(day" in plan and "= 2024-01-02)]" in plan


def test_jobs_leave_no_scratch_tables(spark, store, write, monkeypatch):
    made = []
    monkeypatch.setattr(session, "scratch_dir", lambda *a, f=session.scratch_dir: made.append(f(*a)) or made[-1])
    jobs.backfill_days(store, write("a.log", log("a", "u1")), "first")
    assert made and not any(pathlib.Path(p).exists() for p in made)


def test_a_backfill_scans_its_text_once(spark, store, write, monkeypatch):
    """Page views and users are both filled from the one scratch table."""
    scans = []
    read = jobs.read_lines
    monkeypatch.setattr(jobs, "read_lines", lambda *args: scans.append(args) or read(*args))
    seen = []
    append = KpiStore.append

    def note(self, table, df, *rest, **more):
        seen.append((table, [path for path in df.inputFiles() if path.endswith(".log")]))
        append(self, table, df, *rest, **more)

    monkeypatch.setattr(KpiStore, "append", note)
    jobs.backfill_days(store, write("a.log", log("a", "u1")), "first")
    assert len(scans) == 1
    assert seen == [("first_seen", []), ("pv_total", [])]


def test_unchanged_tables_are_not_published_again(spark, store, write, rows, tmp_path):
    out = str(tmp_path / "published")
    jobs.backfill_days(store, write("first.log", log("a", "u1"), log("b", "u2", "2024-01-02")), "first")
    for version in (1, 2, 3):
        assert jobs.publish(store, out) == version
    folders = {p.name for p in (tmp_path / "published/data").glob("*/*")}
    assert folders == {"version=1"}
    assert len(list((tmp_path / "published/users/data").glob("generation=*"))) == 1
    jobs.backfill_days(store, write("second.log", log("a", "u1"), log("a", "u3", "2024-01-03")), "second")
    assert jobs.publish(store, out) == 4
    new = jobs.changes(spark, out, "new_users_day", 3, 4)
    assert [(r.bot_name, r.user_id, r.change) for r in new.collect()] == [("a", "u3", 1)]
    assert {p.name for p in (tmp_path / "published/data/table=new_users_day/version=4").glob("day=*")} == {"day=2024-01-03"}
    assert jobs.changes(spark, out, "pv_history", 1, 4).count() == 0
    assert sorted((r.pv, r.change) for r in jobs.changes(spark, out, "pv_total", 1, 4).where("bot_name = 'a'").collect()) == [(1, -1), (3, 1)]
    assert jobs.vacuum_published(spark, out, keep=1) > 0
    assert rows(jobs.read_published(spark, out, "users_total")) == [("a", "u1"), ("a", "u3"), ("b", "u2")]
    assert rows(jobs.read_published(spark, out, "pv_total")) == rows(store.pv_total())
