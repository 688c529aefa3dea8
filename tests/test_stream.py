"""Streams: the same as the batch, over several micro-batches, restarts and repeats."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from chatmeter.operators import kpi
from chatmeter.operators.clean import clean_events
from chatmeter.operators.generic import explode_words, word_count
from chatmeter.plans import jobs, stream_queries
from chatmeter.schema import WORD_COUNTS
from chatmeter.sources import deltas, testtables
from chatmeter.sources.readers import read_lines, stream_lines
from chatmeter.sources.sinks import to_console
from chatmeter.sources.store import KpiStore
from chatmeter.streaming import pipeline

D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


def log(bot, user, day, second=0, kind="REQ"):
    return f'2024-01-0{day} 10:00:{second:02d}\t{kind}\tx\t{{"bot_name":"{bot}","user_id":"{user}"}}'


FILES = [
    ("adult", [log("a", "u1", 2), log("a", "u2", 2), log("a", "u1", 2, 1), log("a", "u9", 1, kind="RESP")]),
    ("children", [log("a", "u1", 1), log("b", "u1", 2), log("a", "u3", 3), log("a", "u3", 2, 7)]),
    ("adult", [log("a", "u4", 1, 5), log("a", "u2", 3, 5), log("c", "trio_test", 3), "junk", log("b", "u1", 3)]),
]


@pytest.fixture
def feed(tmp_path):
    """Add files to the watched folder, each under its topic, in order of time."""
    added = []

    def add(files):
        for topic, lines in files:
            folder = tmp_path / "in" / f"topic=chatlog_{topic}"
            folder.mkdir(parents=True, exist_ok=True)
            path = folder / f"{len(added)}.txt"
            path.write_text("\n".join(lines) + "\n", encoding="utf-8")
            stamp = time.time() - 1000 + 10 * len(added)
            os.utime(path, (stamp, stamp))
            added.append(path)
        return str(tmp_path / "in")

    return add


def run(spark, folder, store, tmp_path, write=pipeline.write_all, **cleaning):
    lines = stream_lines(spark, folder, max_files=1)
    query = pipeline.start_kpis(
        lines, store, str(tmp_path / "checkpoint"), "logs", write, trigger=pipeline.ONCE, **cleaning
    )
    query.awaitTermination()
    return query


def state(store, rows):
    tables = ("pv_total", "pv_day", "users_total", "users_day", "new_users_day", "qps_bot", "qps_product", "bot_registry")
    return {name: rows(getattr(store, name)()) for name in tables}


def test_several_batches_give_the_batch_result(spark, feed, rows, tmp_path):
    store = KpiStore(spark, str(tmp_path / "store"))
    folder = feed(FILES)
    run(spark, folder, store, tmp_path)
    assert len(deltas.entries(spark, store.path("pv_day"))) == len(FILES)

    requests = clean_events(spark.read.text(folder))
    got = state(store, rows)
    assert got["pv_total"] == rows(kpi.pv_total(requests))
    assert got["pv_day"] == rows(kpi.pv_day(requests))
    assert got["users_total"] == rows(kpi.users_total(requests))
    assert got["users_day"] == rows(kpi.users_day(requests))
    assert got["qps_bot"] == rows(kpi.qps_bot(requests))
    assert got["qps_product"] == rows(kpi.qps_product(requests))
    assert got["bot_registry"] == [("a",), ("b",)]
    # First come, first kept: u1 of bot a came with the first batch, so day 2 although the second
    # batch has day 1. Within a batch the earliest day counts: u3 of bot a.
    assert got["new_users_day"] == [
        ("a", D1, "u4"), ("a", D2, "u1"), ("a", D2, "u2"), ("a", D2, "u3"), ("b", D2, "u1"),
    ]


def test_restart_goes_on_and_counts_nothing_twice(spark, feed, rows, tmp_path):
    store = KpiStore(spark, str(tmp_path / "store"))
    folder = feed(FILES[:1])
    run(spark, folder, store, tmp_path)
    before = state(store, rows)
    run(spark, folder, store, tmp_path)
    assert state(store, rows) == before
    feed(FILES[1:])
    run(spark, folder, store, tmp_path)
    assert rows(store.pv_total()) == rows(kpi.pv_total(clean_events(spark.read.text(folder))))


def test_a_batch_whose_commit_was_lost_is_replaced(spark, feed, rows, tmp_path):
    store = KpiStore(spark, str(tmp_path / "store"))
    folder = feed(FILES)
    run(spark, folder, store, tmp_path)
    before = state(store, rows)
    last = max((tmp_path / "checkpoint/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    run(spark, folder, store, tmp_path)
    assert state(store, rows) == before


def test_a_failed_batch_is_repeated_after_the_restart(spark, feed, rows, tmp_path):
    store = KpiStore(spark, str(tmp_path / "store"))
    folder = feed(FILES)

    def fails_half_way(store, requests, source, batch):
        pipeline.write_pv(store, requests, source, batch)
        if batch == 1:
            raise RuntimeError("lost")
        pipeline.write_qps(store, requests, source, batch)
        pipeline.write_users(store, requests, source, batch)

    with pytest.raises(Exception, match="lost"):
        run(spark, folder, store, tmp_path, fails_half_way)
    run(spark, folder, store, tmp_path)
    clean = KpiStore(spark, str(tmp_path / "clean"))
    (tmp_path / "other").mkdir()
    run(spark, folder, clean, tmp_path / "other")
    assert state(store, rows) == state(clean, rows)


def test_compaction_between_batches(spark, feed, rows, tmp_path):
    store = KpiStore(spark, str(tmp_path / "store"))
    folder = feed(FILES[:2])
    run(spark, folder, store, tmp_path)
    before = state(store, rows)
    store.compact("logs")
    store.vacuum(hours=0)
    assert state(store, rows) == before
    feed(FILES[2:])
    run(spark, folder, store, tmp_path)
    whole = KpiStore(spark, str(tmp_path / "whole"))
    (tmp_path / "other").mkdir()
    run(spark, folder, whole, tmp_path / "other")
    assert state(store, rows) == state(whole, rows)


def test_a_stream_compacts_its_own_batches(spark, feed, rows, tmp_path):
    store = KpiStore(spark, str(tmp_path / "store"))
    folder = feed(FILES)
    run(spark, folder, store, tmp_path, upkeep=2)
    assert sorted((e.first, e.last) for _, e in deltas.entries(spark, store.path("qps"))) == [(0, 1), (2, 2)]
    assert rows(store.pv_total()) == rows(kpi.pv_total(clean_events(spark.read.text(folder))))


def test_two_streams_share_the_bots(spark, feed, rows, tmp_path):
    store = KpiStore(spark, str(tmp_path / "store"))
    folder = feed(FILES)
    for product in ("adult", "children"):
        lines = stream_lines(spark, f"{folder}/topic=chatlog_{product}")
        query = pipeline.start_kpis(lines, store, str(tmp_path / product), product, trigger=pipeline.ONCE)
        query.awaitTermination()
    assert rows(store.pv_total()) == rows(kpi.pv_total(clean_events(spark.read.text(folder))))


def test_processing_time_stream_counts_on_its_own_day(spark, feed, rows, tmp_path):
    store = KpiStore(spark, str(tmp_path / "store"))
    options = pipeline.PROCESSING_TIME_CASE_SENSITIVE | {"as_of": "2024-05-05"}
    run(spark, feed(FILES), store, tmp_path, **options)
    assert {row[1] for row in rows(store.pv_day())} == {dt.date(2024, 5, 5)}
    assert ("a", dt.date(2024, 5, 5), "2024-01-02 10:00:00", 2) in rows(store.qps_bot())


def test_rollback_lets_a_stream_find_the_user_again(spark, feed, rows, tmp_path):
    store = KpiStore(spark, str(tmp_path / "store"))
    folder = feed(FILES[:1])
    run(spark, folder, store, tmp_path)
    jobs.rollback_day(store, "2024-01-02")
    assert rows(store.users_total()) == []
    feed([("adult", [log("a", "u2", 3)])])
    run(spark, folder, store, tmp_path)
    assert rows(store.new_users_day()) == [("a", D3, "u2")]
    assert rows(store.pv_total()) == [("a", 4)]


def test_state_store_users_of_a_day(spark, feed, rows, tmp_path):
    store = KpiStore(spark, str(tmp_path / "store"))
    folder = feed(FILES[:2])
    for _ in range(2):
        lines = stream_lines(spark, folder, max_files=1)
        query = pipeline.start_users_day(lines, store, str(tmp_path / "checkpoint"), "users", trigger=pipeline.ONCE)
        query.awaitTermination()
        got = rows(store.rows("users_day"))
        assert got == rows(kpi.users_day(clean_events(spark.read.text(folder))))
        feed(FILES)


def test_word_counts_are_per_batch(spark, rows, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, text in enumerate(["a b a\n", "a  b\n\n"]):
        (folder / f"{i}.txt").write_text(text)
        os.utime(folder / f"{i}.txt", (time.time() - 100 + i, time.time() - 100 + i))
    query = pipeline.start_word_count(
        stream_lines(spark, str(folder), max_files=1), str(tmp_path / "t"), str(tmp_path / "c"), trigger=pipeline.ONCE
    )
    query.awaitTermination()
    first = next(e for _, e in deltas.entries(spark, str(tmp_path / "t")) if e.first == 0)
    assert rows(spark.read.schema(WORD_COUNTS).parquet(str(tmp_path / f"t/data/batch={first.data}"))) == [("a", 2), ("b", 1)]
    everything = rows(deltas.read_deltas(spark, str(tmp_path / "t"), WORD_COUNTS))
    assert everything == [("", 2), ("a", 1), ("a", 2), ("b", 1), ("b", 1)]
    total = {w: n for w, n in rows(word_count(read_lines(spark, str(folder))))}
    assert total == {"": 2, "a": 3, "b": 2}


def test_console_output(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x y\n")
    writer = to_console(explode_words(stream_lines(spark, str(tmp_path))))
    query = writer.trigger(**pipeline.ONCE).start()
    query.awaitTermination()
    assert query.lastProgress is None or query.exception() is None


def test_a_stream_that_starts_anew_adds(spark, feed, tmp_path):
    """A fresh checkpoint numbers batches from 0 again: they are other batches, before a compaction and after."""
    store = KpiStore(spark, str(tmp_path / "kpi"))

    def start(number, lines):
        folder = tmp_path / f"in{number}" / "topic=chatlog_adult"
        folder.mkdir(parents=True)
        (folder / "0.txt").write_text("\n".join(lines) + "\n")
        source = stream_lines(spark, str(folder.parent), max_files=1)
        query = pipeline.start_kpis(source, store, str(tmp_path / f"c{number}"), "logs", trigger=pipeline.ONCE)
        query.awaitTermination()

    def pv():
        return {r.bot_name: r.pv for r in store.pv_total().collect()}

    start(1, [log("a", f"u{i}", 1) for i in range(10)])
    start(2, [log("a", f"u{i}", 2) for i in range(14)])
    assert pv() == {"a": 24}
    store.compact("logs")
    start(3, [log("a", "u1", 3), log("b", "u1", 3)])
    assert pv() == {"a": 25, "b": 1}
    assert {r.uv for r in kpi.uv_total(store.users_total()).collect() if r.bot_name == "a"} == {14}
    store.compact("logs", every=2)
    assert pv() == {"a": 25, "b": 1}
    with pytest.raises(ValueError):
        pipeline.start_kpis(stream_lines(spark, str(tmp_path / "in1")), store, str(tmp_path / "c4"), "a@b")


def test_users_of_days_within_a_watermark(spark, feed, tmp_path):
    """Late rows reach the table past the state; the state holds the days within the retention only."""
    store = KpiStore(spark, str(tmp_path / "kpi"))
    days = [[1, 2, 2], [8, 8, 9], [2, 3, 9], [9, 8, 1]]
    clock = F.lit("2024-01-10 00:00:00")
    for k, some in enumerate(days):
        folder = feed([("adult", [log("a", f"u{i % 2}", d) for i, d in enumerate(some)] + [log("hot", "u", some[-1])] * 500)])
        lines = stream_lines(spark, folder, max_files=1)
        query = pipeline.start_users_day(
            lines, store, str(tmp_path / "c"), "users", trigger=pipeline.ONCE, retention="3 days", clock=clock
        )
        query.awaitTermination()
    want = {("a", d, f"u{i % 2}") for some in days for i, d in enumerate(some)} | {("hot", some[-1], "u") for some in days}
    got = [(r.bot_name, r.day.day, r.user_id) for r in store.users_day().collect()]
    assert sorted(got) == sorted(want)
    state = query.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] <= len({w for w in want if w[1] >= 6})
    on_time = [(r.bot_name, r.day.day, r.user_id) for r in store.rows("users_day").collect() if r.day.day > 7]
    assert len(on_time) == len(set(on_time))  # those were written once in all


def test_parts_are_read_by_several_tasks(spark, tmp_path, monkeypatch):
    """A part comes in files of bounded size, so that its cleaning is not one task however large it is."""
    monkeypatch.setattr(testtables, "FILE_LINES", 1000, raising=False)
    events = spark.range(24_000).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ '2024-01-05 00:00:00' AS ts", "id % 900 AS user_id", "concat('b', id % 3) AS event_type"
    )
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    most, all_rows = [], []

    def write(store, requests, source, batch):
        by_task = [r["count"] for r in requests.groupBy(F.spark_partition_id()).count().collect()]
        most.append(max(by_task))
        all_rows.append(sum(by_task))
        pipeline.write_pv(store, requests, source, batch)

    store = stream_queries._run_in_parts(spark, str(tmp_path), "tasks", write)
    want = clean_events(testtables.log_lines(events)).count()
    assert len(most) == 8 and max(most) <= 1000
    assert sum(all_rows) == sum(r.pv for r in store.pv_total().collect()) == want
