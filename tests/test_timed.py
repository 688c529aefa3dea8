"""Answers, sessions, busiest spans and levels on hand-made lines: awkward times, hot keys, restarts, plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chatmeter.operators import timed
from chatmeter.operators.clean import clean_events
from chatmeter.sources.store import KpiStore
from chatmeter.streaming import pipeline
from chatmeter.streaming import timed as streams


def at(text):
    return dt.datetime.strptime(text, "%m-%d %H:%M:%S").replace(year=2024)


def line(bot, user, moment, kind="REQ"):
    return f'2024-{moment}\t{kind}\tx\t{{"bot_name":"{bot}","user_id":"{user}"}}'


def lines(spark, rows):
    return spark.createDataFrame([("chatlog_adult", line(*r)) for r in rows], "topic string, value string")


def test_times_of_lines(spark):
    texts = {
        "2024-04-08 01:02:03": dt.datetime(2024, 4, 8, 1, 2, 3),
        "2024-4-8 1:2:3": dt.datetime(2024, 4, 8, 1, 2, 3),
        "2024-4- 8 　 1:2:3": dt.datetime(2024, 4, 8, 1, 2, 3),
        "2024-04-08 01:02:61": dt.datetime(2024, 4, 8, 1, 2, 59),
        "x": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", timed.at_of(F.col("t")).alias("at"))
    assert {r.t: r["at"] for r in df.collect()} == texts


ROWS = [
    ("a", "u1", "01-01 10:00:00"),
    ("a", "u1", "01-01 10:00:00"),
    ("a", "u1", "01-01 10:00:20"),
    ("a", "u1", "01-01 10:00:30", "RESP"),
    ("a", "u1", "01-01 10:00:25", "RESP"),
    ("a", "u1", "01-01 10:00:31"),
    ("a", "u2", "01-01 10:00:31"),
    ("b", "u1", "01-01 23:59:50"),
    ("b", "u1", "01-02 00:00:20", "RESP"),
    ("b", "u2", "01-02 00:00:00"),
    ("b", "u2", "01-02 00:00:31", "RESP"),
    ("c", "u9", "01-02 00:00:31", "RESP"),
]
WANT = [
    ("a", "u1", "01-01 10:00:00", "01-01 10:00:25"),
    ("a", "u1", "01-01 10:00:20", "01-01 10:00:25"),
    ("a", "u1", "01-01 10:00:31", None),
    ("a", "u2", "01-01 10:00:31", None),
    ("b", "u1", "01-01 23:59:50", "01-02 00:00:20"),
    ("b", "u2", "01-02 00:00:00", None),
]


def test_first_response_within_the_span_answers(spark, rows):
    df = lines(spark, ROWS)
    found = timed.answers(timed.timed(df), timed.timed(df, timed.RESPONSE_KIND))
    want = [(b, u, at(t).date(), at(t), a and at(a)) for b, u, t, a in WANT]
    assert rows(found, "bot_name", "user_id", "day", "asked", "answered") == sorted(want, key=lambda w: [(v is not None, v) for v in w])
    summary = {(r.bot_name, r.day.day): (r.requests, r.answered, r.mean_seconds, r.most_seconds) for r in timed.answer_summary(found).collect()}
    assert summary == {("a", 1): (4, 2, 15.0, 25), ("b", 1): (1, 1, 30.0, 30), ("b", 2): (1, 0, None, None)}


def feed(spark, tmp_path, parts, start, **options):
    """Each part read by a new query from the same checkpoint; the last one moves the watermark past all others."""
    store = KpiStore(spark, str(tmp_path / "kpi"))
    for k, part in enumerate([*parts, [("z", "z", "01-20 00:00:00"), ("z", "z", "01-20 00:00:00", "RESP")]]):
        lines(spark, part).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema("topic string, value string").parquet(str(tmp_path / "in"))
        start(source, store, str(tmp_path / "c"), "s", trigger=pipeline.ONCE, **options).awaitTermination()
    return store


def test_stream_of_answers_reports_each_request(spark, tmp_path):
    """Answers that come in a later batch than the request, and one that comes first; the unanswered once each."""
    parts = [ROWS[4:7] + ROWS[:1], ROWS[1:4], ROWS[7:]]
    store = feed(spark, tmp_path, parts, streams.start_answers, delay="1 day")
    got = [r for r in store.folded("answers").collect() if r.bot_name != "z"]
    want = [(b, u, at(t), a and at(a)) for b, u, t, a in WANT]
    assert sorted((r.bot_name, r.user_id, r.asked, str(r.answered)) for r in got) == sorted((b, u, t, str(a)) for b, u, t, a in want)
    raw = [r for r in store.rows("answers").collect() if r.answered is None and r.bot_name != "z"]
    assert len(raw) == 3


def plain_sessions(rows, gap):
    out, users = [], {}
    for bot, user, t, *_ in rows:
        users.setdefault((bot, user), []).append(at(t))
    for (bot, user), times in users.items():
        run = []
        for t in sorted(times):
            if run and t > run[-1] + dt.timedelta(seconds=gap):
                out.append((bot, user, run[0].date(), run[0], run[-1], len(run)))
                run = []
            run.append(t)
        out.append((bot, user, run[0].date(), run[0], run[-1], len(run)))
    return sorted(out)


CHATS = [("a", f"u{i % 3}", f"01-0{1 + i % 4} {(i * 7) % 24:02d}:{(i * 13) % 60:02d}:{(i * 29) % 60:02d}") for i in range(300)]
CHATS += [("a", "hot", f"01-01 23:{50 + i // 60}:{i % 60:02d}") for i in range(0, 600, 20)] + [("a", "hot", f"01-02 00:00:{i:02d}") for i in range(10)] * 50


def test_sessions_in_batch_and_stream(spark, tmp_path):
    names = ["bot_name", "user_id", "day", "started", "ended", "requests"]
    want = plain_sessions(CHATS, 1800)
    batch = timed.sessions(timed.timed(lines(spark, CHATS)), "30 minutes")
    assert sorted(tuple(r[n] for n in names) for r in batch.collect()) == want
    assert any(s[1] == "hot" and s[3].day != s[4].day for s in want)  # over midnight
    store = feed(spark, tmp_path, [CHATS[k::3] for k in range(3)], streams.start_sessions, gap="30 minutes", delay="5 days")
    assert sorted(tuple(r[n] for n in names) for r in store.rows("sessions").collect() if r.bot_name != "z") == want


@pytest.mark.parametrize("span", [1, 7, 60, 3600])
def test_busiest_spans_reach_over_hours_and_days(spark, span):
    edge = [("e", "u", t) for t in ("01-01 09:59:58", "01-01 09:59:59", "01-01 10:00:01", "01-01 23:59:58", "01-02 00:00:03", "01-02 00:59:59")]
    found = timed.busiest(timed.timed(lines(spark, CHATS + edge * 2)), "bot_name", span)
    want = []
    for bot in ("a", "e"):
        times = sorted(at(t) for b, _, t in CHATS + edge * 2 if b == bot)
        best = {}
        for t in sorted(set(times)):
            n = sum(0 <= (x - t).total_seconds() < span for x in times)
            if n > best.get(t.date(), (0, None))[0]:
                best[t.date()] = (n, t)
        want += [(bot, d, n, t) for d, (n, t) in best.items()]
    assert sorted(tuple(r[n] for n in ("bot_name", "day", "requests", "started")) for r in found.collect()) == sorted(want)
    with pytest.raises(ValueError):
        timed.busiest(timed.timed(lines(spark, edge)), "bot_name", 3601)


def test_levels_with_a_hot_bot_and_missing_products(spark):
    df = clean_events(lines(spark, CHATS + [("b", "u1", "01-01 00:00:00")])).unionByName(
        clean_events(spark.createDataFrame([(line("b", "u1", "01-01 00:00:00"),)], "value string"))
    )
    kept = [(r.product, r.bot_name, r.day, r.user_id) for r in df.collect()]
    got = {(r.level, r.product, r.bot_name, r.day): (r.pv, r.uv) for r in timed.all_levels(df).collect()}
    want = {}
    for level in range(8):
        shown = [i for i in range(3) if not level >> (2 - i) & 1]
        for k in kept:
            key = (level, *(k[i] if i in shown else None for i in range(3)))
            pv, users = want.setdefault(key, [0, set()])
            want[key] = [pv + 1, users | {(k[1], k[3])}]
    assert got == {k: (pv, len(users)) for k, (pv, users) in want.items()}


def test_plans_keep_days_apart(spark, capsys):
    """The window is by hour of a key, the answers' join by user and span, and nothing runs Python."""
    df = lines(spark, ROWS)
    capsys.readouterr()
    timed.busiest(timed.timed(df), "bot_name").explain()
    timed.answers(timed.timed(df), timed.timed(df, timed.RESPONSE_KIND)).explain()
    timed.all_levels(clean_events(df)).explain()
    timed.sessions(timed.timed(df)).explain()
    plans = capsys.readouterr().out
    assert "hashpartitioning(bot_name" in plans and ", hour#" in plans and ", span#" in plans
    for node in ("EvalPython", "MapIn", "FlatMapGroups", "CartesianProduct", "NestedLoop", "SinglePartition"):
        assert node not in plans


def test_stream_of_answers_keeps_a_row_for_each_time_asked(spark, tmp_path, rows):
    """A user's repeated lines are one in the state and in the table, and lines of other times do not meet."""
    hot = [("a", "hot", f"01-01 10:{i // 60:02d}:{i % 60:02d}", kind) for i in range(0, 240, 4) for kind in ("REQ", "RESP")] * 5
    store = feed(spark, tmp_path, [hot, hot + ROWS], streams.start_answers, delay="1 day")
    df = lines(spark, hot + ROWS)
    want = timed.answers(timed.timed(df), timed.timed(df, timed.RESPONSE_KIND))
    names = ("bot_name", "user_id", "day", "asked", "answered")
    assert rows(store.rows("answers").where("bot_name <> 'z'"), *names) == rows(want, *names)


def test_a_response_within_the_delay_still_answers_a_request_of_the_span_before(spark, tmp_path):
    """The watermark is past the span of the request, and not yet past the time of its response; a later response finds it closed."""
    ends = [("y", "y", "01-01 10:10:40"), ("y", "y", "01-01 10:10:40", "RESP")]
    parts = [[("a", "u", "01-01 10:00:29"), ("a", "v", "01-01 10:00:29"), *ends], [("a", "u", "01-01 10:00:45", "RESP")]]
    parts += [[(b, u, t.replace("10:10:", "10:12:"), *kind) for b, u, t, *kind in ends], [("a", "v", "01-01 10:00:45", "RESP")]]
    store = feed(spark, tmp_path, parts, streams.start_answers, delay="10 minutes")
    got = {(r.user_id, r.answered) for r in store.rows("answers").where("bot_name = 'a'").collect()}
    assert got == {("u", at("01-01 10:00:45")), ("v", None)}
    odd = feed(spark, tmp_path / "odd", parts[:2], streams.start_answers, delay="600 seconds")
    assert {(r.user_id, r.answered) for r in odd.rows("answers").where("bot_name = 'a'").collect()} == got
