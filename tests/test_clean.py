"""Cleaning rules, line by line, in the three strictnesses."""

import datetime as dt
import json
import random
import time

import pytest

from chatmeter.functions.text import WHITESPACE
from chatmeter.operators.clean import clean_events
from chatmeter.schema import LINES

T = "2019-04-28 10:00:00"
DAY = dt.date(2019, 4, 28)
OK = '{"bot_name":"b","user_id":"u"}'


def line(payload=OK, time=T, kind="REQ", tail=""):
    return f"{time}\t{kind}\tx\t{payload}{tail}"


def user(value):
    return line('{"bot_name":"b","user_id":%s}' % value)


def bot(value):
    return line('{"bot_name":%s,"user_id":"u"}' % value)


# name -> (line, levels that keep it, kept (bot, user), kept day under the strict rule)
# Levels: A = strict, B = no time check, C = no time check and case-sensitive.
KEEP, DROP, LOOSE, CASE = "ABC", "", "BC", "C"
CASES = {
    "plain": (line(), KEEP, ("b", "u"), DAY),
    "fifth field": (line(tail="\ty\tz"), KEEP, ("b", "u"), DAY),
    "three fields": (f"{T}\tREQ\tx", DROP),
    "empty": ("", DROP),
    "response": (line(kind="RESP"), DROP),
    "kind with a blank": (line(kind="REQ "), DROP),
    "kind in lower case": (line(kind="req"), DROP),
    "time in blanks": (line(time=f" {T} "), KEEP, ("b", "u"), DAY),
    "time in no-break spaces": (line(time=f" {T} "), KEEP, ("b", "u"), DAY),
    "one-digit parts": (line(time="2019-4-8 1:2:3"), KEEP, ("b", "u"), dt.date(2019, 4, 8)),
    "blank before the day": (line(time="2019-04- 8 01:02:03"), KEEP, ("b", "u"), dt.date(2019, 4, 8)),
    "two blanks": (line(time="2019-04-28  10:00:00"), KEEP, ("b", "u"), DAY),
    "no-break space inside": (line(time="2019-04-28 10:00:00"), KEEP, ("b", "u"), DAY),
    "second 60": (line(time="2019-04-28 10:00:60"), KEEP, ("b", "u"), DAY),
    "second 61": (line(time="2019-04-28 23:59:61"), KEEP, ("b", "u"), DAY),
    "second 62": (line(time="2019-04-28 10:00:62"), LOOSE, ("b", "u"), None),
    "minute 60": (line(time="2019-04-28 10:60:00"), LOOSE, ("b", "u"), None),
    "30 February": (line(time="2019-02-30 10:00:00"), LOOSE, ("b", "u"), None),
    "leap day": (line(time="2020-02-29 10:00:00"), KEEP, ("b", "u"), dt.date(2020, 2, 29)),
    "no leap day": (line(time="2019-02-29 10:00:00"), LOOSE, ("b", "u"), None),
    "month 13": (line(time="2019-13-01 10:00:00"), LOOSE, ("b", "u"), None),
    "month 00": (line(time="2019-00-01 10:00:00"), LOOSE, ("b", "u"), None),
    "year 0": (line(time="0000-01-01 10:00:00"), LOOSE, ("b", "u"), None),
    "two-digit year": (line(time="19-04-28 10:00:00"), LOOSE, ("b", "u"), None),
    "hour 24": (line(time="2019-04-28 24:00:00"), LOOSE, ("b", "u"), None),
    "date only": (line(time="2019-04-28"), LOOSE, ("b", "u"), None),
    "fraction": (line(time=f"{T}.5"), LOOSE, ("b", "u"), None),
    "T between": (line(time="2019-04-28T10:00:00"), LOOSE, ("b", "u"), None),
    "empty time": (line(time=""), LOOSE, ("b", "u"), None),
    **{
        f"user {value}": (user(value), DROP)
        for value in ("0", "-0", "0.0", "-0.0", "0e5", "0.00", "0E+3", "1e-400", "false", "null", '""', "[]", "[ ]", "{}", "{ }")
    },
    **{
        f"bot {value}": (bot(value), DROP)
        for value in ("0", "0.0", "false", "null", '""', "[]", "{}")
    },
    **{
        f"user text {value!r}": (user(f'"{value}"'), KEEP, ("b", value), DAY)
        for value in ("0", "-0", "0.0", "-0.0", "false", "null", " ", "[]", "{}", "00", "test", "mon itor")
    },
    "user number": (user("12"), KEEP, ("b", "12"), DAY),
    "user true": (user("true"), KEEP, ("b", "true"), DAY),
    "user list": (user("[1]"), KEEP, ("b", "[1]"), DAY),
    "user object": (user('{"a":0}'), KEEP, ("b", '{"a":0}'), DAY),
    "bot number": (bot("7"), KEEP, ("7", "u"), DAY),
    "bot text 0": (bot('"0"'), KEEP, ("0", "u"), DAY),
    "no bot": (line('{"user_id":"u"}'), DROP),
    "no user": (line('{"bot_name":"b"}'), DROP),
    "empty object": (line("{}"), DROP),
    "test user": (user('"a_trio_test_1"'), DROP),
    "monitor": (user('"monitor"'), DROP),
    "test user in capitals": (user('"aTRIO_Test1"'), CASE, ("b", "aTRIO_Test1"), None),
    "monitor in capitals": (user('"MONITOR"'), CASE, ("b", "MONITOR"), None),
    "monitor inside a list": (user('["monitor"]'), DROP),
    "two bots": (line('{"bot_name":"a","bot_name":"b","user_id":"u"}'), KEEP, ("b", "u"), DAY),
    "two users, last one 0": (line('{"bot_name":"b","user_id":"u","user_id":0}'), DROP),
    "two users, first one 0": (line('{"bot_name":"b","user_id":0,"user_id":"u"}'), KEEP, ("b", "u"), DAY),
    "single quotes": (line("{'bot_name':'b','user_id':'u'}"), DROP),
    "open brace": (line("{"), DROP),
    "no JSON": (line(""), DROP),
    "bare text": (line("bad"), DROP),
    "missing brace": (line('{"bot_name":"b","user_id":"u"'), DROP),
    "trailing comma": (line('{"bot_name":"b","user_id":"u",}'), DROP),
    "comment": (line('{"bot_name":"b",/*c*/"user_id":"u"}'), DROP),
    "list": (line("[1]"), DROP),
    "list of objects": (line(f"[{OK}]"), DROP),
    "number": (line("5"), DROP),
    "null": (line("null"), DROP),
    "JSON in blanks": (line(f"  {OK} "), KEEP, ("b", "u"), DAY),
    "JSON then no-break space": (line(f"{OK} "), DROP),
    "JSON then text": (line(f"{OK} x"), DROP),
    "JSON then object": (line(f"{OK} {{}}"), DROP),
    "JSON then brace": (line(f"{OK}}}"), DROP),
    "JSON comma object": (line(f"{OK},{{}}"), DROP),
    "JSON then bracket": (line(f"{OK}]"), DROP),
    "JSON that closes the frame": (line(f'{OK}],"k":[{{}}'), DROP),
    "JSON that closes the frame, reopened": (line(f'{OK}],"items":[{OK}'), DROP),
    "JSON that ends the frame": (line(f'{OK}],"closed":true}}'), DROP),
    "JSON that closes the array": (line(f"{OK}] {OK}"), DROP),
    "JSON that closes array and object": (line(f'{OK}]}},[{{"item":{OK}'), DROP),
    "object member after the object": (line(f'{OK},"k":{OK}'), DROP),
    "two objects": (line(f"{OK}{OK}"), DROP),
    "brace in a text": (line('{"q":"}","bot_name":"b","user_id":"u"}'), KEEP, ("b", "u"), DAY),
    "brace in a text, then junk": (line('{"q":"}","bot_name":"b","user_id":"u"}}'), DROP),
    "nested object": (line('{"q":{"bot_name":"x","user_id":0},"bot_name":"b","user_id":"u"}'), KEEP, ("b", "u"), DAY),
    "nested list": (line('{"q":[{"k":[1,2]}],"bot_name":"b","user_id":"u"}'), KEEP, ("b", "u"), DAY),
    "bracket in a text": (line('{"q":"x],[{","bot_name":"b","user_id":"u"}'), KEEP, ("b", "u"), DAY),
    "escapes": (line('{"bot_name":"\\u5c0f","user_id":"u"}'), KEEP, ("小", "u"), DAY),
    "escaped tab": (line('{"bot_name":"b\\t","user_id":"u"}'), KEEP, ("b\t", "u"), DAY),
    "bad escape": (line('{"bot_name":"\\x","user_id":"u"}'), DROP),
    "user in blanks": (user('" u "'), KEEP, ("b", " u "), DAY),
}

LEVELS = {
    "A": {},
    "B": {"check_time": False},
    "C": {"check_time": False, "ignore_case": False},
}


def expected(level):
    return {name: case[2] for name, case in CASES.items() if level in case[1]}


@pytest.fixture(scope="module")
def lines(spark):
    # The name rides along as the topic, so each kept row can be told apart.
    return spark.createDataFrame([(n, c[0]) for n, c in CASES.items()], "topic string, value string")


@pytest.mark.parametrize("level", LEVELS)
def test_each_line_is_kept_or_dropped(lines, level):
    kept = clean_events(lines, **LEVELS[level]).collect()
    got = {row.product: (row.bot_name, row.user_id) for row in kept}
    assert len(kept) == len(got)
    assert got == expected(level)


def test_event_day_and_second(lines):
    for row in clean_events(lines).collect():
        text = CASES[row.product][0].split("\t")[0]
        assert row.day == CASES[row.product][3]
        assert row.second == text.strip()


def test_processing_day_keeps_the_time_text(lines):
    kept = clean_events(lines, check_time=False, day_mode="processing", as_of="2024-02-01").collect()
    assert {row.product for row in kept} == set(expected("B"))
    for row in kept:
        assert row.day == dt.date(2024, 2, 1)
        assert row.second == CASES[row.product][0].split("\t")[0]


def test_processing_day_is_today_by_default(lines):
    before = dt.datetime.now(dt.timezone.utc).date()
    days = {row.day for row in clean_events(lines, day_mode="processing").collect()}
    assert days <= {before, dt.datetime.now(dt.timezone.utc).date()}


def test_unknown_day_mode_is_refused(lines):
    with pytest.raises(ValueError):
        clean_events(lines, day_mode="clock")


def test_strip_ids_comes_after_the_truth_test(spark, rows):
    data = [(user('" "'),), (user('"\\u3000u\\u3000"'),), (bot('" b\\t"'),)]
    kept = clean_events(spark.createDataFrame(data, LINES), strip_ids=True)
    assert rows(kept, "bot_name", "user_id") == [("b", ""), ("b", "u"), ("b", "u")]


def test_strip_knows_every_python_white_space():
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_lines_without_topic_have_no_product(spark):
    row = clean_events(spark.createDataFrame([(line(),)], LINES)).first()
    assert row.product is None and row.bot_name == "b"


@pytest.mark.parametrize("closing", ["", ',"y":{"z":1}'])  # with one closing brace, and with two
def test_long_numbers_and_deep_nesting_are_kept(spark, closing):
    number = '{"bot_name":"b","user_id":"u","x":%s%s}' % ("9" * 1_500, closing)
    deep = '{"bot_name":"b","user_id":"u","x":%s%s%s}' % ("[" * 1_200, "]" * 1_200, closing)
    objects = '{"bot_name":"b","user_id":"u","x":%s1%s%s}' % ('{"k":' * 1_200, "}" * 1_200, closing)
    df = spark.createDataFrame([(line(p),) for p in (number, deep, objects)], LINES)
    assert [(r.bot_name, r.user_id) for r in clean_events(df).collect()] == [("b", "u")] * 3


def test_long_topics_stay_whole(spark):
    names = ["a" * 1_500, "a" * 1_500 + "b"]
    df = spark.createDataFrame([("chatlog_" + n, line()) for n in names], "topic string, value string")
    assert sorted(r.product for r in clean_events(df).collect()) == names


def test_topic_prefix_is_cut(spark):
    row = clean_events(spark.createDataFrame([("chatlog_adult", line())], "topic string, value string")).first()
    assert row.product == "adult"


def test_line_is_split_and_parsed_once(spark, capsys):
    """Split and parse stand in generators; no filter repeats them."""
    df = clean_events(spark.createDataFrame([(line(),)], LINES))
    df.explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("from_json(StructField(bot_name,StringType,true), StructField(user_id,StringType,true)") == 1
    assert plan.count("split(value") == 1


def test_damaged_payloads_are_judged_as_by_the_json_module(spark):
    """Thousands of payloads with characters inserted, dropped or doubled."""
    rng = random.Random(42)
    bases = [
        OK,
        '{"q":{"a":[1,{"b":"}]"}]},"bot_name":"b","user_id":"u"}',
        '{"bot_name":"b","q":[],"user_id":"u","r":[{"k":-1.5e3},null,true]}',
        '{"user_id":12,"bot_name":"b","q":"\\\\u0041\\\\n"}',
    ]
    payloads = set()
    while len(payloads) < 8000:
        text = list(rng.choice(bases))
        for _ in range(rng.randint(1, 2)):
            at, what = rng.randrange(len(text) + 1), rng.random()
            if what < 0.6:
                text.insert(at, rng.choice('{}[]",:\\ 01-.eEnt'))
            elif what < 0.8 and at < len(text):
                del text[at]
            else:
                text += rng.choice(["}", "]", ",", "{}", "[]", '"', '],"k":[{}', '},{"a":{}', " ", OK])
        payloads.add("".join(text))

    def is_kept(payload):
        try:
            value = json.loads(payload)
        except ValueError:
            return False
        return isinstance(value, dict) and bool(value.get("bot_name")) and bool(value.get("user_id"))

    data = [(payload, line(payload)) for payload in payloads]
    kept = {row.product for row in clean_events(spark.createDataFrame(data, "topic string, value string")).collect()}
    expected = {payload for payload in payloads if is_kept(payload)}
    assert len(expected) > 500
    assert kept - expected == set()
    assert expected - kept == set()


def test_damaged_times_are_judged_as_by_strptime(spark):
    rng = random.Random(7)
    bases = [T, "2020-02-29 23:59:59", "1999-12-31 0:0:0", "2019-4-8 1:2:3", "2100-02-28 09:08:07"]
    times = set()
    while len(times) < 8000:
        text = list(rng.choice(bases))
        for _ in range(rng.randint(0, 2)):
            at, what = rng.randrange(len(text) + 1), rng.random()
            if what < 0.4:
                text.insert(at, rng.choice("0123456789-:. \xa0　\x0bT"))
            elif at < len(text):
                text[at : at + 1] = rng.choice("0123456789") if what < 0.8 else ""
        times.add("".join(text))

    expected = {}
    for text in times:
        try:
            parsed = time.strptime(text.strip(), "%Y-%m-%d %H:%M:%S")
        except ValueError:
            continue
        expected[text] = dt.date(*parsed[:3])
    assert len(expected) > 1000
    data = [(text, line(time=text)) for text in times]
    kept = clean_events(spark.createDataFrame(data, "topic string, value string")).collect()
    got = {row.product: row.day for row in kept}
    assert {k: v for k, v in got.items() if expected.get(k) != v} == {}
    assert {k: v for k, v in expected.items() if got.get(k) != v} == {}
