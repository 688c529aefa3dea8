"""KPI operators on small hand-made requests."""

import datetime as dt

import pytest

from chatmeter.operators import kpi
from chatmeter.schema import REQUEST, USERS_TOTAL

D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


def request(bot, user, day, second=0, product="adult"):
    return product, bot, user, day, f"{day} 00:00:{second:02d}"


@pytest.fixture(scope="module")
def requests(spark):
    data = [
        request("a", "u1", D1),
        request("a", "u1", D1),
        request("a", "u1", D2, 1),
        request("a", "u2", D2, 1, "children"),
        request("a", "u3", D2, 2),
        request("a", "u3", D2, 2),
        request("b", "u1", D2, 1),
        request("b", "u1", D3, 5),
    ]
    return spark.createDataFrame(data, REQUEST)


def test_page_views(requests, rows):
    assert rows(kpi.pv_total(requests)) == [("a", 6), ("b", 2)]
    assert rows(kpi.pv_day(requests)) == [("a", D1, 2), ("a", D2, 4), ("b", D2, 1), ("b", D3, 1)]


def test_unique_users(requests, rows):
    assert rows(kpi.uv_total(kpi.users_total(requests))) == [("a", 3), ("b", 1)]
    assert rows(kpi.uv_day(kpi.users_day(requests))) == [("a", D1, 1), ("a", D2, 3), ("b", D2, 1), ("b", D3, 1)]


def test_new_users_take_their_earliest_day(requests, rows):
    want = [("a", D1, "u1"), ("a", D2, "u2"), ("a", D2, "u3"), ("b", D2, "u1")]
    assert rows(kpi.new_users(requests)) == want


def test_known_users_are_not_new_again(spark, requests, rows):
    known = spark.createDataFrame([("a", "u1"), ("b", "u9")], USERS_TOTAL)
    new = kpi.new_users(requests, known)
    assert rows(new) == [("a", D2, "u2"), ("a", D2, "u3"), ("b", D2, "u1")]
    assert rows(kpi.bot_registry(new)) == [("a",), ("b",)]
    everyone = spark.createDataFrame([("a", "u1"), ("a", "u2"), ("a", "u3"), ("b", "u1")], USERS_TOTAL)
    assert rows(kpi.new_users(requests, everyone)) == []


def test_merge_users_is_a_set_union(spark, requests, rows):
    stored = spark.createDataFrame([("a", "u1"), ("c", "u9")], USERS_TOTAL)
    assert rows(kpi.merge_users(stored, requests)) == [("a", "u1"), ("a", "u2"), ("a", "u3"), ("b", "u1"), ("c", "u9")]


def test_requests_per_second_and_peaks(requests, rows):
    qps = kpi.qps_bot(requests)
    assert ("a", D2, "2024-01-02 00:00:01", 2) in rows(qps)
    # Two seconds of that day have two requests; the earlier one is named.
    top = {(r.bot_name, r.day): (r.requests, r.second) for r in kpi.top_qps(qps, "bot_name").collect()}
    assert top["a", D1] == (2, "2024-01-01 00:00:00")
    assert top["a", D2] == (2, "2024-01-02 00:00:01")
    assert [r.requests for r in kpi.busiest_first(qps).collect()] == [2, 2, 2, 1, 1]


def test_product_qps_adds_up_the_bots(requests, rows):
    top = {(r.product, r.day): r.requests for r in kpi.top_qps(kpi.qps_product(requests), "product").collect()}
    assert top == {("adult", D1): 2, ("adult", D2): 2, ("adult", D3): 1, ("children", D2): 1}
    assert ("adult", D2, "2024-01-02 00:00:01", 2) in rows(kpi.qps_product(requests))


def test_overall_uv_counts_a_user_of_two_bots_twice(requests, rows):
    assert rows(kpi.overall_totals(requests)) == [(8, 4)]
    assert rows(kpi.overall_by_day(requests)) == [(D1, 2, 1, 1), (D2, 5, 4, 3), (D3, 1, 1, 0)]


def test_overall_by_day_needs_no_window_and_no_sort(requests, capsys):
    kpi.overall_by_day(requests).explain()
    plan = capsys.readouterr().out
    assert "Window" not in plan and "Sort" not in plan and "partial_min(day" in plan


def test_counters(spark, rows):
    fresh = spark.createDataFrame([("b", 5), ("c", 7)], "bot_name string, pv bigint")
    assert rows(kpi.to_counters(fresh, ("x", "y"))) == [("x", "b", 5), ("x", "c", 7), ("y", "b", 5), ("y", "c", 7)]


def test_extracted_file_counts_the_second_field_uncleaned(spark, rows):
    lines = spark.createDataFrame([("1\ta",), ("2\ta\tx",), ("3\t",), ("no tab",)], "value string")
    assert rows(kpi.pv_extracted(lines)) == [("", 1), ("a", 2)]


def test_a_hot_bot_is_combined_before_the_shuffle(spark, requests, capsys):
    """PV groups on the map side; users are hashed on bot and user, never on the bot alone."""
    kpi.pv_total(requests).explain()
    assert "partial_count" in capsys.readouterr().out
    kpi.uv_total(kpi.users_total(requests)).explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning(bot_name" in plan and "user_id" in plan
    assert plan.count("Exchange") == 2 and plan.count("partial_count") == 1
