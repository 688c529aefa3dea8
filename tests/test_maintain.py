"""What corrections are about."""

import datetime as dt

import pytest

from chatmeter.operators import maintain
from chatmeter.schema import DIM_BOT, USERS_DAY, USERS_TOTAL

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


@pytest.fixture(scope="module")
def tables(spark):
    new = spark.createDataFrame([("a", D1, "u1"), ("a", D2, "u2"), ("b", D2, "u1"), ("b:x", D2, "u3")], USERS_DAY)
    users = spark.createDataFrame([("a", "u1"), ("a", "u2"), ("b", "u1"), ("b:x", "u3"), ("b", "old")], USERS_TOTAL)
    return users, new


def test_users_of_a_day(tables, rows):
    _, new = tables
    assert rows(maintain.users_to_roll_back(new, "2024-01-02")) == [("a", D2, "u2"), ("b", D2, "u1"), ("b:x", D2, "u3")]
    assert rows(maintain.users_to_roll_back(new, "2024-01-03")) == []


def test_users_of_a_day_and_type(spark, tables, rows):
    _, new = tables
    dim = spark.createDataFrame([("children", "b"), ("children", "b"), ("adult", "a")], DIM_BOT)
    bots = maintain.bots_of_type(dim, "children")
    assert rows(bots) == [("b",)]
    assert rows(maintain.users_to_roll_back(new, "2024-01-02", bots)) == [("b", D2, "u1")]
