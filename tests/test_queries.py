"""Every registered query against DuckDB on the same tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()
from chatmeter.plans.registry import QUERIES, SQL  # noqa: E402  (those registered outside the training-data package)


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(SQL) <= set(entry_point.oracle_sql())


PYTHON = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups", "CartesianProduct")


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, sf_dir, name, capsys):
    df = QUERIES[name](spark, sf_dir)
    capsys.readouterr()
    df.explain()  # all operators are built-in expressions: no Python worker in any plan
    plan = capsys.readouterr().out
    assert "Scan" in plan and not [node for node in PYTHON if node in plan]
    columns = sorted(df.columns)
    got = sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)
    cursor = duck.execute(SQL[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    want = sorted((tuple(row[i] for i in order) for row in cursor.fetchall()), key=repr)
    assert got == want
    assert got


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["bot_name", "pv"]
