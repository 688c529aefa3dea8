"""Registered queries of the general operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmeter.operators import generic
from chatmeter.plans.registry import query
from chatmeter.session import materialize, scratch_dir
from chatmeter.sources import testtables
from chatmeter.sources.readers import as_lines, read_json, read_table

_WORDS = """SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split(line, ' ')) AS word FROM (
  SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) GROUP BY word"""


def _customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testtables.table(spark, sf_dir, "customer")


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testtables.people(_customer(spark, sf_dir))


def _document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_lines(testtables.table(spark, sf_dir, "documents"), "text")


@query("SELECT o_orderkey, o_orderkey * 2 AS doubled FROM orders")
def map_double(spark, sf_dir):
    return generic.doubled(testtables.table(spark, sf_dir, "orders"), "o_orderkey")


@query(_WORDS)
def wordcount(spark, sf_dir):
    return generic.word_count(_document_lines(spark, sf_dir))


@query(f"SELECT word || ':' || cnt AS value FROM ({_WORDS})")
def wordcount_text(spark, sf_dir):
    return generic.word_count_text(_document_lines(spark, sf_dir))


@query("SELECT event_type AS key, count(*) AS cnt FROM events GROUP BY event_type")
def key_count_sorted(spark, sf_dir):
    events = testtables.table(spark, sf_dir, "events")
    lines = events.select(F.concat_ws("\t", "event_type", F.col("event_id").cast("string")).alias("value"))
    return generic.key_count_sorted(lines)


@query(
    """SELECT count(*) AS cnt, CAST(sum(c_nationkey) AS BIGINT) AS total, avg(c_nationkey) AS average,
    CAST(0 AS BIGINT) AS unread FROM customer WHERE c_custkey % 7 <> 0"""
)
def global_avg(spark, sf_dir):
    found = generic.global_average(testtables.pair_lines(_customer(spark, sf_dir)))
    return found.withColumn("total", F.col("total").cast("bigint"))


@query("SELECT c_name AS name FROM customer")
def json_scan(spark, sf_dir):
    """JSON files with an inferred schema, one column selected."""
    path = scratch_dir(spark, "people-json")
    _people(spark, sf_dir).write.json(path)
    return read_json(spark, path).select("name")


@query("SELECT c_name AS name, CAST(c_nationkey AS BIGINT) AS age FROM customer")
def people_typed(spark, sf_dir):
    people = generic.people_typed(testtables.people_lines(_customer(spark, sf_dir)))
    return people.withColumn("age", F.col("age").cast("bigint"))


@query("SELECT c_name AS name, CAST(c_nationkey AS VARCHAR) AS age FROM customer")
def people_strings(spark, sf_dir):
    return generic.people_strings(testtables.people_lines(_customer(spark, sf_dir)))


@query("SELECT c_name AS name, CAST(c_nationkey + 1 AS BIGINT) AS age_plus_one FROM customer")
def select_plus_one(spark, sf_dir):
    return generic.age_plus_one(_people(spark, sf_dir))


@query("SELECT c_name AS name, CAST(c_nationkey AS BIGINT) AS age FROM customer WHERE c_nationkey > 21")
def filter_gt(spark, sf_dir):
    return generic.older_than(_people(spark, sf_dir), 21)


@query('SELECT CAST(c_nationkey AS BIGINT) AS age, count(*) AS "count" FROM customer GROUP BY c_nationkey')
def group_count(spark, sf_dir):
    return generic.count_by_age(_people(spark, sf_dir))


@query("SELECT c_name AS name FROM customer WHERE c_nationkey BETWEEN 13 AND 19")
def sql_between(spark, sf_dir):
    return generic.names_between(spark, _people(spark, sf_dir), 13, 19)


@query("SELECT 'Name: ' || c_name AS value FROM customer WHERE c_nationkey BETWEEN 13 AND 19")
def sql_concat(spark, sf_dir):
    people = generic.people_typed(testtables.people_lines(_customer(spark, sf_dir)))
    return generic.labelled_names(generic.names_between(spark, people, 13, 19))


@query(
    """SELECT p_partkey, p_name, p_brand, p_type FROM part
    WHERE p_brand = 'Brand#1' AND p_type IN ('ECONOMY', 'SMALL') ORDER BY p_partkey LIMIT 1"""
)
def sql_eq_in(spark, sf_dir):
    parts = testtables.table(spark, sf_dir, "part")
    parts.createOrReplaceTempView("chatmeter_part")
    matching = spark.sql(
        """SELECT p_partkey, p_name, p_brand, p_type FROM chatmeter_part
        WHERE p_brand = 'Brand#1' AND p_type IN ('ECONOMY', 'SMALL')"""
    )
    return generic.first_rows(matching, ["p_partkey"])


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part ORDER BY p_partkey LIMIT 1")
def catalog_limit(spark, sf_dir):
    """A catalog table over the given files, which leaves the catalog again; the files stay."""
    name = f"chatmeter_part_{uuid.uuid4().hex}"
    spark.catalog.createTable(name, path=f"{sf_dir}/part.parquet", source="parquet")
    columns = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]
    try:
        row = generic.first_rows(read_table(spark, name).select(*columns), ["p_partkey"])
        return materialize(spark, row, "first_part")
    finally:
        spark.sql(f"DROP TABLE {name}")
