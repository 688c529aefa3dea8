"""General operators on text lines and on people tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmeter.functions.text import field, strip, words
from chatmeter.schema import PEOPLE_TEXT


def doubled(numbers: DataFrame, column: str) -> DataFrame:
    return numbers.select(column, (F.col(column) * 2).alias("doubled"))


def explode_words(lines: DataFrame) -> DataFrame:
    return lines.select(F.explode(words(F.col("value"))).alias("word"))


def word_count(lines: DataFrame) -> DataFrame:
    return explode_words(lines).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def word_count_text(lines: DataFrame) -> DataFrame:
    """One ``word:count`` text per word."""
    return word_count(lines).select(F.format_string("%s:%d", "word", "cnt").alias("value"))


def key_count_sorted(lines: DataFrame) -> DataFrame:
    """Count of each first tab field, rarest first; equal counts in key order."""
    keys = lines.select(field(F.split("value", "\t", 2), 0).alias("key"))
    return keys.groupBy("key").agg(F.count(F.lit(1)).alias("cnt")).orderBy("cnt", "key")


def global_average(lines: DataFrame) -> DataFrame:
    """Count, sum and average of the numbers in lines of exactly two blank-separated tokens.

    ``cnt`` has all such lines. Whole numbers have up to 38 digits; what is no such number adds
    nothing, and ``unread`` says how many there were.
    """
    tokens = words(strip(F.col("value")))
    numbers = lines.where(F.size(tokens) == 2).select(whole_number(field(tokens, 1)).alias("n"))
    return numbers.agg(
        F.count(F.lit(1)).alias("cnt"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("decimal(38,0)").alias("total"),
        F.avg(F.col("n").cast("double")).alias("average"),
        F.count_if(F.col("n").isNull()).alias("unread"),
    )


def whole_number(text: Column) -> Column:
    """A whole number of up to 38 digits, null for any other text."""
    return F.when(strip(text).rlike(r"^[+-]?[0-9]+\z"), strip(text)).try_cast("decimal(38,0)")


def people_typed(lines: DataFrame) -> DataFrame:
    """``name,age`` lines with the age as a number."""
    parts = F.split("value", ",")
    return lines.select(field(parts, 0).alias("name"), whole_number(field(parts, 1)).alias("age"))


def people_strings(lines: DataFrame) -> DataFrame:
    """``name,age`` lines as text columns of a fixed schema."""
    parts = F.split("value", ",")
    return lines.select(field(parts, 0).alias("name"), strip(field(parts, 1)).alias("age")).to(PEOPLE_TEXT)


def age_plus_one(people: DataFrame) -> DataFrame:
    return people.select("name", (F.col("age") + 1).alias("age_plus_one"))


def older_than(people: DataFrame, age: int) -> DataFrame:
    return people.where(F.col("age") > age)


def count_by_age(people: DataFrame) -> DataFrame:
    return people.groupBy("age").count()


def names_between(spark: SparkSession, people: DataFrame, low: int, high: int) -> DataFrame:
    """SQL over a temporary view, with bound parameters."""
    people.createOrReplaceTempView("chatmeter_people")
    return spark.sql(
        "SELECT name FROM chatmeter_people WHERE age >= :low AND age <= :high", {"low": low, "high": high}
    )


def labelled_names(people: DataFrame) -> DataFrame:
    return people.select(F.concat(F.lit("Name: "), "name").alias("value"))


def schema_rows(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The schema as rows, for showing it where a console is no use."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return spark.createDataFrame(rows, "name string, type string, nullable boolean")


def first_rows(df: DataFrame, order: list[str], n: int = 1) -> DataFrame:
    """``limit`` with an order, so that it has one answer."""
    return df.orderBy(*order).limit(n)
