"""General operators, readers and sinks."""

import pytest

from chatmeter.operators import generic
from chatmeter.session import materialize, scratch_dir
from chatmeter.sources import readers, sinks


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([("Ann", 30), ("Bo", 19), ("Cy", 13), ("Di", None)], "name string, age bigint")


def test_doubled_collection(spark, rows):
    numbers = spark.createDataFrame([(n,) for n in (1, 2, 3, 4, 5)], "n bigint")
    assert rows(generic.doubled(numbers, "n"), "doubled") == [(2,), (4,), (6,), (8,), (10,)]


def test_word_count_keeps_empty_words(spark, rows):
    text = lines(spark, "a  b", "a", "")
    assert rows(generic.word_count(text)) == [("", 2), ("a", 2), ("b", 1)]
    assert rows(generic.word_count_text(text)) == [(":2",), ("a:2",), ("b:1",)]


def test_key_counts_are_in_order(spark):
    got = generic.key_count_sorted(lines(spark, "b\t1", "a\t1", "b", "c\t1", "c\t2", "c\t3")).collect()
    assert [tuple(r) for r in got] == [("a", 1), ("b", 2), ("c", 3)]


def test_average_of_two_token_lines(spark, rows):
    text = lines(spark, " a 1 ", "b 2", "c 3 x", "d", "e  4", "\tf 6　")
    assert rows(generic.global_average(text)) == [(3, 9, 3.0, 0)]
    assert rows(generic.global_average(lines(spark, "x"))) == [(0, 0, None, 0)]
    wide = lines(spark, "a " + "9" * 25, "b 1", "c x")
    assert rows(generic.global_average(wide), "cnt", "total", "unread") == [(3, 10**25, 1)]


def test_people_from_text(spark, rows):
    text = lines(spark, "Michael, 29", "Andy,30", "Justin, x", "None")
    assert rows(generic.people_typed(text)) == [("Andy", 30), ("Justin", None), ("Michael", 29), ("None", None)]
    assert rows(generic.people_typed(lines(spark, "Ann," + "9" * 25))) == [("Ann", 10**25 - 1)]
    strings = generic.people_strings(text)
    assert rows(strings) == [("Andy", "30"), ("Justin", "x"), ("Michael", "29"), ("None", None)]
    assert [f.dataType.simpleString() for f in strings.schema] == ["string", "string"]


def test_columns_filters_and_groups(people, rows):
    assert rows(generic.age_plus_one(people)) == [("Ann", 31), ("Bo", 20), ("Cy", 14), ("Di", None)]
    assert rows(generic.older_than(people, 21), "name") == [("Ann",)]
    assert rows(generic.count_by_age(people)) == [(None, 1), (13, 1), (19, 1), (30, 1)]


def test_sql_over_a_view(spark, people, rows):
    teenagers = generic.names_between(spark, people, 13, 19)
    assert rows(teenagers) == [("Bo",), ("Cy",)]
    assert rows(generic.labelled_names(teenagers)) == [("Name: Bo",), ("Name: Cy",)]


def test_schema_rows(spark, people, rows):
    assert rows(generic.schema_rows(spark, people)) == [("age", "bigint", True), ("name", "string", True)]


def test_first_rows(people):
    assert [r.name for r in generic.first_rows(people, ["age", "name"], 2).collect()] == ["Di", "Cy"]


def test_text_round_trip(spark, rows, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n bigint")
    sinks.write_text(df, str(tmp_path / "out"))
    assert rows(readers.read_lines(spark, str(tmp_path / "out"))) == [("a\t1",), ("b\t2",)]


def test_sorted_text_output_stays_in_order(spark, tmp_path):
    counts = generic.key_count_sorted(lines(spark, *[f"k{i}" for i in range(50) for _ in range(i + 1)]))
    sinks.write_text(counts, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert [int(line.split("\t")[1]) for line in text.splitlines()] == list(range(1, 51))


def test_nested_folders(spark, rows, tmp_path):
    (tmp_path / "in/deep/deeper").mkdir(parents=True)
    (tmp_path / "in/a.txt").write_text("top\n")
    (tmp_path / "in/deep/deeper/b.txt").write_text("down\n")
    assert rows(readers.read_lines(spark, str(tmp_path / "in"), recursive=True)) == [("down",), ("top",)]
    stream = readers.stream_lines(spark, str(tmp_path / "in"))
    assert stream.isStreaming and stream.columns == ["value"]


def test_json_with_and_without_schema(spark, people, rows, tmp_path):
    people.write.json(str(tmp_path / "people"))
    inferred = readers.read_json(spark, str(tmp_path / "people"))
    assert dict(inferred.dtypes) == {"age": "bigint", "name": "string"}
    given = readers.read_json(spark, str(tmp_path / "people"), people.schema)
    assert rows(given) == rows(people)


def test_catalog_table(spark, people, rows):
    people.createOrReplaceTempView("some_people")
    assert rows(readers.read_table(spark, "some_people")) == rows(people)


def test_kafka_options():
    assert readers.kafka_options(["h1:1", "h2:2"], ["chatlog_adult", "chatlog_children"], "earliest", 10) == {
        "kafka.bootstrap.servers": "h1:1,h2:2",
        "subscribe": "chatlog_adult,chatlog_children",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "10",
    }
    assert readers.kafka_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest",
    }


def test_dimension_options():
    options = readers.dimension_options("jdbc:mysql://h/db", "bots", "u", "p", "type, botname AS bot_name")
    assert options["dbtable"] == "(SELECT type, botname AS bot_name FROM bots) AS dimension"
    assert options["pushDownPredicate"] == "true"
    assert readers.dimension_options("x", "t", "u", "p")["dbtable"] == "t"


def test_print_rows_and_materialize(spark, people, rows):
    sinks.print_rows(people)
    copy = materialize(spark, people, "people", partition_by=("name",))
    assert rows(copy, "name", "age") == rows(people)
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_socket_source_is_declared_without_connecting(spark):
    # Building the stream opens no connection; starting it would.
    assert readers.stream_socket(spark, "localhost", 9999).isStreaming
