"""Golden checks of the row functions against the reference semantics (Java split, parseInt,
time parsing, JSON of a lookup row)."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rivulet.functions.json import json_object
from rivulet.functions.parse import delimited_field, parse_int, str_to_millis, to_action_time
from rivulet.functions.text import java_split
from rivulet.sources.text import document_lines


@pytest.mark.parametrize("line,tokens", [
    ("a b ", ["a", "b"]),
    ("", [""]),
    (" ", []),
    ("   ", []),
    (" a  b", ["", "a", "", "b"]),
    ("a\tb", ["a\tb"]),
    ("a", ["a"]),
])
def test_java_split(spark, line, tokens):
    got = spark.createDataFrame([(line,)], "value string").select(java_split("value").alias("t")).first().t
    assert got == tokens


def test_java_split_semicolon(spark):
    df = spark.createDataFrame([("amy;2020;",), (";x",), (";;",)], "value string")
    got = [r.t for r in df.select(java_split("value", ";").alias("t")).collect()]
    assert got == [["amy", "2020"], ["", "x"], []]


def test_document_lines(spark):
    df = spark.createDataFrame([(1, "a\n\nb\n"), (2, ""), (3, "x"), (4, None), (5, "\n")], "doc_id int, text string")
    got = sorted(tuple(r) for r in document_lines(df).collect())
    assert got == [(1, 1, "a"), (1, 2, ""), (1, 3, "b"), (3, 1, "x"), (5, 1, "")]


def test_parse_int_strict_and_lenient(spark):
    df = spark.createDataFrame([("1002",), ("+5",), ("-7",)], "value string")
    assert [r.i for r in df.select(parse_int("value").alias("i")).collect()] == [1002, 5, -7]
    bad = spark.createDataFrame([(" 12 ",), ("x",), ("99999999999",), ("12\n",), ("12\r",)], "value string")
    assert [r.i for r in bad.select(parse_int("value", strict=False).alias("i")).collect()] == [None] * 5
    for v in (" 12 ", "x", "99999999999", "12\n", "12\r"):
        with pytest.raises(PySparkException):
            spark.createDataFrame([(v,)], "value string").select(parse_int("value")).collect()


def test_str_to_millis_utc(spark):
    df = spark.createDataFrame([("2020-03-20 15:22:00",)], "s string")
    assert df.select(str_to_millis("s").alias("m")).first().m == 1584717720000


def test_action_time_strict(spark):
    df = spark.createDataFrame([("amy;2020-13-20 15:22:00",)], "value string")
    with pytest.raises(PySparkException):
        df.select(to_action_time(delimited_field("value", ";", 1))).collect()
    missing = spark.createDataFrame([("amy",)], "value string")
    with pytest.raises(PySparkException):
        missing.select(delimited_field("value", ";", 1)).collect()
    lenient = df.select(to_action_time(delimited_field("value", ";", 1), strict=False).alias("t")).first().t
    assert lenient is None


def test_json_keeps_nulls(spark):
    df = spark.createDataFrame([("Doe", "Ann"), ("Roe", None)], "lastName string, firstName string")
    got = [r.j for r in df.select(json_object(F.struct("lastName", "firstName")).alias("j")).collect()]
    assert got == ['{"lastName":"Doe","firstName":"Ann"}', '{"lastName":"Roe","firstName":null}']


def _java_split_model(line: str, sep: str) -> list[str]:
    """Java ``String.split(sep)`` for a one-character, non-regex separator."""
    parts = line.split(sep)
    if line == "":
        return [""]
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_java_split_matches_model(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @given(st.lists(st.text(alphabet="ab \t;", max_size=8), min_size=1, max_size=25))
    @settings(max_examples=5, deadline=None)
    def check(lines):
        df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, value string")
        for sep in (" ", ";"):
            got = {r.i: r.t for r in df.select("i", java_split("value", sep).alias("t")).collect()}
            assert [got[i] for i in range(len(lines))] == [_java_split_model(s, sep) for s in lines]

    check()


def test_window_sizes_keep_word_totals(spark):
    """Summing the windows away gives the same per-word totals for every window size."""
    from rivulet.operators.windows import tumble_sum
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    pairs = ev.select("ts", F.col("event_type").alias("word"), F.lit(1).cast("int").alias("n"))
    totals = []
    for size in ("5 seconds", "1 minute", "1 hour", "1 day"):
        agg = tumble_sum(pairs, "ts", "word", "n", size).groupBy("word").agg(F.sum("n").alias("t"))
        totals.append(sorted(tuple(r) for r in agg.collect()))
    assert all(t == totals[0] for t in totals) and sum(t for _, t in totals[0]) == ev.count()


def test_socket_option_is_a_lazy_stream(spark):
    """The socket form is only declared here (nothing is started, no connection is made)."""
    from rivulet.sources.text import read_text_lines
    df = read_text_lines(spark, host="localhost", port=9)
    assert df.isStreaming and df.columns == ["value"]
