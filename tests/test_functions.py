"""Scalar helpers and synthetic cases."""
import datetime as dt

from pyspark.sql import functions as F

from tessera.functions.dates import boundary_diff, date_key
from tessera.functions.text import format_measure


def test_boundary_hours(spark):
    rows = [(dt.datetime(2017, 1, 1, 10, 59), dt.datetime(2017, 1, 1, 11, 1)),
            (dt.datetime(2017, 1, 1, 10, 1), dt.datetime(2017, 1, 1, 10, 59)),
            (dt.datetime(2017, 1, 1, 11, 1), dt.datetime(2017, 1, 1, 10, 59))]
    df = spark.createDataFrame(rows, "a timestamp, b timestamp")
    got = [r.h for r in df.select(boundary_diff("HOUR", "a", "b").alias("h")).collect()]
    assert got == [1, 0, -1]


def test_date_key_null(spark):
    df = spark.createDataFrame([(dt.datetime(2018, 9, 3, 23, 0),), (None,)], "t timestamp")
    assert [r.k for r in df.select(date_key("t").alias("k")).collect()] == [20180903, None]


def test_format_measure(spark):
    df = spark.createDataFrame([(1234567.5,), (-99.994,)], "x double")
    got = [r.f for r in df.select(format_measure("x", '"R$"#,0.00').alias("f")).collect()]
    assert got == ["R$1,234,567.50", "-R$99.99"]
    got0 = [r.f for r in df.select(format_measure("x", '"R$" #,0').alias("f")).collect()]
    assert got0 == ["R$ 1,234,568", "-R$ 100"]


def test_first_translation(spark):
    from tessera.functions.arrays import first_translation
    schema = "resp array<struct<translations: array<struct<text: string, to: string>>>>"
    rows = [([{"translations": [{"text": "hello", "to": "en"}, {"text": "hallo", "to": "de"}]}],),
            ([{"translations": []}],), ([],)]
    df = spark.createDataFrame(rows, schema)
    assert [r.t for r in df.select(first_translation("resp").alias("t")).collect()] == ["hello", None, None]


def test_boundary_hours_ignore_session_zone(spark):
    """Wall-clock boundary counting: a naive interval across a DST change is not shifted."""
    rows = [(dt.datetime(2017, 3, 11, 23, 30), dt.datetime(2017, 3, 12, 4, 10))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = df.select(boundary_diff("HOUR", "a", "b").alias("h")).first().h
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == 5


def test_text_profile_two_columns(spark):
    from tessera.functions.text import text_profile
    df = spark.createDataFrame([("a", "xyz"), ("abcd", None), ("ab", "q")], "s string, t string")
    got = {r.column: (r.n, r.min, r.q1, r.median, r.q3, r.max) for r in text_profile(df, ["s", "t"]).collect()}
    assert got == {"s": (3, 1, 1, 2, 4, 4), "t": (2, 1, 1, 1, 3, 3)}
