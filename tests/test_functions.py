"""Lenient parsing, calendar parts, buckets, key hashes."""

import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.functions import buckets, calendar, hashing, lenient


def evaluate(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i INT, v {kind}")
    return [r["out"] for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_whole_numbers(spark):
    values = ["12", "011", " 7 ", "+5", "-3", "12.0", "x", "", None, "99999999999"]
    assert evaluate(spark, values, lenient.lenient_int) == [12, 11, 7, 5, -3, None, None, None, None, None]
    assert evaluate(spark, ["99999999999"], lambda c: lenient.lenient_int(c, "bigint")) == [99999999999]


def test_floating_numbers(spark):
    out = evaluate(spark, ["1.5", "-2e3", "", "abc", None, "nan", "inf", "1.5d", "2f", "0x1p3"], lenient.lenient_double)
    assert out[:5] == [1.5, -2000.0, None, None, None]
    assert math.isnan(out[5]) and out[6] == math.inf and out[7:] == [None, None, None]


def python_float(text):
    try:
        return float(text)
    except ValueError:
        return None


def python_int(text):
    try:
        return int(text)
    except ValueError:
        return None


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("0123456789+-. eExXdfDFnaNiIty", max_size=7), min_size=150, max_size=300))
def test_numbers_read_as_by_python(spark, texts):
    for ours, theirs in ((lenient.lenient_double, python_float), (lenient.lenient_int, python_int)):
        for text, got in zip(texts, evaluate(spark, texts, ours)):
            want = theirs(text)
            assert got == want or (got != got and want != want), text


def test_booleans_are_never_null(spark):
    values = ["TRUE", " yes ", "1", "true", "0", "no", "", None, "y"]
    assert evaluate(spark, values, lenient.lenient_bool) == [True] * 4 + [False] * 5


def test_blank_keeps_spaces(spark):
    assert evaluate(spark, ["", " ", "a", None], lenient.blank_to_null) == [None, " ", "a", None]


DATES = {
    "05/13/2023 11:30:00 AM": 1683977400000,
    "5/3/2023 1:30:00 PM": 1683120600000,
    "01/01/2023 12:00:00 AM": 1672531200000,
    "01/01/2023 12:00:00 PM": 1672574400000,
    "01/01/1970 12:00:00 AM": 0,
    "02/30/2023 01:00:00 AM": None,
    "1/1/2023 1:0:5 am": 1672534805000,
    "01/01/2023 13:00:00 PM": None,
    "2023-05-13": None,
    "": None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_dates_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert evaluate(spark, list(DATES), lenient.source_date_millis) == list(DATES.values())
        millis = [0, 1683977400123, -1500]
        clocks = evaluate(spark, millis, lambda c: calendar.wall_clock(c).cast("string"), "bigint")
        assert clocks == ["1970-01-01 00:00:00", "2023-05-13 11:30:00.123", "1969-12-31 23:59:58.5"]
        assert evaluate(spark, millis, lambda c: calendar.wall_millis(calendar.wall_clock(c)), "bigint") == millis
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_night_and_weekend(spark):
    hours = [0, 5, 6, 21, 22, 23, None]
    assert evaluate(spark, hours, calendar.is_night, "int") == [1, 1, 0, 0, 1, 1, 0]
    assert evaluate(spark, [1, 2, 6, 7, None], calendar.is_weekend, "int") == [1, 0, 0, 1, 0]
    assert evaluate(spark, [1, 7], calendar.day_name, "int") == ["Sunday", "Saturday"]


def test_bucket_edges(spark):
    def frequency(c):
        return buckets.threshold_bucket(c, buckets.FREQUENCY_LEVELS, buckets.FREQUENCY_REST)

    def size(c):
        return buckets.threshold_bucket(c, buckets.SIZE_LEVELS, buckets.SIZE_REST)

    assert evaluate(spark, [999, 1000, 9999, 10000, 99999, 100000], frequency, "bigint") == [
        "low", "medium", "medium", "high", "high", "very_high"]
    assert evaluate(spark, [49999, 50000, 199999, 200000], size, "bigint") == [
        "small", "medium", "medium", "large"]


@pytest.mark.parametrize("portable", [False, True])
def test_buckets_are_even_and_salted(spark, portable):
    ids = spark.range(20_000)
    a = hashing.key_bucket(F.col("id"), 10, "a", portable)
    b = hashing.key_bucket(F.col("id"), 10, "b", portable)
    cells = ids.groupBy(a.alias("a"), b.alias("b")).count().collect()
    assert len(cells) == 100
    assert all(120 < cell["count"] < 280 for cell in cells)
