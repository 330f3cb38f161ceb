from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from faregate.functions import calendar, digest, rounding, text
from faregate.schemas import PAYMENT_LABELS


def one(df):
    return df.first()


@pytest.mark.parametrize(
    "value,expected",
    [(0.125, 0.12), (2.675, 2.68), (1.005, 1.0), (0.375, 0.38), (2.5, 2.5), (1.115, 1.12), (1.015, 1.01)],
)
def test_half_even_rounds_the_binary_product(spark, value, expected):
    df = spark.createDataFrame([(value,)], "x double")
    assert one(df.select(rounding.half_even(F.col("x"))))[0] == expected


def test_negative_zero_becomes_zero(spark):
    df = spark.createDataFrame([(-0.001,)], "x double")
    assert str(one(df.select(rounding.half_even(F.col("x"))))[0]) == "0.0"


def test_guarded_ratio_is_null_unless_divisor_is_positive(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, -1.0), (1.0, None), (1.0, 2.0)], "a double, b double")
    got = [r[0] for r in df.select(rounding.guarded_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [None, None, None, 0.5]


def test_weekday_starts_on_monday(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 6, 23, 59),), (dt.datetime(2024, 1, 8),), (None,)], "t timestamp_ntz")
    rows = df.select(calendar.monday_based_weekday(F.col("t")), calendar.is_weekend(F.col("t")), calendar.iso_date(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [(5, True, "2024-01-06"), (0, False, "2024-01-08"), (None, None, None)]


def test_duration_may_be_negative_and_keeps_microseconds(spark):
    a, b = dt.datetime(2024, 1, 1, 0, 0, 1, 500), dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(a, b), (None, b)], "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(calendar.duration_seconds(F.col("a"), F.col("b"))).collect()]
    assert got == [-1.0005, None]


def test_dates_in_a_clock_change_keep_their_day(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30),)], "t timestamp_ntz")
        row = one(df.select(calendar.iso_date(F.col("t")), F.hour("t")))
        assert tuple(row) == ("2024-03-10", 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parsed_date(spark):
    df = spark.createDataFrame([("31/02/2024",), ("2098-06-15",), (None,)], "d string")
    got = [r[0] for r in df.select(calendar.parsed_date(F.col("d"))).collect()]
    assert got == [None, dt.date(2098, 6, 15), None]


def test_unknown_and_missing_codes_are_other(spark):
    df = spark.createDataFrame([(1,), (4,), (9,), (None,)], "c bigint")
    got = [r[0] for r in df.select(text.label_of(F.col("c"), PAYMENT_LABELS)).collect()]
    assert got == ["credit_card", "dispute", "other", "other"]


def test_text_parts(spark):
    df = spark.createDataFrame([("collect at A.scala:1", "first\nsecond", 7), ("count", "", 7), (None, None, 265)], "n string, d string, i int")
    got = df.select(text.before(F.col("n"), " at "), text.first_line_head(F.col("d")), text.numbered_label("Zone", F.col("i"))).collect()
    assert [tuple(r) for r in got] == [("collect", "first", "Zone 007"), ("count", "", "Zone 007"), (None, None, "Zone 265")]


def test_thresholds_are_hex_texts():
    wanted = {0.0: "00000000", 0.25: "40000000", 1.0: "g", 1.5: "g", -0.1: "00000000"}
    assert {p: digest.threshold(p) for p in wanted} == wanted


def test_draws_are_close_to_their_probability(spark):
    rows = spark.range(20_000).select((digest.draw(F.col("id"), "t") < digest.threshold(0.3)).alias("hit"))
    share = rows.agg(F.avg(F.col("hit").cast("int"))).first()[0]
    assert abs(share - 0.3) < 0.02
