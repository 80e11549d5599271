import datetime as dt

import pytest

from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

from skylane.functions import (
    interval_seconds, parse_interval, round_half_away, to_int_nearest, weekday_name,
)


def test_round_half_away_on_binary_value(spark):  # T8
    df = spark.createDataFrame([(1.005,), (0.285,), (-0.125,), (2.5,), (None,)], "x double")
    got = [r[0] for r in df.select(round_half_away(F.col("x"), 2)).collect()]
    assert got == [1.0, 0.28, -0.13, 2.5, None]


def test_int_cast_rounds_like_the_reference(spark):  # T1
    dec = spark.createDataFrame([(2.5,), (3.5,), (-2.5,)], "x double").select(
        F.col("x").cast("decimal(18,3)").alias("x"))
    got = [r[0] for r in dec.select(to_int_nearest(F.col("x"), DecimalType(18, 3))).collect()]
    assert got == [3, 4, -3]
    dbl = spark.createDataFrame([(2.5,), (3.5,), (-2.5,)], "x double")
    got = [r[0] for r in dbl.select(to_int_nearest(F.col("x"), DoubleType())).collect()]
    assert got == [2, 4, -2]


def test_interval_text_forms(spark):  # T9
    df = spark.createDataFrame(
        [("00:12:34",), ("-00:01:05",), ("30:00:00",), ("0 days 00:12:34",), ("1 day 00:00:01",),
         (None,)], "s string")
    got = [r[0] for r in df.select(interval_seconds(parse_interval(F.col("s")))).collect()]
    assert got == [754.0, -65.0, 108000.0, 754.0, 86401.0, None]
    with pytest.raises(Exception, match="not a duration"):  # never a silent NULL
        spark.createDataFrame([("garbage",)], "s string").select(
            interval_seconds(parse_interval(F.col("s")))).collect()


def test_weekday_name_sunday_first(spark):  # X11
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 12),), (dt.datetime(2024, 1, 8),), (None,)],
                               "t timestamp_ntz")
    assert [r[0] for r in df.select(weekday_name(F.col("t"))).collect()] == ["sun", "mon", "invalid"]
