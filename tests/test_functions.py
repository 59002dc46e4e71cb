"""Edge cases of the column builders."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from meterline.functions.columns import (
    as_decimal_2, day_of_week_sunday0, exact_avg, exact_sum, guarded_ratio, minute_boundaries,
    month_boundaries, null_safe_sum, round_to, text_key_equals, unit_boundaries,
)


def one(spark, col, data, schema):
    return spark.createDataFrame(data, schema).select(col.alias("v")).collect()


def test_minute_boundaries(spark):
    a, b = dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 2, 1)
    df = spark.createDataFrame([(a, b), (b, a), (a, a), (None, b)], "s timestamp_ntz, e timestamp_ntz")
    got = [r.v for r in df.select(minute_boundaries("s", "e").alias("v")).collect()]
    assert got == [2, -2, 0, None]


def test_hour_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 31, 23, 59), dt.datetime(2024, 2, 1, 0, 0))],
                               "s timestamp_ntz, e timestamp_ntz")
    assert df.select(unit_boundaries("s", "e", "hour").alias("v")).first().v == 1


def test_month_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), dt.date(2024, 2, 1)),
                                (dt.date(2023, 12, 1), dt.date(2024, 1, 31)),
                                (dt.date(2024, 3, 1), dt.date(2024, 1, 1))], "s date, e date")
    assert [r.v for r in df.select(month_boundaries("s", "e").alias("v")).collect()] == [1, 1, -2]


def test_day_of_week_sunday_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 12),), (dt.datetime(2024, 1, 13, 1),)], "t timestamp_ntz")
    assert [r.v for r in df.select(day_of_week_sunday0("t").alias("v")).collect()] == [0, 6]


def test_decimal_cast_scales_first(spark):
    # x * 100 is rounded in binary: 1.005 -> 100.49999999999999 -> 1.00,
    # 2.675 -> 267.5 -> 2.68, 0.285 -> 28.499999999999996 -> 0.28
    df = spark.createDataFrame([(1.005,), (2.675,), (0.285,), (-1.005,), (None,)], "x double")
    got = [r.v for r in df.select(as_decimal_2("x").alias("v")).collect()]
    assert got == [Decimal("1.00"), Decimal("2.68"), Decimal("0.28"), Decimal("-1.00"), None]


def test_null_safe_sum(spark):
    df = spark.createDataFrame([(1.0, None, 2.0)], "a double, b double, c double")
    assert df.select(null_safe_sum("a", "b", "c").alias("v")).first().v == 3.0


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(10.0, 4.0), (10.0, 0.0), (10.0, None), (10.0, -1.0)], "n double, d double")
    assert [r.v for r in df.select(guarded_ratio("n", "d").alias("v")).collect()] == [2.5, 0.0, 0.0, 0.0]


def test_text_key_equals_numeric_and_junk(spark):
    df = spark.createDataFrame([("1.0", 1), ("2", 1), ("x", 1), (None, 1)], "k string, d int")
    got = [r.v for r in df.select(text_key_equals(F.col("k"), F.col("d"), IntegerType()).alias("v")).collect()]
    assert got == [True, False, None, None]
    big = spark.createDataFrame([("9007199254740993", 9007199254740992)], "k string, d long")
    assert big.select(text_key_equals(F.col("k"), F.col("d"), IntegerType()).alias("v")).first().v is False
    df2 = spark.createDataFrame([("a", "a")], "k string, d string")
    assert df2.select(text_key_equals(F.col("k"), F.col("d"), StringType()).alias("v")).first().v


def test_round_to_binary_half_away(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (2.5,), (1.0049999999999999,)], "x double")
    got = [r.v for r in df.select(round_to("x", 2).alias("v")).collect()]
    assert got == [0.13, -0.13, 2.5, 1.0]


def test_exact_sum_is_order_free(spark):
    vals = [(0.1,), (0.2,), (0.3,), (1e6 + 0.05,), (None,)]
    df = spark.createDataFrame(vals, "x double")
    a = df.repartition(5).agg(exact_sum("x").alias("s"), exact_avg("x").alias("m")).first()
    b = df.coalesce(1).agg(exact_sum("x").alias("s"), exact_avg("x").alias("m")).first()
    assert a == b and a.s == 1000000.65
    empty = spark.createDataFrame([(None,)], "x double").agg(exact_avg("x").alias("m")).first()
    assert empty.m is None


def test_exact_total_equals_decimal_sum(spark):
    from meterline.functions.columns import exact_total
    df = spark.range(0, 20000).select(((F.col("id") * 7919 % 200001) / 1000.0 - 100).alias("x"))
    want = df.agg(F.sum(F.col("x").cast("decimal(38,6)")).alias("s")).first().s
    for n in (1, 7):
        got = df.repartition(n).agg(exact_total("x").alias("s")).first().s
        assert got == want
