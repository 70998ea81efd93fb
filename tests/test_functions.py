import math

import pytest
from pyspark.sql import functions as F

from renewlens import functions as fn
from renewlens.functions.columns import day, hash_bucket


def _values(spark, rows, schema, expression):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expression).collect()]


def test_bands_follow_the_rounded_score(spark):
    raw = [0.0, 0.4, 0.40004, 0.4001, 0.7, 0.7001, 1.0, None, -0.5, 1.5]
    bands = _values(
        spark, [(x,) for x in raw], "s double", fn.risk_band(fn.rounded_score("s"))
    )
    assert bands == [
        "Low", "Low", "Low", "Medium", "Medium", "High", "High", None, None, None
    ]


def test_scores_round_half_to_even(spark):
    got = _values(spark, [(0.00005,), (0.00015,), (0.12345,)], "s double", fn.rounded_score("s"))
    assert got == [0.0, 0.0002, 0.1234]


def test_keys_grow_instead_of_losing_digits(spark):
    got = _values(
        spark, [(7,), (99_999,), (100_000,), (10_000,)], "i bigint",
        fn.padded_key("ACC-", F.col("i"), 5),
    )
    assert got == ["ACC-00007", "ACC-99999", "ACC-100000", "ACC-10000"]


def test_ratios(spark):
    rows = [(4.0, 2.0), (4.0, 0.0), (4.0, -2.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "n double, d double")
    got = df.select(fn.ratio_or_null("n", "d"), fn.ratio_or_zero("n", "d")).collect()
    assert [tuple(r) for r in got] == [(2.0, 2.0), (None, 0.0), (None, -2.0), (None, 0.0)]


@pytest.mark.parametrize("value, floored", [(-1.0, 0.0), (None, 0.0), (0.0, 0.0), (5.5, 5.5)])
def test_floor(spark, value, floored):
    assert _values(spark, [(value,)], "m double", fn.floor_at_zero("m")) == [floored]


def test_unknown_category(spark):
    assert _values(spark, [(None,), ("x",)], "c string", fn.or_unknown("c")) == ["Unknown", "x"]


def test_texts(spark):
    rows = [(1234567.5,), (-5.0,), (0.1234,), (None,)]
    assert _values(spark, rows, "x double", fn.usd_text("x")) == ["$1,234,568", "$-5", "$0", None]
    assert _values(spark, rows[2:], "x double", fn.percent_text("x")) == ["12.3%", None]


def test_plan_order(spark):
    rows = [("Enterprise",), ("Starter",), ("Growth",), ("Other",)]
    assert _values(spark, rows, "plan_type string", fn.plan_rank()) == [3, 1, 2, 0]


def test_sum_does_not_depend_on_order(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(1e9,), (-1e9,), (None,)], "x double")
    total = fn.exact_sum("x").alias("t")
    assert df.agg(total).first().t == df.orderBy("x").agg(total).first().t == 1.0


def test_sum_keeps_small_parts_and_survives_odd_amounts(spark):
    tiny = spark.range(1000).select(F.lit(0.004).alias("x"))
    assert tiny.agg(fn.exact_sum("x")).first()[0] == 4.0
    odd = spark.createDataFrame([(1.5,), (float("inf"),), (None,)], "x double")
    assert odd.agg(fn.exact_sum("x")).first()[0] == float("inf")
    nan = spark.createDataFrame([(1.5,), (float("nan"),), (2.0,)], "x double")
    assert math.isnan(nan.agg(fn.exact_sum("x")).first()[0])
    huge = spark.createDataFrame([(1e300,), (-1e300,), (0.25,)], "x double")
    assert huge.agg(fn.exact_sum("x")).first()[0] == 0.25
    mixed = spark.createDataFrame([(-0.000001,), (-7.25,), (1e12,)], "x double")
    assert mixed.agg(fn.exact_sum("x")).first()[0] == 1e12 - 7.250001


def test_sum_outgrows_64_bits(spark):
    df = spark.range(200).select((F.lit(9.0e16) * F.when(F.col("id") < 150, 1).otherwise(-1)).alias("x"))
    assert df.agg(fn.exact_sum("x")).first()[0] == 9.0e18
    df = spark.createDataFrame([(-0.01,), (-1234.56,), (0.0,)], "x double")
    assert df.agg(fn.exact_sum("x")).first()[0] == -1234.57
    assert df.filter("x > 1").agg(fn.exact_sum("x")).first()[0] is None


def test_day_literal_and_buckets(spark):
    df = spark.range(2000).withColumn("k", F.col("id").cast("string"))
    assert str(df.select(day("2024-04-14")).first()[0]) == "2024-04-14"
    for bucket in (fn.md5_bucket, hash_bucket):
        hit = df.filter(bucket(F.col("k"), "a") < 10).count()
        both = df.filter((bucket(F.col("k"), "a") < 10) & (bucket(F.col("k"), "b") < 10)).count()
        assert 130 < hit < 270
        assert both < 60
