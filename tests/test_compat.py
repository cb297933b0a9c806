from pyspark.sql import functions as F
from pyspark.sql import types as T

from agora.functions import compat
from tests.conftest import ts


def one(spark, expr, value=None, schema="x timestamp_ntz"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr.alias("r")).first()["r"]


def test_days_between_counts_midnights(spark):
    df = spark.createDataFrame([(ts("2018-01-01 23:00:00"), ts("2018-01-02 01:00:00"))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(compat.days_between("a", "b").alias("d")).first()["d"] == 1
    assert dict(df.select(compat.days_between("a", "b").alias("d")).dtypes)["d"] == "bigint"


def test_day_of_week_sunday_zero(spark):
    assert one(spark, compat.day_of_week_sun0("x"), ts("2018-01-07 10:00:00")) == 0  # Sunday
    assert one(spark, compat.day_of_week_sun0("x"), ts("2018-01-06 10:00:00")) == 6  # Saturday


def test_trunc_week_starts_monday(spark):
    # a Sunday belongs to the week that started the Monday before
    assert one(spark, compat.trunc_ts("week", "x"), ts("2018-01-07 10:00:00")) == ts("2018-01-01")
    assert one(spark, compat.trunc_ts("month", "x"), ts("2018-02-17 10:00:00")) == ts("2018-02-01")
    assert one(spark, compat.trunc_ts("quarter", "x"), ts("2018-05-17 10:00:00")) == ts("2018-04-01")


def test_trunc_returns_zone_less_timestamp(spark):
    df = spark.createDataFrame([(ts("2018-01-07 10:00:00"),)], "x timestamp_ntz")
    assert dict(df.select(compat.trunc_ts("month", "x").alias("m")).dtypes)["m"] == "timestamp_ntz"


def test_float_ratio_is_32_bit(spark):
    df = spark.createDataFrame([(5, 3)], "a bigint, b bigint")
    out = df.select(compat.float_ratio("a", "b").alias("r"))
    assert isinstance(out.schema["r"].dataType, T.FloatType)
    assert abs(out.first()["r"] - 1.6666666269302368) < 1e-12


def test_to_int_rounds_half_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-2.5,), (2.4,)], "x double")
    got = [r["r"] for r in df.select(compat.to_int("x", T.DoubleType()).alias("r")).collect()]
    assert got == [2, 4, -2, 2]


def test_round_half_away_matches_sql_double_rounding(spark):
    df = spark.createDataFrame([(525.675,), (2.5,), (-2.5,), (1.005,), (None,)], "x double")
    got = [r["r"] for r in df.select(compat.round_half_away("x", 2).alias("r")).collect()]
    assert got == [525.67, 2.5, -2.5, 1.0, None]
    df0 = spark.createDataFrame([(2.5,), (-2.5,), (0.49999999999999994,)], "x double")
    got0 = [r["r"] for r in df0.select(compat.round_half_away("x", 0).alias("r")).collect()]
    assert got0 == [3.0, -3.0, 0.0]


def test_sum_flag_null_is_false(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert df.agg(compat.sum_flag(F.col("b")).alias("n")).first()["n"] == 1


def test_weighted_avg_equals_plain_avg(spark):
    items = spark.createDataFrame([(1, 3), (1, 3), (1, None), (2, 5)], "k int, v int")
    plain = items.groupBy("k").agg(F.avg("v").alias("a"))
    collapsed = (items.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
                 .groupBy("k").agg(compat.weighted_avg("v", "n").alias("a")))
    assert sorted(plain.collect()) == sorted(collapsed.collect())


def test_float_ratio_of_large_counts(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from agora.functions.compat import float_ratio

    pairs = [(16_777_217, 3), (33_554_433, 33_554_435), (123_456_789_012, 987_654_321_098),
             (2**53 + 1, 7), (1, 3), (5, 16_777_219)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    for r in df.select("a", "b", float_ratio(F.col("a"), F.col("b")).alias("x")).collect():
        assert np.float32(r.x) == np.float32(r.a) / np.float32(r.b)
