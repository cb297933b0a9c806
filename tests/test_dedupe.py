import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from agora.operators.dedupe import first_by, pick_one
from tests.conftest import rows

DATA = [
    # key, a (double), b (string), id
    (1, 3.0, "x", 1), (1, 3.0, "y", 2), (1, None, "z", 3),
    (2, None, "a", 4), (2, None, "b", 5),
    (3, -1.0, None, 6), (3, 5.0, None, 7), (3, 5.0, "c", 8),
]


def _window_first(df, order):
    cols = [F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_last()
            for c, d in order]
    w = Window.partitionBy("k").orderBy(*cols)
    return df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


@pytest.mark.parametrize("order", [
    [("a", "desc"), ("id", "desc")],
    [("a", "asc"), ("id", "asc")],
    [("a", "desc"), ("b", "asc"), ("id", "asc")],   # mixed: numeric key negated
    [("b", "desc"), ("a", "asc"), ("id", "desc")],
])
def test_pick_one_equals_row_number(spark, order):
    df = spark.createDataFrame(DATA, "k int, a double, b string, id int")
    got = pick_one(df, ["k"], order)
    assert got.columns == ["k", "a", "b", "id"]
    assert rows(got) == rows(_window_first(df, order).select("k", "a", "b", "id"))


def test_first_by_aggregate(spark):
    df = spark.createDataFrame(DATA, "k int, a double, b string, id int")
    order = [("a", "desc"), ("b", "asc")]
    got = df.groupBy("k").agg(first_by("b", order, df).alias("b"))
    assert rows(got) == [(1, "x"), (2, "a"), (3, "c")]


def test_non_numeric_keys_in_two_directions_rejected(spark):
    df = spark.createDataFrame([(1, "a", "b")], "k int, s string, t string")
    with pytest.raises(ValueError):
        pick_one(df, ["k"], [("s", "asc"), ("t", "desc")])
