import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from agora.operators.ranking import global_rank
from tests.conftest import rows


def _data(spark, n, seed=7):
    rnd = random.Random(seed)
    recs = [(i, rnd.choice([None, 1.0, 2.0, 2.0, 3.5, rnd.random()])) for i in range(n)]
    return spark.createDataFrame(recs, "id bigint, v double")


def _expected(df, direction, k):
    order = F.col("v").desc_nulls_last() if direction == "desc" else F.col("v").asc_nulls_last()
    w = Window.orderBy(order, F.col("id").asc())
    return df.select("id", F.row_number().over(w).alias("rn"), F.ntile(k).over(w).alias("nt"))


def test_matches_single_partition_window(spark):
    df = _data(spark, 503)
    for direction in ("asc", "desc"):
        for k in (5, 10, 7):
            got = global_rank(df, [("v", direction), ("id", "asc")], row_number="rn",
                              ntiles={"nt": k}, num_partitions=6)
            assert rows(got, "id", "rn", "nt") == rows(_expected(df, direction, k), "id", "rn", "nt")


def test_fewer_rows_than_buckets(spark):
    df = _data(spark, 3)
    got = global_rank(df, [("v", "asc"), ("id", "asc")], ntiles={"nt": 10}, num_partitions=4)
    assert sorted(r["nt"] for r in got.collect()) == [1, 2, 3]
    assert rows(got, "id", "nt") == rows(_expected(df, "asc", 10), "id", "nt")


def test_empty_input(spark):
    df = _data(spark, 5).where(F.lit(False))
    got = global_rank(df, [("v", "asc"), ("id", "asc")], row_number="rn", ntiles={"nt": 5})
    assert got.count() == 0
    assert got.columns == ["id", "v", "rn", "nt"]


def test_bucket_sizes_differ_by_at_most_one(spark):
    df = _data(spark, 1001)
    got = global_rank(df, [("v", "desc"), ("id", "asc")], ntiles={"nt": 10}, num_partitions=8)
    sizes = [r["c"] for r in got.groupBy("nt").agg(F.count(F.lit(1)).alias("c")).collect()]
    assert len(sizes) == 10 and max(sizes) - min(sizes) <= 1 and sum(sizes) == 1001


def test_plan_has_no_single_partition_exchange(spark):
    from agora.operators.ranking import positions

    df = _data(spark, 200)
    order = [("v", "desc"), ("id", "asc")]
    got = global_rank(df, order, row_number="rn", num_partitions=4)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "Window" not in plan
    ranked, total = positions(df, order, num_partitions=4)
    assert ranked.rdd.getNumPartitions() == 4 and total == 200
    assert ranked.columns == ["v", "id", "_gpos", "_gtotal"]      # other columns stay behind


def test_same_ranks_for_any_number_of_range_partitions(spark):
    df = _data(spark, 503)
    want = rows(_expected(df, "asc", 5), "id", "rn", "nt")
    for n in (None, 1, 2, 9):
        got = global_rank(df, [("v", "asc"), ("id", "asc")], row_number="rn", ntiles={"nt": 5},
                          num_partitions=n)
        assert rows(got, "id", "rn", "nt") == want


def test_several_orderings(spark):
    from agora.operators.ranking import global_ranks

    df = _data(spark, 503)
    got = global_ranks(df, [([("v", "asc"), ("id", "asc")], "rn_asc", {"nt_asc": 5}),
                            ([("v", "desc"), ("id", "asc")], "rn_desc", {"nt_desc": 10})])
    asc = _expected(df, "asc", 5).withColumnRenamed("rn", "rn_asc").withColumnRenamed("nt", "nt_asc")
    desc = _expected(df, "desc", 10).withColumnRenamed("rn", "rn_desc").withColumnRenamed("nt", "nt_desc")
    want = asc.join(desc, "id")
    cols = ("id", "rn_asc", "nt_asc", "rn_desc", "nt_desc")
    assert rows(got, *cols) == rows(want, *cols)


def _joins(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    return plan.count("Join")


def test_one_ordering_is_ranked_in_place(spark):
    df = _data(spark, 200).withColumn("wide", F.lit("x"))
    got = global_rank(df, [("v", "asc"), ("id", "asc")], row_number="rn", ntiles={"nt": 5})
    assert _joins(got) == 0 and got.columns == ["id", "v", "wide", "rn", "nt"]


def test_buckets_of_several_orderings_come_from_cut_points(spark):
    """No join and no shuffle of the rows; equal to ntile windows, ties and NULLs included."""
    from agora.operators.ranking import global_ranks

    rnd = random.Random(3)
    recs = [(i, rnd.choice([None, 0.0, -0.0, float("nan"), 1.5, 1.5, -2.0]),
             rnd.choice([None, "a", "b", "b", "é"]), rnd.choice([None, 1, 2])) for i in range(311)]
    df = spark.createDataFrame(recs, "id bigint, v double, s string, n int").repartition(5)
    orders = {"a": ([("v", "asc"), ("id", "asc")], 5), "b": ([("s", "desc"), ("id", "desc")], 10),
              "c": ([("n", "desc"), ("v", "asc"), ("id", "asc")], 7), "d": ([("id", "asc")], 400)}
    got = global_ranks(df, [(order, None, {name: k}) for name, (order, k) in orders.items()
                            if name != "d"], num_partitions=6)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "Window" not in plan
    # more buckets than cut points are wanted for: joined back, same result
    got = global_ranks(df, [(order, None, {name: k}) for name, (order, k) in orders.items()])
    want = df.select("id", *[
        F.ntile(k).over(Window.orderBy(*[F.col(c).desc_nulls_last() if d == "desc"
                                         else F.col(c).asc_nulls_last() for c, d in order])).alias(name)
        for name, (order, k) in orders.items()])
    assert rows(got, "id", *orders) == rows(want, "id", *orders)


def test_cut_points_of_few_or_no_rows(spark):
    from agora.operators.ranking import bucket_starts, global_ranks

    assert bucket_starts(3, 5) == [1, 2] and bucket_starts(10, 3) == [4, 7] and bucket_starts(0, 5) == []
    specs = [([("v", "asc"), ("id", "asc")], None, {"a": 5}), ([("id", "desc")], None, {"b": 5})]
    got = global_ranks(_data(spark, 3), specs)
    assert sorted(r["a"] for r in got.collect()) == [1, 2, 3]
    assert global_ranks(_data(spark, 0), specs).count() == 0


def test_segmentation_needs_no_join_after_the_dimension(spark):
    from agora.operators.ranking import global_ranks
    from agora.plans.pipeline import from_testdata
    from agora.plans.rfm import rfm_scores

    p = from_testdata(spark, "/root/testdata/sf0.001")
    assert _joins(rfm_scores(p.dim_customers)) == 0
    specs = [([("total_revenue", "desc"), ("seller_id", "asc")], "revenue_rank", {"decile": 10}),
             ([("avg_review_score", "desc"), ("seller_id", "asc")], "review_rank", None)]
    assert _joins(global_ranks(p.dim_sellers, specs)) == 1       # the further row number
