"""A third of the rows under one order, product or customer: spread by weight or combined
map-side, at default AQE ratios, with the same results."""

from pyspark.sql import functions as F

from agora.operators.skew import hot_keys, left_lookup
from agora.plans.enrich import order_items_summary, order_payments_summary
from agora.plans.pipeline import Pipeline, from_testdata
from tests.conftest import conf, rows

SF = "/root/testdata/sf0.001"


def _skewed(spark, table: str, column: str, by: str) -> Pipeline:
    """A third of the rows of ``table`` get the same ``column``."""
    raw = dict(from_testdata(spark, SF).raw)
    df = raw[table]
    raw[table] = df.withColumn(column, F.when(F.col(by) % 3 == 0, F.lit(7).cast(df.schema[column].dataType))
                               .otherwise(F.col(column))).repartition(8)
    return Pipeline(raw)


SPREAD = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "100",
          "spark.sql.autoBroadcastJoinThreshold": "-1",
          "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def test_lookup_spreads_a_hot_key_and_null_keys(spark):
    many = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 7).when(
        F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 900).cast("bigint").alias("k"))
    one = spark.range(600).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    with conf(spark, **SPREAD):
        got = left_lookup(many, one, "k", F.col("id"), share=50)
        largest = (got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0])
        assert largest < 30_000 * 0.05
        want = many.join(one, "k", "left").select("id", "k", "v")
        assert rows(got, "id", "k", "v") == rows(want, "id", "k", "v")
        hot = hot_keys(many, "k", share=50)
        assert [r[0] for r in hot.collect()] == [7]
        assert left_lookup(many.limit(0), one, "k", F.col("id")).count() == 0
        assert left_lookup(many.limit(3), one.limit(0), "k", F.col("id")).where("v IS NULL").count() == 3


def test_hot_order_is_combined_map_side(spark):
    p = _skewed(spark, "order_items", "order_id", "order_item_id")
    items = p.stg_order_items
    got = {r.order_id: r for r in order_items_summary(items).collect()}
    want = items.groupBy("order_id").agg(
        F.count("*").alias("n"), F.countDistinct("product_id").alias("p"),
        F.countDistinct("seller_id").alias("s"), F.sum("total_item_value").alias("g")).collect()
    assert len(got) == len(want)
    assert all((got[r.order_id].item_count, got[r.order_id].distinct_products,
                got[r.order_id].distinct_sellers, got[r.order_id].gross_order_value)
               == (r.n, r.p, r.s, r.g) for r in want)
    for df in (order_items_summary(items), order_payments_summary(p.stg_order_payments)):
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        # every shuffle moves partial aggregates, and no set is collected
        for above in plan.split("Exchange hashpartitioning")[1:]:
            assert "partial_" in above.split("Exchange")[0].split("+-")[1]
        assert "collect_set" not in plan and "REPARTITION_BY_COL" not in plan


def test_null_products_and_sellers_are_not_counted(spark):
    items = spark.createDataFrame(
        [(1, None, 5, 1.0, 1.0, 2.0), (1, 2, None, 1.0, None, None), (1, 2, 5, 1.0, 1.0, 2.0),
         (None, 3, 4, 1.0, 1.0, 2.0)],
        "order_id int, product_id int, seller_id int, item_price double, freight_value double, "
        "total_item_value double")
    got = rows(order_items_summary(items), "order_id", "item_count", "distinct_products",
               "distinct_sellers", "items_revenue", "freight_revenue", "gross_order_value")
    assert got == [(1, 3, 1, 1, 3.0, 2.0, 4.0), (None, 1, 1, 1, 1.0, 1.0, 2.0)]


def test_hot_product_and_customer_joins_are_spread(spark):
    with conf(spark, **SPREAD):
        for table, column, by, model in (
                ("order_items", "product_id", "order_item_id", "mart_revenue_monthly"),
                ("orders", "customer_id", "order_id", "fct_orders")):
            df = _skewed(spark, table, column, by).model(model)
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert f"hashpartitioning({column}" in plan and "_part#" in plan, model
        fct = _skewed(spark, "orders", "customer_id", "order_id").fct_orders
        assert fct.count() == 1500 and fct.where("customer_state IS NULL").count() == 0


def _shuffles(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("Initial Plan")[-1].count("Exchange hashpartitioning")


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def test_order_grain_shuffles_are_combined_map_side(spark):
    with conf(spark, **NO_BROADCAST):
        df = from_testdata(spark, SF).int_orders_enriched
        assert _shuffles(df) <= 6          # orders, reviews; items and payments at two grains
        scans = df._jdf.queryExecution().executedPlan().toString().count("/lineitem.parquet")
        assert scans == 1


def test_hot_customer_is_one_row_before_the_join(spark):
    raw = dict(from_testdata(spark, SF).raw)
    hot = F.col("order_id") % 3 == 0
    raw["orders"] = raw["orders"].withColumn(
        "customer_id", F.when(hot, F.lit(7).cast("bigint")).otherwise(F.col("customer_id")))
    pipe = Pipeline(raw)
    got = {r.customer_unique_id: r for r in pipe.int_customer_order_history.collect()}
    kept = pipe.int_orders_enriched.where("order_status NOT IN ('canceled', 'unavailable')")
    of_seven = kept.where("customer_id IN (6, 7)").agg(
        F.count("order_id"), F.sum("gross_order_value"), F.avg("review_score")).first()
    assert (got[6].total_orders, got[6].lifetime_value, got[6].avg_review_score) == tuple(of_seven)
    with conf(spark, **NO_BROADCAST):      # default skew ratios: nothing depends on a split
        plan = Pipeline(raw).int_customer_order_history._jdf.queryExecution().executedPlan().toString()
    join = plan.index("SortMergeJoin")
    assert "HashAggregate(keys=[customer_id" in plan[join:]    # aggregated below the join
