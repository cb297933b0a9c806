"""Analytics marts: monthly revenue, delivery performance, seller health."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.functions.compat import days_between, float_ratio, sum_flag, trunc_ts
from agora.operators.ranking import global_ranks
from agora.operators.skew import left_lookup

REVENUE_STATUSES = ("delivered", "shipped", "processing", "approved")


def mart_revenue_monthly(items: DataFrame, categories: DataFrame,
                         orders: DataFrame) -> DataFrame:
    """Revenue by (month, quarter, English category, primary payment type).

    Items are attributed to their product's category; an order spanning two
    categories counts once in each. Items collapse map-side to (order, product)
    pairs before the category join, in which a product that is in a third of
    all items is spread by its weight; the pairs roll up to (order, category)
    before they meet the orders. ``categories`` holds (product_id, category_name_english).
    """
    pairs = items.groupBy("order_id", "product_id").agg(
        F.sum(F.col("item_price") + F.col("freight_value")).alias("gross"),
        F.sum("item_price").alias("items"),
        F.sum("freight_value").alias("freight"))
    per_pair = (left_lookup(pairs, categories.select("product_id", "category_name_english"),
                            "product_id", spread=F.col("order_id"), keys=items)
                .groupBy("order_id",
                         F.coalesce("category_name_english", F.lit("unknown"))
                          .alias("category_name_english"))
                .agg(F.sum("gross").alias("gross"), F.sum("items").alias("items"),
                     F.sum("freight").alias("freight")))
    base = (orders.where(F.col("order_status").isin(*REVENUE_STATUSES))
            .select("order_id", "order_month",
                    trunc_ts("quarter", "purchased_at").alias("order_quarter"),
                    "primary_payment_type"))
    joined = base.join(per_pair, "order_id", "inner")
    out = joined.groupBy("order_month", "order_quarter", "category_name_english",
                         "primary_payment_type").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("gross").alias("gross_order_value"),
        F.sum("items").alias("items_revenue"),
        F.sum("freight").alias("freight_revenue"))
    return (out.withColumn("avg_order_value",
                           F.col("gross_order_value") / F.nullif("order_count", F.lit(0)))
               .orderBy(F.col("order_month").asc_nulls_last(),
                        F.col("category_name_english").asc_nulls_last()))


def mart_delivery_performance(fct_orders: DataFrame, items: DataFrame) -> DataFrame:
    """Delivered orders by (customer state, seller); an order counts once per seller in it.

    The order fact already holds each order's customer state, so the order
    rows are joined to their distinct sellers once, on order_id.
    """
    delivered_at, estimated = F.col("delivered_at"), F.col("estimated_delivery_at")
    delivered = (fct_orders.where(F.col("order_status") == "delivered")
                 .select("order_id", "customer_state", "days_to_deliver", "is_late_delivery",
                         "review_score", "review_sentiment", "order_month",
                         F.when(delivered_at.isNotNull() & estimated.isNotNull(),
                                days_between(estimated, delivered_at)).alias("days_late")))
    order_sellers = items.select("order_id", "seller_id").distinct()
    base = delivered.join(order_sellers, "order_id", "inner")
    late = F.col("is_late_delivery")
    out = base.groupBy("customer_state", "seller_id").agg(
        F.count(F.lit(1)).alias("delivered_orders"),
        F.sum(F.when(late, 0).otherwise(1)).cast("bigint").alias("on_time_orders"),
        sum_flag(late).alias("late_orders"),
        F.avg("days_late").alias("avg_days_late"),
        F.avg(F.when(late, F.col("days_late"))).alias("avg_days_late_when_late"),
        F.avg("days_to_deliver").alias("avg_days_to_deliver"),
        F.avg("review_score").alias("avg_review_score"),
        F.avg(F.when(late, F.col("review_score"))).alias("avg_review_score_when_late"),
        F.avg(F.when(~late, F.col("review_score"))).alias("avg_review_score_when_on_time"),
        sum_flag(F.col("review_sentiment") == "positive").alias("positive_reviews"),
        sum_flag(F.col("review_sentiment") == "negative").alias("negative_reviews"),
        F.countDistinct("order_month").alias("active_months"))
    rate = float_ratio("late_orders", F.nullif("delivered_orders", F.lit(0)))
    return (out.select("customer_state", "seller_id", "delivered_orders", "on_time_orders",
                       "late_orders", rate.alias("late_delivery_rate"),
                       "avg_days_late", "avg_days_late_when_late", "avg_days_to_deliver",
                       "avg_review_score", "avg_review_score_when_late",
                       "avg_review_score_when_on_time", "positive_reviews", "negative_reviews",
                       "active_months")
               .orderBy(F.col("late_delivery_rate").desc_nulls_last()))


def state_concentration(sellers: DataFrame) -> DataFrame:
    """Sellers per state and their share (%) of all sellers.

    The total is a scalar subquery over the per-state counts: no second pass
    over the sellers, and no window that gathers rows into one task.
    """
    per_state = sellers.groupBy("state").agg(F.count(F.lit(1)).alias("sellers_in_state"))
    total = per_state.agg(F.sum("sellers_in_state").cast("double")).scalar()
    return per_state.select(
        "state", "sellers_in_state",
        (F.col("sellers_in_state") * F.lit(100.0) / total).alias("pct_of_all_sellers"))


SELLER_HEALTH_COLUMNS = (
    "seller_id", "state", "city", "seller_lat", "seller_lng", "seller_tier", "quality_tier",
    "is_risk_seller", "revenue_rank", "review_rank", "revenue_decile", "is_top_10_seller",
    "total_orders", "total_items_sold", "distinct_products", "total_revenue", "avg_item_price",
    "avg_days_to_deliver", "late_delivery_rate", "avg_review_score", "one_star_reviews",
    "five_star_reviews", "one_star_rate", "sellers_in_state", "pct_sellers_in_state")


def mart_seller_health(dim_sellers: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Sellers with orders, ranked globally by revenue and by review score.

    Ties in a ranking are broken by seller_id. Both rankings are distributed
    (range partitions + offsets), never a single-partition window.
    """
    active = dim_sellers.where(F.col("total_orders") > 0)
    ranked = global_ranks(active, [
        ([("total_revenue", "desc"), ("seller_id", "asc")], "revenue_rank", {"revenue_decile": 10}),
        ([("avg_review_score", "desc"), ("seller_id", "asc")], "review_rank", None),
    ], num_partitions=num_partitions)
    share = state_concentration(dim_sellers).select(
        "state", "sellers_in_state", F.col("pct_of_all_sellers").alias("pct_sellers_in_state"))
    joined = ranked.alias("r").join(share.alias("sc"), F.col("r.state") == F.col("sc.state"), "left")
    flagged = joined.select(
        "r.*", "sc.sellers_in_state", "sc.pct_sellers_in_state",
        (F.col("r.revenue_rank") <= 10).alias("is_top_10_seller"))
    return flagged.select(*SELLER_HEALTH_COLUMNS).orderBy("revenue_rank")
