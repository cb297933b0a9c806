"""Analyst questions the marts are built to answer, as queries over the marts.

Each takes already-built marts and aggregates them further; all are grouped
aggregates (partial, map-side combined) over small mart tables, except
``delay_review_correlation`` which is one global aggregate over the order fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.functions.compat import days_between, round_half_away
from agora.plans.marts import REVENUE_STATUSES, state_concentration


def gmv_trend(revenue_monthly: DataFrame, grain: str = "month") -> DataFrame:
    """GMV, item revenue and freight per month (or quarter)."""
    key = {"month": "order_month", "quarter": "order_quarter"}[grain]
    return (revenue_monthly.groupBy(key).agg(
                F.sum("gross_order_value").alias("gmv"),
                F.sum("items_revenue").alias("items_revenue"),
                F.sum("freight_revenue").alias("freight_revenue"))
            .orderBy(key))


def category_revenue_vs_volume(revenue_monthly: DataFrame) -> DataFrame:
    """Per category, revenue against order volume.

    Within one category an order has one month and one payment type, so
    summing order_count over the mart counts each order once.
    """
    return (revenue_monthly.groupBy("category_name_english").agg(
                F.sum("items_revenue").alias("items_revenue"),
                F.sum("gross_order_value").alias("gmv"),
                F.sum("order_count").alias("orders"))
            .orderBy(F.col("items_revenue").desc(), "category_name_english"))


def aov_by_payment_type(fct: DataFrame) -> DataFrame:
    """Average order value per primary payment type, from the order fact
    (the revenue mart counts an order once per category)."""
    return (fct.where(F.col("order_status").isin(*REVENUE_STATUSES))
               .groupBy("primary_payment_type").agg(
                   F.count(F.lit(1)).alias("orders"),
                   F.sum("gross_order_value").alias("gmv"),
                   F.avg("gross_order_value").alias("avg_order_value"))
               .orderBy(F.col("avg_order_value").desc()))


def on_time_share(delivery: DataFrame) -> DataFrame:
    """Share of delivered (order, seller) rows on time vs late: ratio of sums."""
    totals = delivery.agg(F.sum("delivered_orders").alias("delivered_orders"),
                          F.sum("on_time_orders").alias("on_time_orders"),
                          F.sum("late_orders").alias("late_orders"))
    return totals.select(
        "*",
        (F.col("on_time_orders") * F.lit(100.0) / F.col("delivered_orders")).alias("pct_on_time"),
        (F.col("late_orders") * F.lit(100.0) / F.col("delivered_orders")).alias("pct_late"))


def _late_rollup(delivery: DataFrame, key: str) -> DataFrame:
    return (delivery.groupBy(key).agg(
                F.sum("delivered_orders").alias("delivered_orders"),
                F.sum("late_orders").alias("late_orders"),
                F.count(F.lit(1)).alias("pairs"))
            .withColumn("late_rate", F.col("late_orders") / F.col("delivered_orders"))
            .orderBy(F.col("late_rate").desc(), key))


def worst_delivery_states(delivery: DataFrame) -> DataFrame:
    """Customer states by late rate (weighted: late / delivered)."""
    return _late_rollup(delivery, "customer_state").withColumnRenamed("pairs", "sellers")


def late_sellers(delivery: DataFrame) -> DataFrame:
    """Sellers by late rate over all their delivered orders."""
    return _late_rollup(delivery, "seller_id").withColumnRenamed("pairs", "states")


def delay_review_correlation(fct: DataFrame) -> DataFrame:
    """Pearson correlation of days late and review score, delivered orders."""
    delivered = fct.where(F.col("order_status") == "delivered").select(
        days_between("estimated_delivery_at", "delivered_at").cast("double").alias("days_late"),
        F.col("review_score").cast("double").alias("review_score"))
    both = delivered.where(F.col("days_late").isNotNull() & F.col("review_score").isNotNull())
    return both.agg(F.count(F.lit(1)).alias("orders"),
                    round_half_away(F.corr("days_late", "review_score"), 6)
                    .alias("corr_days_late_review"))


def top_sellers(seller_health: DataFrame, n: int = 10) -> DataFrame:
    """The top-n sellers by revenue (the top-k is the feature)."""
    return (seller_health.where(F.col("revenue_rank") <= n)
            .select("seller_id", "revenue_rank", "total_revenue", "state")
            .orderBy("revenue_rank"))


def risk_sellers(seller_health: DataFrame) -> DataFrame:
    """High revenue, low review score."""
    return (seller_health.where(F.col("is_risk_seller"))
            .select("seller_id", "total_revenue", "avg_review_score", "revenue_rank")
            .orderBy("revenue_rank"))


def seller_concentration(dim_sellers: DataFrame) -> DataFrame:
    """Sellers per state and share of all sellers."""
    return state_concentration(dim_sellers).orderBy(F.col("sellers_in_state").desc(), "state")


def freight_share_by_state(dim_customers: DataFrame) -> DataFrame:
    """Freight as % of order value by customer state."""
    return (dim_customers.groupBy("state").agg(
                F.count(F.lit(1)).alias("customers"),
                round_half_away(F.avg("avg_freight_pct"), 6).alias("avg_freight_pct"),
                (F.sum("lifetime_freight") / F.nullif(F.sum("lifetime_gmv"), F.lit(0.0)))
                 .alias("freight_share"))
            .orderBy("state"))


def purchase_cohorts(order_history: DataFrame) -> DataFrame:
    """People, orders and lifetime value by first-purchase month."""
    return (order_history.groupBy("cohort_month").agg(
                F.count(F.lit(1)).alias("customers"),
                F.sum("total_orders").alias("orders"),
                F.sum("lifetime_value").alias("lifetime_value"),
                F.sum(F.when(F.col("total_orders") > 1, 1).otherwise(0)).cast("bigint")
                 .alias("repeat_customers"))
            .orderBy("cohort_month"))
