"""Core marts: customer, product and seller dimensions and the order fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.operators.skew import left_lookup


def customer_segment(total_orders) -> F.Column:
    return (F.when(total_orders == 0, "no_orders")
             .when(total_orders == 1, "one_time")
             .when(total_orders.between(2, 3), "occasional")
             .otherwise("loyal"))


def ltv_bucket(gmv) -> F.Column:
    return (F.when(gmv == 0, "no_spend")
             .when(gmv < 100, "low")
             .when(gmv < 500, "mid")
             .when(gmv < 2000, "high")
             .otherwise("vip"))


def dim_customers(customers_enriched: DataFrame) -> DataFrame:
    c = customers_enriched
    return c.select(
        "customer_id", "customer_unique_id", "state", "city", "customer_lat", "customer_lng",
        customer_segment(F.col("total_orders")).alias("customer_segment"),
        "is_repeat_buyer",
        ltv_bucket(F.col("lifetime_gmv")).alias("ltv_bucket"),
        "total_orders", "delivered_orders", "lifetime_gmv", "lifetime_freight",
        "avg_order_value", "avg_freight_pct", "first_order_at", "last_order_at",
        "customer_lifespan_days", "avg_days_to_deliver", "late_orders", "late_order_rate",
        "avg_review_score", "most_used_payment_type")


def size_bucket(volume) -> F.Column:
    return (F.when(volume.isNull(), "unknown")
             .when(volume < 1000, "tiny")
             .when(volume < 10000, "small")
             .when(volume < 50000, "medium")
             .otherwise("large"))


def dim_products(products_enriched: DataFrame) -> DataFrame:
    return products_enriched.select(
        "product_id", "product_category_name", "category_name_english",
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
        "product_volume_cm3",
        size_bucket(F.col("product_volume_cm3")).alias("size_bucket"),
        "product_photos_qty", "product_name_length", "product_description_length",
        "times_ordered", "total_revenue", "avg_item_price", "avg_freight_value",
        "freight_to_price_ratio", "avg_review_score", "avg_days_to_deliver", "one_star_rate")


def seller_tier(revenue) -> F.Column:
    return (F.when(revenue == 0, "inactive")
             .when(revenue < 5000, "small")
             .when(revenue < 50000, "mid")
             .otherwise("large"))


def quality_tier(score) -> F.Column:
    return (F.when(score >= 4.5, "excellent")
             .when(score >= 4.0, "good")
             .when(score >= 3.0, "average")
             .when(score.isNull(), "unrated")
             .otherwise("poor"))


def dim_sellers(sellers_enriched: DataFrame) -> DataFrame:
    return sellers_enriched.select(
        "seller_id", "state", "city", "seller_lat", "seller_lng",
        seller_tier(F.col("total_revenue")).alias("seller_tier"),
        quality_tier(F.col("avg_review_score")).alias("quality_tier"),
        F.col("is_high_revenue_low_rating").alias("is_risk_seller"),
        "total_orders", "total_items_sold", "distinct_products", "total_revenue",
        "total_freight_collected", "avg_item_price", "avg_days_to_deliver",
        "late_delivery_rate", "avg_review_score", "one_star_reviews", "five_star_reviews",
        "one_star_rate")


FCT_ORDERS_COLUMNS = (
    "order_id", "customer_id", "customer_state", "customer_city", "order_status",
    "purchased_at", "approved_at", "shipped_at", "delivered_at", "estimated_delivery_at",
    "order_month", "order_week", "purchase_day_of_week", "purchase_hour",
    "item_count", "distinct_products", "distinct_sellers",
    "items_revenue", "freight_revenue", "gross_order_value", "total_payment_value",
    "primary_payment_type", "max_installments", "payment_methods_used",
    "days_to_deliver", "is_late_delivery", "review_score", "review_sentiment")


# Columns of the order fact that an order grain of sums only does not hold.
DISTINCT_COUNTS = ("distinct_products", "distinct_sellers")


def fct_orders(orders_enriched: DataFrame, customer_places: DataFrame,
               orders: DataFrame | None = None) -> DataFrame:
    """Order fact with the customer's state and city.

    ``customer_places`` is any table with one row per customer_id holding its
    resolved ``state`` and ``city`` (the enriched customer table, or just the
    customers joined to their zip point, which is all the fact needs). A customer
    with a third of the orders is spread by its weight, counted on ``orders``
    (any table of the same orders; default the order grain itself). Over an order grain
    without distinct counts, the fact has none.
    """
    c = customer_places.select(
        "customer_id", F.col("state").alias("customer_state"),
        F.col("city").alias("customer_city"))
    joined = left_lookup(orders_enriched, c, "customer_id", spread=F.col("order_id"), keys=orders)
    return joined.select(*[c for c in FCT_ORDERS_COLUMNS
                           if c not in DISTINCT_COUNTS or c in orders_enriched.columns])
