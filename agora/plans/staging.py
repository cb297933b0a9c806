"""Staging builders: typed, renamed, lightly cleaned raw tables (one per source)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.functions.compat import days_between, to_int
from agora.operators.dedupe import pick_one

TS = "timestamp_ntz"


def stg_orders(orders: DataFrame) -> DataFrame:
    """One row per order: typed lifecycle timestamps, lateness and delivery days."""
    delivered = F.col("order_delivered_customer_date").cast(TS)
    estimated = F.col("order_estimated_delivery_date").cast(TS)
    purchased = F.col("order_purchase_timestamp").cast(TS)
    is_late = F.when(delivered.isNotNull() & estimated.isNotNull(), delivered > estimated)
    days = F.when(delivered.isNotNull() & purchased.isNotNull(), days_between(purchased, delivered))
    return orders.select(
        "order_id", "customer_id", "order_status",
        purchased.alias("purchased_at"),
        F.col("order_approved_at").cast(TS).alias("approved_at"),
        F.col("order_delivered_carrier_date").cast(TS).alias("shipped_at"),
        delivered.alias("delivered_at"),
        estimated.alias("estimated_delivery_at"),
        is_late.alias("is_late_delivery"),
        days.cast("bigint").alias("days_to_deliver"))


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "customer_unique_id",
        F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
        F.lower(F.trim("customer_city")).alias("city"),
        F.upper(F.trim("customer_state")).alias("state"))


def stg_order_items(items: DataFrame) -> DataFrame:
    return items.select(
        "order_id",
        F.col("order_item_id").alias("item_seq"),
        "product_id", "seller_id",
        F.col("price").cast("double").alias("item_price"),
        F.col("freight_value").cast("double").alias("freight_value"),
        F.col("shipping_limit_date").cast(TS).alias("shipping_limit_date"),
        (F.col("price") + F.col("freight_value")).cast("double").alias("total_item_value"))


def stg_order_payments(payments: DataFrame) -> DataFrame:
    dt = payments.schema
    return payments.select(
        "order_id",
        to_int("payment_sequential", dt["payment_sequential"].dataType).alias("payment_seq"),
        "payment_type",
        to_int("payment_installments", dt["payment_installments"].dataType).alias("installments"),
        F.col("payment_value").cast("double").alias("payment_value"))


def sentiment_of(score) -> F.Column:
    return (F.when(score >= 4, "positive")
             .when(score == 3, "neutral")
             .otherwise("negative"))


def latest_review_scores(reviews: DataFrame) -> DataFrame:
    """order_id, review_score, sentiment of each order's latest review.

    Same pick as :func:`stg_order_reviews`, carrying only the fixed-width
    fields through the shuffle (no comment text).
    """
    score = to_int("review_score", reviews.schema["review_score"].dataType)
    typed = reviews.select(
        "order_id", "review_id", score.alias("review_score"),
        F.col("review_answer_timestamp").cast(TS).alias("review_answered_at"))
    latest = pick_one(typed, ["order_id"],
                      [("review_answered_at", "desc"), ("review_id", "desc")],
                      ["review_score"])
    return latest.select("order_id", "review_score",
                         sentiment_of(F.col("review_score")).alias("sentiment"))


def stg_order_reviews(reviews: DataFrame) -> DataFrame:
    """Latest review per order (answer time desc, NULLs last; ties: review_id desc)."""
    typed = reviews.select(
        "review_id", "order_id",
        to_int("review_score", reviews.schema["review_score"].dataType).alias("review_score"),
        F.col("review_comment_title").alias("comment_title"),
        F.col("review_comment_message").alias("comment_message"),
        F.col("review_creation_date").cast(TS).alias("review_created_at"),
        F.col("review_answer_timestamp").cast(TS).alias("review_answered_at"))
    latest = pick_one(typed, ["order_id"],
                      [("review_answered_at", "desc"), ("review_id", "desc")])
    return latest.select(
        "review_id", "order_id", "review_score", "comment_title", "comment_message",
        "review_created_at", "review_answered_at",
        sentiment_of(F.col("review_score")).alias("sentiment"))


def stg_product_category_name_translation(translation: DataFrame) -> DataFrame:
    return translation.select("product_category_name", "product_category_name_english")


def stg_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category (fallback: original name, then 'unknown')."""
    # The category list is a small lookup: the planner broadcasts it from the
    # scan's size estimate, and AQE does so from its measured size at runtime;
    # a large list falls back to a sort-merge join.
    lookup = stg_product_category_name_translation(translation)
    p = products.alias("p")
    joined = p.join(lookup.alias("t"),
                    F.col("p.product_category_name") == F.col("t.product_category_name"), "left")
    dt = products.schema
    length, height, width = (F.col(f"p.product_{d}_cm").cast("double")
                             for d in ("length", "height", "width"))
    return joined.select(
        F.col("p.product_id").alias("product_id"),
        F.coalesce(F.col("t.product_category_name_english"), F.col("p.product_category_name"),
                   F.lit("unknown")).alias("category_name"),
        F.col("p.product_category_name").alias("category_name_pt"),
        to_int("p.product_name_lenght", dt["product_name_lenght"].dataType).alias("name_length"),
        to_int("p.product_description_lenght", dt["product_description_lenght"].dataType)
            .alias("description_length"),
        to_int("p.product_photos_qty", dt["product_photos_qty"].dataType).alias("photos_qty"),
        F.col("p.product_weight_g").cast("double").alias("weight_g"),
        length.alias("length_cm"), height.alias("height_cm"), width.alias("width_cm"),
        (length * height * width).alias("volume_cm3"))


def stg_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        "seller_id",
        F.col("seller_zip_code_prefix").alias("zip_code_prefix"),
        F.lower(F.trim("seller_city")).alias("city"),
        F.upper(F.trim("seller_state")).alias("state"))


def stg_geolocation(geolocation: DataFrame) -> DataFrame:
    """Zip-code points, cleaned like the customer and seller addresses."""
    return geolocation.select(
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.col("geolocation_lat").alias("lat"),
        F.col("geolocation_lng").alias("lng"),
        F.lower(F.trim("geolocation_city")).alias("city"),
        F.upper(F.trim("geolocation_state")).alias("state"))


def geo_by_zip(geo: DataFrame) -> DataFrame:
    """One point per zip prefix: the first by (lat, lng, city, state), NULLs last."""
    return pick_one(geo, ["zip_code_prefix"],
                    [("lat", "asc"), ("lng", "asc"), ("city", "asc"), ("state", "asc")],
                    ["state", "city", "lat", "lng"])
