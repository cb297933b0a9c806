"""Staging models as catalog views: SQL text over the raw catalog tables.

Spark keeps a view across sessions only as SQL text, so the models of
:mod:`agora.plans.staging` are stated here once more as SQL; tests hold both to
the same rows. A view reads whatever version its raw table is switched to.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

_REVIEW_ORDER = ("struct(review_answer_timestamp IS NOT NULL, review_answer_timestamp, "
                 "review_id IS NOT NULL, review_id)")

# {raw} is the database of the raw tables.
VIEWS: dict[str, str] = {
    "stg_orders": """
SELECT order_id, customer_id, order_status, order_purchase_timestamp AS purchased_at,
       order_approved_at AS approved_at, order_delivered_carrier_date AS shipped_at,
       order_delivered_customer_date AS delivered_at,
       order_estimated_delivery_date AS estimated_delivery_at,
       order_delivered_customer_date > order_estimated_delivery_date AS is_late_delivery,
       CAST(datediff(order_delivered_customer_date, order_purchase_timestamp) AS BIGINT)
         AS days_to_deliver
FROM {raw}.orders""",
    "stg_customers": """
SELECT customer_id, customer_unique_id, customer_zip_code_prefix AS zip_code_prefix,
       lower(trim(customer_city)) AS city, upper(trim(customer_state)) AS state
FROM {raw}.customers""",
    "stg_order_items": """
SELECT order_id, order_item_id AS item_seq, product_id, seller_id, CAST(price AS DOUBLE) AS item_price,
       CAST(freight_value AS DOUBLE) AS freight_value, shipping_limit_date,
       CAST(price + freight_value AS DOUBLE) AS total_item_value
FROM {raw}.order_items""",
    "stg_order_payments": """
SELECT order_id, CAST(payment_sequential AS INT) AS payment_seq, payment_type,
       CAST(payment_installments AS INT) AS installments, CAST(payment_value AS DOUBLE) AS payment_value
FROM {raw}.order_payments""",
    "stg_order_reviews": f"""
SELECT r.review_id, order_id, r.review_score, r.comment_title, r.comment_message, r.review_created_at,
       r.review_answered_at,
       CASE WHEN r.review_score >= 4 THEN 'positive' WHEN r.review_score = 3 THEN 'neutral'
            ELSE 'negative' END AS sentiment
FROM (SELECT order_id, max_by(
        struct(review_id, CAST(review_score AS INT) AS review_score, review_comment_title AS comment_title,
               review_comment_message AS comment_message, review_creation_date AS review_created_at,
               review_answer_timestamp AS review_answered_at), {_REVIEW_ORDER}) AS r
      FROM {{raw}}.order_reviews GROUP BY order_id) latest""",
    "stg_products": """
SELECT p.product_id,
       coalesce(t.product_category_name_english, p.product_category_name, 'unknown') AS category_name,
       p.product_category_name AS category_name_pt, CAST(p.product_name_lenght AS INT) AS name_length,
       CAST(p.product_description_lenght AS INT) AS description_length,
       CAST(p.product_photos_qty AS INT) AS photos_qty, CAST(p.product_weight_g AS DOUBLE) AS weight_g,
       CAST(p.product_length_cm AS DOUBLE) AS length_cm, CAST(p.product_height_cm AS DOUBLE) AS height_cm,
       CAST(p.product_width_cm AS DOUBLE) AS width_cm,
       CAST(p.product_length_cm AS DOUBLE) * p.product_height_cm * p.product_width_cm AS volume_cm3
FROM {raw}.products p LEFT JOIN {raw}.product_category_name_translation t
  ON p.product_category_name = t.product_category_name""",
    "stg_sellers": """
SELECT seller_id, seller_zip_code_prefix AS zip_code_prefix, lower(trim(seller_city)) AS city,
       upper(trim(seller_state)) AS state
FROM {raw}.sellers""",
    "stg_geolocation": """
SELECT geolocation_zip_code_prefix AS zip_code_prefix, geolocation_lat AS lat, geolocation_lng AS lng,
       lower(trim(geolocation_city)) AS city, upper(trim(geolocation_state)) AS state
FROM {raw}.geolocation""",
    "stg_product_category_name_translation": """
SELECT product_category_name, product_category_name_english
FROM {raw}.product_category_name_translation""",
}


def create_views(spark: SparkSession, raw: str = "raw", database: str = "staging",
                 names: Iterable[str] = tuple(VIEWS)) -> list[str]:
    """Create or replace the staging views in ``database`` over the tables of ``raw``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    out = []
    for name in names:
        view = f"`{database}`.`{name}`"
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS {VIEWS[name].format(raw=f'`{raw}`')}")
        out.append(view)
    return out
