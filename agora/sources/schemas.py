"""Explicit schemas of the nine raw marketplace tables (no inference)."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _D, _TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# Raw table names and their columns, as the source files name them
# (including the source's own spelling "lenght").
RAW_SCHEMAS: dict[str, T.StructType] = {
    "orders": _schema(
        ("order_id", _S), ("customer_id", _S), ("order_status", _S),
        ("order_purchase_timestamp", _TS), ("order_approved_at", _TS),
        ("order_delivered_carrier_date", _TS), ("order_delivered_customer_date", _TS),
        ("order_estimated_delivery_date", _TS)),
    "customers": _schema(
        ("customer_id", _S), ("customer_unique_id", _S), ("customer_zip_code_prefix", _I),
        ("customer_city", _S), ("customer_state", _S)),
    "order_items": _schema(
        ("order_id", _S), ("order_item_id", _I), ("product_id", _S), ("seller_id", _S),
        ("shipping_limit_date", _TS), ("price", _D), ("freight_value", _D)),
    "order_payments": _schema(
        ("order_id", _S), ("payment_sequential", _I), ("payment_type", _S),
        ("payment_installments", _I), ("payment_value", _D)),
    "order_reviews": _schema(
        ("review_id", _S), ("order_id", _S), ("review_score", _I),
        ("review_comment_title", _S), ("review_comment_message", _S),
        ("review_creation_date", _TS), ("review_answer_timestamp", _TS)),
    "products": _schema(
        ("product_id", _S), ("product_category_name", _S), ("product_name_lenght", _I),
        ("product_description_lenght", _I), ("product_photos_qty", _I),
        ("product_weight_g", _D), ("product_length_cm", _D), ("product_height_cm", _D),
        ("product_width_cm", _D)),
    "sellers": _schema(
        ("seller_id", _S), ("seller_zip_code_prefix", _I), ("seller_city", _S),
        ("seller_state", _S)),
    "product_category_name_translation": _schema(
        ("product_category_name", _S), ("product_category_name_english", _S)),
    "geolocation": _schema(
        ("geolocation_zip_code_prefix", _I), ("geolocation_lat", _D), ("geolocation_lng", _D),
        ("geolocation_city", _S), ("geolocation_state", _S)),
}

# File name of each raw table in the public marketplace dataset.
RAW_FILES: dict[str, str] = {
    "orders": "olist_orders_dataset.csv",
    "customers": "olist_customers_dataset.csv",
    "order_items": "olist_order_items_dataset.csv",
    "products": "olist_products_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
    "order_reviews": "olist_order_reviews_dataset.csv",
    "order_payments": "olist_order_payments_dataset.csv",
    "product_category_name_translation": "product_category_name_translation.csv",
    "geolocation": "olist_geolocation_dataset.csv",
}
