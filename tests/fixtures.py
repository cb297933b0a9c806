"""Hand-written raw rows for micro tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agora.plans.pipeline import Pipeline
from agora.sources.schemas import RAW_SCHEMAS
from tests.conftest import ts


def raw(spark: SparkSession, table: str, records: list[dict]) -> DataFrame:
    """A raw table with its explicit schema; columns left out are NULL."""
    schema = RAW_SCHEMAS[table]
    data = [tuple(rec.get(f.name) for f in schema.fields) for rec in records]
    return spark.createDataFrame(data, schema)


def empty_raw(spark: SparkSession) -> dict[str, DataFrame]:
    return {table: raw(spark, table, []) for table in RAW_SCHEMAS}


def shop_pipeline(spark):
    """A tiny shop: 3 customers, 4 orders, 2 sellers, 2 products."""
    t = empty_raw(spark)
    t["customers"] = raw(spark, "customers", [
        dict(customer_id="c1", customer_unique_id="u1", customer_zip_code_prefix=10,
             customer_city="Town", customer_state="aa"),
        dict(customer_id="c2", customer_unique_id="u1", customer_zip_code_prefix=99,
             customer_city="Other", customer_state="bb"),
        dict(customer_id="c3", customer_unique_id="u3", customer_zip_code_prefix=10,
             customer_city="Town", customer_state="aa"),
    ])
    t["geolocation"] = raw(spark, "geolocation", [
        dict(geolocation_zip_code_prefix=10, geolocation_lat=-1.0, geolocation_lng=-2.0,
             geolocation_city="Geo Town", geolocation_state="gg"),
        dict(geolocation_zip_code_prefix=10, geolocation_lat=-3.0, geolocation_lng=-2.0,
             geolocation_city="Geo Town", geolocation_state="gg"),
    ])
    base = dict(order_purchase_timestamp=ts("2018-03-04 10:00:00"),
                order_delivered_carrier_date=ts("2018-03-05 10:00:00"),
                order_estimated_delivery_date=ts("2018-03-10 00:00:00"))
    t["orders"] = raw(spark, "orders", [
        dict(base, order_id="o1", customer_id="c1", order_status="delivered",
             order_delivered_customer_date=ts("2018-03-12 09:00:00")),       # late, 8 days
        dict(base, order_id="o2", customer_id="c1", order_status="delivered",
             order_delivered_customer_date=ts("2018-03-08 09:00:00")),       # on time, 4 days
        dict(base, order_id="o3", customer_id="c2", order_status="canceled"),  # no items
        dict(base, order_id="o4", customer_id="c1", order_status="shipped",
             order_purchase_timestamp=ts("2018-05-01 00:30:00")),
    ])
    t["order_items"] = raw(spark, "order_items", [
        dict(order_id="o1", order_item_id=1, product_id="p1", seller_id="s1", price=100.0,
             freight_value=10.0),
        dict(order_id="o1", order_item_id=2, product_id="p1", seller_id="s1", price=100.0,
             freight_value=10.0),
        dict(order_id="o2", order_item_id=1, product_id="p2", seller_id="s2", price=50.0,
             freight_value=5.0),
        dict(order_id="o4", order_item_id=1, product_id="p2", seller_id="s1", price=0.0,
             freight_value=0.0),
    ])
    t["order_payments"] = raw(spark, "order_payments", [
        dict(order_id="o1", payment_sequential=1, payment_type="voucher", payment_installments=1,
             payment_value=20.0),
        dict(order_id="o1", payment_sequential=2, payment_type="credit_card",
             payment_installments=6, payment_value=200.0),
        dict(order_id="o2", payment_sequential=1, payment_type="voucher", payment_installments=1,
             payment_value=27.5),
        dict(order_id="o2", payment_sequential=2, payment_type="boleto", payment_installments=1,
             payment_value=27.5),                                           # tie: boleto
        dict(order_id="o4", payment_sequential=1, payment_type="debit_card",
             payment_installments=2, payment_value=None),                   # NULL value only
    ])
    t["order_reviews"] = raw(spark, "order_reviews", [
        dict(review_id="r1", order_id="o1", review_score=1,
             review_answer_timestamp=ts("2018-03-20 00:00:00")),
        dict(review_id="r2", order_id="o2", review_score=5,
             review_answer_timestamp=ts("2018-03-20 00:00:00")),
    ])
    t["sellers"] = raw(spark, "sellers", [
        dict(seller_id="s1", seller_zip_code_prefix=10, seller_city="X", seller_state="aa"),
        dict(seller_id="s2", seller_zip_code_prefix=55, seller_city="Y", seller_state="bb"),
        dict(seller_id="s3", seller_zip_code_prefix=55, seller_city="Y", seller_state="bb"),
    ])
    t["products"] = raw(spark, "products", [
        dict(product_id="p1", product_category_name="cama", product_length_cm=10.0,
             product_height_cm=10.0, product_width_cm=10.0),
        dict(product_id="p2", product_category_name=None),
    ])
    t["product_category_name_translation"] = raw(
        spark, "product_category_name_translation",
        [dict(product_category_name="cama", product_category_name_english="bed")])
    return Pipeline(t)
