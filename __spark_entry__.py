"""

``entry(spark)`` runs the flagship query on sf0.001; ``queries()`` holds one
callable per implemented model / operator / question / check, each reading
the given test tables through :func:`agora.sources.testdata.raw_tables`;
``oracle_sql()`` holds the DuckDB SQL computing the same rows.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from agora import oracle  # noqa: E402
from agora.operators.dedupe import pick_one  # noqa: E402
from agora.operators.ranking import global_rank, positions  # noqa: E402
from agora.plans import enrich, questions  # noqa: E402
from agora.plans.pipeline import Pipeline, from_testdata  # noqa: E402
from agora.operators import quality as dq  # noqa: E402
from agora.session import ensure_checkpoint_dir  # noqa: E402
from agora.sources import csv as csv_source  # noqa: E402
from agora.sources.schemas import RAW_FILES  # noqa: E402
from agora.sources.sinks import read_table  # noqa: E402

# The training-data operators are optional: their queries are added when the subpackage
# can be imported.
try:
    from agora.llm import queries as llm
except ImportError:
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"

Query = Callable[[SparkSession, str], DataFrame]


def _from_pipeline(build: Callable[[Pipeline], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(from_testdata(spark, sf_dir))
    return run


def _model(name: str) -> Query:
    return _from_pipeline(lambda p: p.model(name))


MODELS = (
    "stg_orders", "stg_customers", "stg_order_items", "stg_order_payments", "stg_order_reviews",
    "stg_products", "stg_sellers", "stg_geolocation", "stg_product_category_name_translation",
    "int_orders_enriched", "int_customers_enriched", "int_products_enriched",
    "int_sellers_enriched", "int_customer_order_history",
    "dim_customers", "dim_products", "dim_sellers", "fct_orders",
    "mart_revenue_monthly", "mart_delivery_performance", "mart_seller_health",
    "rfm_segmentation",
)

# Operator-level queries: the custom operators on whole tables.
def _global_row_number_query(p: Pipeline) -> DataFrame:
    orders = p.int_orders_enriched.select("order_id", "gross_order_value")
    return global_rank(orders, [("gross_order_value", "desc"), ("order_id", "asc")],
                       row_number="order_rank")


def _global_ntile_query(p: Pipeline) -> DataFrame:
    orders = p.int_orders_enriched.select("order_id", "total_payment_value")
    return global_rank(orders, [("total_payment_value", "asc"), ("order_id", "asc")],
                       ntiles={"payment_decile": 10, "payment_septile": 7})


def _global_ntile_ranges_query(p: Pipeline) -> DataFrame:
    """The same operator over a fixed number of range partitions."""
    orders = p.int_orders_enriched.select("order_id", "freight_revenue")
    return global_rank(orders, [("freight_revenue", "desc"), ("order_id", "asc")],
                       row_number="freight_rank", ntiles={"freight_decile": 10},
                       num_partitions=8)


# Output orders of the marts: (model, order made total), row position as a column.
SORTED = {
    "sorted_revenue": ("mart_revenue_monthly", [
        ("order_month", "asc"), ("category_name_english", "asc"), ("primary_payment_type", "asc")]),
    "sorted_delivery": ("mart_delivery_performance", [
        ("late_delivery_rate", "desc"), ("customer_state", "asc"), ("seller_id", "asc")]),
    "sorted_seller_health": ("mart_seller_health", [("revenue_rank", "asc"), ("seller_id", "asc")]),
    "sorted_rfm": ("rfm_segmentation", [("total_ltv", "desc"), ("rfm_label", "asc")]),
}


def _sorted(model: str, order: list) -> Callable[[Pipeline], DataFrame]:
    def build(p: Pipeline) -> DataFrame:
        ranked, _ = positions(p.model(model), order)
        return ranked.select(*[c for c, _ in order], (F.col("_gpos") + 1).alias("position"))
    return build


def _sorted_sql(model: str, order: list) -> str:
    columns = ", ".join(c for c, _ in order)
    keys = ", ".join(f"{c} {d.upper()} NULLS LAST" for c, d in order)
    return f"SELECT {columns}, row_number() OVER (ORDER BY {keys}) AS position FROM {model}"


# The declared date window (off by default) over the staged orders.
DATE_WINDOW = (dt.date(1995, 1, 1), dt.date(1996, 6, 30))


def _windowed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_testdata(spark, sf_dir, date_window=DATE_WINDOW).stg_orders


def _latest_per_key_query(p: Pipeline) -> DataFrame:
    return pick_one(p.stg_orders, ["customer_id"],
                    [("purchased_at", "desc"), ("order_id", "desc")],
                    ["order_id", "purchased_at", "order_status"])


def _first_by_order_query(p: Pipeline) -> DataFrame:
    return enrich.order_payments_summary(p.stg_order_payments).select(
        "order_id", "primary_payment_type")


# Storage: what is written to the shared folder is read back.
def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/storage-{uuid.uuid4().hex}"


def _csv_folder(spark: SparkSession, sf_dir: str, tables: tuple[str, ...], folder: str) -> str:
    """Raw tables as CSV folders under their file names; reviews get texts with breaks and quotes."""
    raw = from_testdata(spark, sf_dir).raw
    for table in tables:
        df = raw[table]
        if table == "order_reviews":
            df = df.withColumn("review_comment_message", F.concat(
                F.lit('said "ok",\nno '), F.col("review_id").cast("string")))
        (df.write.option("header", True).option("quoteAll", True).option("escape", '"')
         .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(f"{folder}/{RAW_FILES[table]}"))
    return folder


def _load(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> tuple[list, dict[str, DataFrame]]:
    folder = _folder(spark)
    source = _csv_folder(spark, sf_dir, tables, f"{folder}/csv")
    results = csv_source.load_raw(spark, source, f"{folder}/raw")
    return results, csv_source.read_loaded(spark, f"{folder}/raw")


def _loaded_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with line breaks in their texts, from CSV in splits to the raw table and back."""
    return _load(spark, sf_dir, ("order_reviews",))[1]["order_reviews"].select(
        F.col("review_id").cast("bigint"), F.col("order_id").cast("bigint"), "review_score",
        "review_comment_message", "review_creation_date", "review_answer_timestamp")


def _loaded_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table as the full-refresh load counts them; files that are missing are skipped."""
    results, _ = _load(spark, sf_dir, ("customers", "sellers", "products"))
    return spark.createDataFrame([(r.table, r.rows) for r in results], "table_name string, n_rows long")


def _built_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order fact built, published and read back by another pipeline."""
    warehouse = _folder(spark)
    from_testdata(spark, sf_dir).build(spark, warehouse, names=("fct_orders",))
    later = Pipeline({})
    later.use_built(spark, warehouse, names=("fct_orders",))
    return later.fct_orders


def _bucketed_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order grain from fact tables bucketed by order_id, with hot orders apart."""
    raw = csv_source.load_bucketed(spark, from_testdata(spark, sf_dir).raw, buckets=8,
                                   database=f"stored_{uuid.uuid4().hex[:8]}")
    return Pipeline(raw).int_orders_enriched


def _stored_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failing orders of the business rule, stored by check and read back."""
    pipe = from_testdata(spark, sf_dir)
    results = dq.run_checks(pipe, kind="delivered_without_items").collect()
    written = dq.store_failures(pipe, spark, results, _folder(spark))
    return read_table(spark, written["fct_orders_failures"]).select(
        "model", "check", F.get_json_object("row", "$.order_id").cast("bigint").alias("order_id"),
        "value", "n_records")


STORAGE: dict[str, Query] = {
    "loaded_reviews": _loaded_reviews,
    "loaded_counts": _loaded_counts,
    "built_fct_orders": _built_fact,
    "bucketed_order_grain": _bucketed_grain,
    "stored_failures": _stored_failures,
}


QUESTIONS: dict[str, Callable[[Pipeline], DataFrame]] = {
    "q_gmv_by_month": lambda p: questions.gmv_trend(p.mart_revenue_monthly, "month"),
    "q_gmv_by_quarter": lambda p: questions.gmv_trend(p.mart_revenue_monthly, "quarter"),
    "q_category_revenue": lambda p: questions.category_revenue_vs_volume(p.mart_revenue_monthly),
    # the order fact's customer join adds no column these two read (and keeps
    # every row): they read the order grain it is built on
    "q_aov_by_payment": lambda p: questions.aov_by_payment_type(p.int_orders_enriched),
    "q_on_time_share": lambda p: questions.on_time_share(p.mart_delivery_performance),
    "q_worst_states": lambda p: questions.worst_delivery_states(p.mart_delivery_performance),
    "q_delay_review_corr": lambda p: questions.delay_review_correlation(p.int_orders_enriched),
    "q_late_sellers": lambda p: questions.late_sellers(p.mart_delivery_performance),
    "q_top_sellers": lambda p: questions.top_sellers(p.mart_seller_health),
    "q_risk_sellers": lambda p: questions.risk_sellers(p.mart_seller_health),
    "q_seller_concentration": lambda p: questions.seller_concentration(p.dim_sellers),
    "q_freight_by_state": lambda p: questions.freight_share_by_state(p.dim_customers),
    "q_purchase_cohorts": lambda p: questions.purchase_cohorts(p.int_customer_order_history),
    "global_row_number": _global_row_number_query,
    "global_ntile": _global_ntile_query,
    "global_ntile_ranges": _global_ntile_ranges_query,
    **{name: _sorted(model, order) for name, (model, order) in SORTED.items()},
    "latest_per_key": _latest_per_key_query,
    "first_by_order": _first_by_order_query,
    "dq_unique": lambda p: dq.run_checks(p, kind="unique"),
    "dq_not_null": lambda p: dq.run_checks(p, kind="not_null"),
    "dq_accepted_values": lambda p: dq.run_checks(p, kind="accepted_values"),
    "dq_between": lambda p: dq.run_checks(p, kind="between"),
    "dq_relationships": lambda p: dq.run_checks(p, kind="relationships"),
    "dq_assert_positive": lambda p: dq.report(dq.AMOUNT_CHECKS, dq.pipeline_resolver(p)),
    "dq_business_rules": lambda p: dq.run_checks(p, kind="delivered_without_items"),
    "dq_delivered_without_items": lambda p: dq.delivered_without_items(p.fct_orders),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: monthly revenue by category and payment type on sf0.001."""
    return from_testdata(spark, SMOKE_DIR).mart_revenue_monthly


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {name: _model(name) for name in MODELS}
    out.update({name: _from_pipeline(build) for name, build in QUESTIONS.items()})
    out["stg_orders_window"] = _windowed_orders
    out.update(STORAGE)
    if llm:
        out.update(llm.QUERIES)
    return out


# Oracle SQL of the questions and operator queries (models: ``SELECT *``).
_QUESTION_SQL = {
    "q_gmv_by_month": """
SELECT order_month, sum(gross_order_value) AS gmv, sum(items_revenue) AS items_revenue,
       sum(freight_revenue) AS freight_revenue
FROM mart_revenue_monthly GROUP BY order_month""",
    "q_gmv_by_quarter": """
SELECT order_quarter, sum(gross_order_value) AS gmv, sum(items_revenue) AS items_revenue,
       sum(freight_revenue) AS freight_revenue
FROM mart_revenue_monthly GROUP BY order_quarter""",
    "q_category_revenue": """
SELECT category_name_english, sum(items_revenue) AS items_revenue,
       sum(gross_order_value) AS gmv, CAST(sum(order_count) AS BIGINT) AS orders
FROM mart_revenue_monthly GROUP BY category_name_english""",
    "q_aov_by_payment": """
SELECT primary_payment_type, count(*) AS orders, sum(gross_order_value) AS gmv,
       avg(gross_order_value) AS avg_order_value
FROM fct_orders WHERE order_status IN ('delivered', 'shipped', 'processing', 'approved')
GROUP BY primary_payment_type""",
    "q_on_time_share": """
SELECT *, CAST(on_time_orders AS DOUBLE) * 100.0 / delivered_orders AS pct_on_time,
       CAST(late_orders AS DOUBLE) * 100.0 / delivered_orders AS pct_late
FROM (SELECT CAST(sum(delivered_orders) AS BIGINT) AS delivered_orders,
             CAST(sum(on_time_orders) AS BIGINT) AS on_time_orders,
             CAST(sum(late_orders) AS BIGINT) AS late_orders
      FROM mart_delivery_performance) totals""",
    "q_worst_states": """
SELECT customer_state, CAST(sum(delivered_orders) AS BIGINT) AS delivered_orders,
       CAST(sum(late_orders) AS BIGINT) AS late_orders, count(*) AS sellers,
       CAST(sum(late_orders) AS DOUBLE) / sum(delivered_orders) AS late_rate
FROM mart_delivery_performance GROUP BY customer_state""",
    "q_delay_review_corr": """
SELECT count(*) AS orders, round(corr(days_late, review_score), 6) AS corr_days_late_review
FROM (SELECT CAST(datediff('day', estimated_delivery_at, delivered_at) AS DOUBLE) AS days_late,
             CAST(review_score AS DOUBLE) AS review_score
      FROM fct_orders WHERE order_status = 'delivered') d
WHERE days_late IS NOT NULL AND review_score IS NOT NULL""",
    "q_late_sellers": """
SELECT seller_id, CAST(sum(delivered_orders) AS BIGINT) AS delivered_orders,
       CAST(sum(late_orders) AS BIGINT) AS late_orders, count(*) AS states,
       CAST(sum(late_orders) AS DOUBLE) / sum(delivered_orders) AS late_rate
FROM mart_delivery_performance GROUP BY seller_id""",
    "q_top_sellers": """
SELECT seller_id, revenue_rank, total_revenue, state
FROM mart_seller_health WHERE revenue_rank <= 10""",
    "q_risk_sellers": """
SELECT seller_id, total_revenue, avg_review_score, revenue_rank
FROM mart_seller_health WHERE is_risk_seller""",
    "q_seller_concentration": "SELECT * FROM state_concentration",
    "q_freight_by_state": """
SELECT state, count(*) AS customers, round(avg(avg_freight_pct), 6) AS avg_freight_pct,
       sum(lifetime_freight) / nullif(sum(lifetime_gmv), 0.0) AS freight_share
FROM dim_customers GROUP BY state""",
    "q_purchase_cohorts": """
SELECT cohort_month, count(*) AS customers, CAST(sum(total_orders) AS BIGINT) AS orders,
       sum(lifetime_value) AS lifetime_value,
       CAST(sum(CASE WHEN total_orders > 1 THEN 1 ELSE 0 END) AS BIGINT) AS repeat_customers
FROM int_customer_order_history GROUP BY cohort_month""",
    "global_row_number": """
SELECT order_id, gross_order_value,
       row_number() OVER (ORDER BY gross_order_value DESC NULLS LAST, order_id) AS order_rank
FROM int_orders_enriched""",
    "global_ntile": """
SELECT order_id, total_payment_value,
       ntile(10) OVER (ORDER BY total_payment_value ASC NULLS LAST, order_id) AS payment_decile,
       ntile(7) OVER (ORDER BY total_payment_value ASC NULLS LAST, order_id) AS payment_septile
FROM int_orders_enriched""",
    "global_ntile_ranges": """
SELECT order_id, freight_revenue,
       row_number() OVER (ORDER BY freight_revenue DESC NULLS LAST, order_id) AS freight_rank,
       ntile(10) OVER (ORDER BY freight_revenue DESC NULLS LAST, order_id) AS freight_decile
FROM int_orders_enriched""",
    **{name: _sorted_sql(model, order) for name, (model, order) in SORTED.items()},
    "stg_orders_window": f"""
SELECT * FROM stg_orders
WHERE CAST(purchased_at AS DATE) BETWEEN DATE '{DATE_WINDOW[0]}' AND DATE '{DATE_WINDOW[1]}'""",
    "latest_per_key": """
SELECT customer_id, order_id, purchased_at, order_status FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id
                               ORDER BY purchased_at DESC NULLS LAST, order_id DESC) AS rn
  FROM stg_orders) ranked WHERE rn = 1""",
    "first_by_order": "SELECT order_id, primary_payment_type FROM order_payments_agg",
    "loaded_reviews": """
SELECT review_id, order_id, review_score, 'said "ok",' || chr(10) || 'no ' || review_id
         AS review_comment_message, review_creation_date, review_answer_timestamp
FROM src_order_reviews""",
    "loaded_counts": """
SELECT 'customers' AS table_name, count(*) AS n_rows FROM src_customers
UNION ALL SELECT 'sellers', count(*) FROM src_sellers
UNION ALL SELECT 'products', count(*) FROM src_products""",
    "built_fct_orders": "SELECT * FROM fct_orders",
    "bucketed_order_grain": "SELECT * FROM int_orders_enriched",
    "stored_failures": """
SELECT 'fct_orders' AS model, 'delivered_without_items_item_count' AS check, order_id,
       CAST(item_count AS VARCHAR) AS value, CAST(1 AS BIGINT) AS n_records
FROM fct_orders WHERE order_status = 'delivered' AND item_count = 0""",
}


def oracle_sql() -> dict[str, str]:
    out = {name: oracle.model_sql(name) for name in MODELS}
    out.update({name: oracle.with_clause(sql.strip()) for name, sql in _QUESTION_SQL.items()})
    out.update(oracle.dq_oracle_sql())
    if llm:
        out.update(llm.ORACLE_SQL)
    return out
