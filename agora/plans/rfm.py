"""Recency-frequency-monetary segmentation of customers with orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from agora.functions.compat import days_between, round_half_away
from agora.operators.ranking import global_ranks


def _ntz_literal(value: dt.datetime | dt.date | None) -> F.Column:
    """A zone-less timestamp literal (text form, so no time zone is applied)."""
    if value is None:  # no customer with orders
        return F.lit(None).cast("timestamp_ntz")
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def rfm_label(r, f, m) -> F.Column:
    return (F.when((r >= 4) & (f >= 4), "Champions")
             .when((r >= 3) & (f >= 3), "Loyal Customers")
             .when((r >= 4) & (f <= 2), "Recent Customers")
             .when((r >= 3) & (f <= 3) & (m >= 3), "Potential Loyalists")
             .when((r <= 2) & (f >= 4), "At Risk")
             .when((r <= 2) & (f <= 2) & (m <= 2), "Lost")
             .otherwise("Needs Attention"))


def rfm_scores(dim_customers: DataFrame, as_of: dt.datetime | None = None,
               recency_desc: bool = False, num_partitions: int | None = None) -> DataFrame:
    """Per customer: recency/frequency/monetary, quintile scores, segment and label.

    Recency is whole days from the last order to ``as_of`` (default: the
    latest last order in the data); frequency is total orders; monetary is
    lifetime GMV. Quintiles are ``ntile(5)`` in ascending order of each
    measure, ties broken by customer_id, so the most recent customers score
    1 on recency. ``recency_desc=True`` reverses that order (most recent
    scores 5).
    """
    base = dim_customers.where(F.col("customer_segment") != "no_orders").select(
        "customer_id", "last_order_at",
        F.to_date("last_order_at").alias("_last_day"),
        F.col("total_orders").alias("frequency"),
        F.col("lifetime_gmv").alias("monetary"))
    # Recency is the day count back from one date, so its ascending order is
    # the descending order of the last order's day (ties alike): the quintile
    # needs no as-of date, and the date is observed while the ranked rows are
    # written instead of in a pass of its own.
    latest = Observation()
    if as_of is None:
        base = base.observe(latest, F.max("last_order_at").alias("at"))
    r_dir = "asc" if recency_desc else "desc"
    scored = global_ranks(base, [
        ([("_last_day", r_dir), ("customer_id", "asc")], None, {"r_score": 5}),
        ([("frequency", "asc"), ("customer_id", "asc")], None, {"f_score": 5}),
        ([("monetary", "asc"), ("customer_id", "asc")], None, {"m_score": 5}),
    ], num_partitions=num_partitions)
    if as_of is None:
        as_of = latest.get["at"]
    scored = scored.withColumn(
        "recency_days", days_between("last_order_at", _ntz_literal(as_of)))
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.select(
        "customer_id", "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score",
        F.concat(r.cast("string"), f.cast("string"), m.cast("string")).alias("rfm_segment"),
        round_half_away((r + f + m) / F.lit(3.0), 2).alias("rfm_avg"),
        rfm_label(r, f, m).alias("rfm_label"))


def rfm_segmentation(dim_customers: DataFrame, as_of: dt.datetime | None = None,
                     recency_desc: bool = False, num_partitions: int | None = None) -> DataFrame:
    """Customers, mean recency/orders/LTV and total LTV per RFM label."""
    labeled = rfm_scores(dim_customers, as_of, recency_desc, num_partitions)
    out = labeled.groupBy("rfm_label").agg(
        F.count(F.lit(1)).alias("customer_count"),
        round_half_away(F.avg("recency_days"), 1).alias("avg_recency_days"),
        round_half_away(F.avg("frequency"), 2).alias("avg_orders"),
        round_half_away(F.avg("monetary"), 2).alias("avg_ltv"),
        round_half_away(F.sum("monetary"), 2).alias("total_ltv"))
    return out.orderBy(F.col("total_ltv").desc_nulls_last())
