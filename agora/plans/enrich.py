"""Intermediate builders: order, customer, product and seller grain enrichment.

Shape of the plans, with scale in mind:

* Aggregate before joining: every fact is rolled up to the grain of the join
  key first, so joins never fan out and their inputs shrink.
* Seller and product measures come from items pre-collapsed once to distinct
  (seller|product, order) pairs with an item count ``n`` and price/freight
  sums. The pairs are left-joined to the order grain (one row per pair, not
  per item) and a single group-by computes all-order measures (item totals,
  averages, ``count(distinct order_id)`` as a count of pairs) and the
  item-weighted delivered/reviewed measures as conditional aggregates. The
  other distinct count is a small (key, other) distinct. This relies on
  order_id being unique in the order grain (a declared unique check).
* All aggregates are partial (map-side combined); a key holding a third of
  the rows sends one partial row per map task through the shuffle.
* Joins on order_id / customer_id / seller_id / product_id sort-merge on the
  shared key, and AQE broadcasts any side measured small at runtime and
  splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.functions.compat import (
    count_when,
    day_of_week_sun0,
    days_between,
    float_ratio,
    hour_of,
    stable_avg,
    sum_flag,
    trunc_ts,
    weighted_avg,
)
from agora.operators.dedupe import first_by
from agora.plans.staging import geo_by_zip


# ---------------------------------------------------------------- order grain

def order_items_summary(items: DataFrame, distinct_counts: bool = True) -> DataFrame:
    """Item count, distinct products and sellers, and sums per order.

    Both levels combine map-side, so an order of any size is a few rows per task
    and no set of products or sellers is held: each item is one row tagged with
    its product, which carries the sums, and one tagged with its seller; they
    collapse to (order, tag, value), and the order counts its distinct values.
    Without ``distinct_counts`` the sums are one aggregate.
    """
    if not distinct_counts:
        return items.groupBy("order_id").agg(
            F.count(F.lit(1)).alias("item_count"),
            F.sum("item_price").alias("items_revenue"),
            F.sum("freight_value").alias("freight_revenue"),
            F.sum("total_item_value").alias("gross_order_value"))
    measures = ("item_price", "freight_value", "total_item_value")
    types = {c: items.schema[c].dataType for c in ("product_id", "seller_id", *measures)}
    no_product, no_seller = (F.lit(None).cast(types[c]) for c in ("product_id", "seller_id"))
    tagged = items.select("order_id", F.explode(F.array(
        F.struct(F.lit(1).alias("item"), F.col("product_id").alias("product"),
                 no_seller.alias("seller"), *[F.col(m).alias(m) for m in measures]),
        F.struct(F.lit(0).alias("item"), no_product.alias("product"),
                 F.col("seller_id").alias("seller"),
                 *[F.lit(None).cast(types[m]).alias(m) for m in measures]))).alias("t")
    ).select("order_id", "t.*")
    values = tagged.groupBy("order_id", "item", "product", "seller").agg(
        F.sum("item").alias("n"), *[F.sum(m).alias(m) for m in measures])
    return values.groupBy("order_id").agg(
        F.sum("n").alias("item_count"),
        F.count("product").alias("distinct_products"),
        F.count("seller").alias("distinct_sellers"),
        F.sum("item_price").alias("items_revenue"),
        F.sum("freight_value").alias("freight_revenue"),
        F.sum("total_item_value").alias("gross_order_value"))


def order_payments_summary(payments: DataFrame) -> DataFrame:
    """Payment totals; the primary type is the highest-value payment's type
    (value desc, NULLs last; ties: payment_type asc).

    Payments are first rolled up per (order, type), map-side, with numeric
    buffers only (a hash aggregate); the per-type maximum value decides the
    primary type, since the largest single payment belongs to the type with the
    largest maximum. The second level sees one row per (order, type).
    """
    per_type = payments.groupBy("order_id", "payment_type").agg(
        F.sum("payment_value").alias("type_value"),
        F.max("installments").alias("type_installments"),
        F.max("payment_value").alias("type_top_value"))
    primary = first_by("payment_type", [("type_top_value", "desc"), ("payment_type", "asc")],
                       per_type)
    return per_type.groupBy("order_id").agg(
        F.sum("type_value").alias("total_payment_value"),
        F.max("type_installments").alias("max_installments"),
        primary.alias("primary_payment_type"),
        F.count("payment_type").alias("payment_methods_used"))


def int_orders_enriched(orders: DataFrame, items: DataFrame, payments: DataFrame,
                        reviews: DataFrame, distinct_counts: bool = True,
                        hot: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One row per order with item, payment and review measures and calendar keys.

    ``distinct_counts=False`` leaves ``distinct_products`` and ``distinct_sellers`` out, for
    consumers that need the sums only. ``hot`` holds the rows of orders that are
    stored apart, of at most 1000 orders, by ``items``, ``payments`` and ``reviews``: those
    are rolled up by themselves and looked up, and what is bucketed by order_id meets
    in place.
    """
    summaries = {"i": ("items", items, lambda df: order_items_summary(df, distinct_counts)),
                 "p": ("payments", payments, order_payments_summary),
                 "r": ("reviews", reviews,
                       lambda df: df.select("order_id", "review_score", "sentiment"))}
    joined, apart = orders.alias("o"), set()
    for alias, (name, rows, summary) in summaries.items():
        sides = [(alias, summary(rows))]
        if hot and name in hot:                             # an order is in one of the two
            apart.add(alias)
            sides.append((f"{alias}_hot", F.broadcast(summary(hot[name]))))
        for side, df in sides:
            joined = joined.join(df.alias(side), F.col("o.order_id") == F.col(f"{side}.order_id"), "left")

    def of(column: str) -> Column:
        alias, name = column.split(".")
        return F.coalesce(column, f"{alias}_hot.{name}") if alias in apart else F.col(column)
    zero = F.lit(0)
    purchased = F.col("o.purchased_at")
    return joined.select(
        *[F.col(f"o.{c}") for c in (
            "order_id", "customer_id", "order_status", "purchased_at", "approved_at",
            "shipped_at", "delivered_at", "estimated_delivery_at", "days_to_deliver",
            "is_late_delivery")],
        F.coalesce(of("i.item_count"), zero).alias("item_count"),
        *[F.coalesce(of(f"i.{c}"), zero).alias(c) for c in ("distinct_products", "distinct_sellers")
          if distinct_counts],
        F.coalesce(of("i.items_revenue"), zero).cast("double").alias("items_revenue"),
        F.coalesce(of("i.freight_revenue"), zero).cast("double").alias("freight_revenue"),
        F.coalesce(of("i.gross_order_value"), zero).cast("double").alias("gross_order_value"),
        F.coalesce(of("p.total_payment_value"), zero).cast("double").alias("total_payment_value"),
        of("p.primary_payment_type").alias("primary_payment_type"),
        F.coalesce(of("p.max_installments"), F.lit(1)).alias("max_installments"),
        F.coalesce(of("p.payment_methods_used"), zero).alias("payment_methods_used"),
        of("r.review_score").alias("review_score"),
        of("r.sentiment").alias("review_sentiment"),
        trunc_ts("month", purchased).alias("order_month"),
        trunc_ts("week", purchased).alias("order_week"),
        day_of_week_sun0(purchased).alias("purchase_day_of_week"),
        hour_of(purchased).alias("purchase_hour"))


# ------------------------------------------------------------------- geo grain

def geo_lookup(geolocation: DataFrame) -> DataFrame:
    """One point per zip. Joined without a hint: AQE broadcasts it when the
    measured aggregate is small and sort-merge joins it otherwise."""
    return geo_by_zip(geolocation)


def with_geo(entities: DataFrame, geo: DataFrame, prefix: str) -> DataFrame:
    """Left-join the zip point; state/city fall back to the entity's own."""
    e, g = entities.alias("e"), geo.alias("g")
    return (e.join(g, F.col("e.zip_code_prefix") == F.col("g.zip_code_prefix"), "left")
             .select("e.*",
                     F.coalesce("g.state", "e.state").alias("_state"),
                     F.coalesce("g.city", "e.city").alias("_city"),
                     F.col("g.lat").alias(f"{prefix}_lat"),
                     F.col("g.lng").alias(f"{prefix}_lng"))
             .drop("state", "city")
             .withColumnRenamed("_state", "state")
             .withColumnRenamed("_city", "city"))


def customer_locations(customers: DataFrame, geo: DataFrame) -> DataFrame:
    """customer_id, customer_unique_id, zip_code_prefix, state, city, customer_lat, customer_lng."""
    return with_geo(customers, geo, "customer").select(
        "customer_id", "customer_unique_id", "zip_code_prefix", "state", "city",
        "customer_lat", "customer_lng")


# -------------------------------------------------------------- customer grain

def int_customers_enriched(customers: DataFrame, geo: DataFrame,
                           orders_enriched: DataFrame) -> DataFrame:
    """One row per customer_id with lifetime order measures and a zip point."""
    gross = F.col("gross_order_value")
    agg = orders_enriched.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        count_when(F.col("order_status") == "delivered").alias("delivered_orders"),
        F.sum(gross).alias("lifetime_gmv"),
        F.sum("freight_revenue").alias("lifetime_freight"),
        F.avg(gross).alias("avg_order_value"),
        stable_avg(F.when(gross > 0, F.col("freight_revenue") / gross)).alias("avg_freight_pct"),
        F.min("purchased_at").alias("first_order_at"),
        F.max("purchased_at").alias("last_order_at"),
        F.avg("days_to_deliver").alias("avg_days_to_deliver"),
        sum_flag(F.col("is_late_delivery")).alias("late_orders"),
        F.avg("review_score").alias("avg_review_score"),
        F.max("primary_payment_type").alias("most_used_payment_type")).alias("o")
    c = customer_locations(customers, geo).alias("c")
    joined = c.join(agg, F.col("c.customer_id") == F.col("o.customer_id"), "left")
    total = F.coalesce("o.total_orders", F.lit(0))
    return joined.select(
        "c.customer_id", "c.customer_unique_id", "c.zip_code_prefix", "c.state", "c.city",
        "c.customer_lat", "c.customer_lng",
        total.alias("total_orders"),
        F.coalesce("o.delivered_orders", F.lit(0)).alias("delivered_orders"),
        F.coalesce("o.lifetime_gmv", F.lit(0)).cast("double").alias("lifetime_gmv"),
        F.coalesce("o.lifetime_freight", F.lit(0)).cast("double").alias("lifetime_freight"),
        "o.avg_order_value", "o.avg_freight_pct",
        (total > 1).alias("is_repeat_buyer"),
        "o.first_order_at", "o.last_order_at",
        days_between("o.first_order_at", "o.last_order_at").alias("customer_lifespan_days"),
        "o.avg_days_to_deliver",
        F.coalesce("o.late_orders", F.lit(0)).alias("late_orders"),
        F.when(total > 0, float_ratio("o.late_orders", "o.total_orders")).alias("late_order_rate"),
        "o.avg_review_score", "o.most_used_payment_type")


def int_customer_order_history(orders_enriched: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per person (customer_unique_id), canceled/unavailable orders left out.

    Orders roll up to the customer before the join, so a customer holding a
    third of the orders is one row in it; the person's averages are sums over
    counts. order_id is unique in the order grain (a declared check).
    """
    kept = orders_enriched.where(~F.col("order_status").isin("canceled", "unavailable"))
    averaged = {"gross": F.col("gross_order_value"), "score": F.col("review_score"),
                "days": F.col("days_to_deliver")}
    per_customer = kept.groupBy("customer_id").agg(
        F.count("order_id").alias("orders"),
        *[F.sum(c.cast("double")).alias(f"{k}_sum") for k, c in averaged.items()],
        *[F.count(c).alias(f"{k}_n") for k, c in averaged.items()],
        F.min("purchased_at").alias("first_at"), F.max("purchased_at").alias("last_at"),
        F.sum("item_count").alias("items"))
    joined = per_customer.join(customers.select("customer_id", "customer_unique_id"),
                               "customer_id", "inner")
    agg = joined.groupBy("customer_unique_id").agg(
        F.sum("orders").alias("total_orders"),
        F.sum("gross_sum").alias("lifetime_value"),
        _mean("gross_sum", "gross_n").alias("avg_order_value"),
        F.min("first_at").alias("first_order_at"),
        F.max("last_at").alias("last_order_at"),
        _mean("score_sum", "score_n").alias("avg_review_score"),
        _mean("days_sum", "days_n").alias("avg_days_to_deliver"),
        F.sum("items").alias("total_items_purchased"))
    n = F.col("total_orders")
    return agg.select(
        "customer_unique_id", "total_orders", "lifetime_value", "avg_order_value",
        "first_order_at", "last_order_at", "avg_review_score", "avg_days_to_deliver",
        "total_items_purchased",
        trunc_ts("month", "first_order_at").alias("cohort_month"),
        F.when(n == 1, "one_time").when(n.between(2, 3), "repeat").otherwise("loyal")
         .alias("customer_segment"))


# --------------------------------------------------------------- product grain

def _pairs(items: DataFrame, key: str) -> DataFrame:
    """Items collapsed to distinct (key, order_id) pairs: item count ``n`` and the
    price / freight sums and non-null counts of the pair's items."""
    return items.groupBy(key, "order_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("item_price").alias("price_sum"),
        F.count("item_price").alias("price_n"),
        F.sum("freight_value").alias("freight_sum"),
        F.count("freight_value").alias("freight_n"))


def _mean(total: str, count: str):
    return F.sum(total) / F.nullif(F.sum(count), F.lit(0))


def _distinct_count(items: DataFrame, key: str, other: str, name: str) -> DataFrame:
    return (items.select(key, other).distinct()
                 .groupBy(key).agg(F.count(other).alias(name)))


def int_products_enriched(products: DataFrame, items: DataFrame,
                          orders_enriched: DataFrame) -> DataFrame:
    """One row per product with sales, review and delivery measures.

    ``products`` is the staged product table; its English category already
    carries the translation, so the lookup is not joined a second time:
    without the final 'unknown' fallback it is the staged category whenever
    the original name is present, and NULL otherwise.
    """
    pairs = _pairs(items, "product_id")
    scores = orders_enriched.select("order_id", "review_score", "days_to_deliver")
    # one row per (product, order): all-order measures and reviewed-order
    # measures are conditional aggregates of a single pass
    with_orders = pairs.join(scores, "order_id", "left")
    reviewed, n = F.col("review_score").isNotNull(), F.col("n")
    ia = (with_orders.groupBy("product_id").agg(
              F.sum("n").alias("times_ordered"),
              F.count("order_id").alias("distinct_orders"),
              F.sum("price_sum").alias("total_revenue"),
              _mean("price_sum", "price_n").alias("avg_item_price"),
              _mean("freight_sum", "freight_n").alias("avg_freight_value"),
              F.sum("freight_sum").alias("total_freight_value"),
              weighted_avg("review_score", "n").alias("avg_review_score"),
              weighted_avg(F.when(reviewed, F.col("days_to_deliver")), "n")
               .alias("avg_days_to_deliver"),
              F.sum(F.when(F.col("review_score") == 1, n).otherwise(0)).cast("bigint")
               .alias("one_star_count"),
              F.count(F.when(reviewed, F.lit(1))).alias("reviewable_orders"))
          .join(_distinct_count(items, "product_id", "seller_id", "distinct_sellers"),
                "product_id", "left")).alias("ia")
    p = products.alias("p")
    joined = p.join(ia, F.col("p.product_id") == F.col("ia.product_id"), "left")
    reviewable = F.coalesce("ia.reviewable_orders", F.lit(0))
    avg_price = F.col("ia.avg_item_price")
    return joined.select(
        F.col("p.product_id").alias("product_id"),
        F.col("p.category_name_pt").alias("product_category_name"),
        F.when(F.col("p.category_name_pt").isNotNull(), F.col("p.category_name"))
         .alias("category_name_english"),
        F.col("p.name_length").alias("product_name_length"),
        F.col("p.description_length").alias("product_description_length"),
        F.col("p.photos_qty").alias("product_photos_qty"),
        F.col("p.weight_g").alias("product_weight_g"),
        F.col("p.length_cm").alias("product_length_cm"),
        F.col("p.height_cm").alias("product_height_cm"),
        F.col("p.width_cm").alias("product_width_cm"),
        (F.col("p.length_cm") * F.col("p.height_cm") * F.col("p.width_cm"))
         .alias("product_volume_cm3"),
        F.coalesce("ia.times_ordered", F.lit(0)).alias("times_ordered"),
        F.coalesce("ia.distinct_orders", F.lit(0)).alias("distinct_orders"),
        F.coalesce("ia.distinct_sellers", F.lit(0)).alias("distinct_sellers"),
        F.coalesce("ia.total_revenue", F.lit(0)).cast("double").alias("total_revenue"),
        avg_price.alias("avg_item_price"),
        F.col("ia.avg_freight_value").alias("avg_freight_value"),
        F.col("ia.total_freight_value").alias("total_freight_value"),
        F.when(avg_price > 0, F.col("ia.avg_freight_value") / avg_price)
         .alias("freight_to_price_ratio"),
        F.col("ia.avg_review_score").alias("avg_review_score"),
        F.col("ia.avg_days_to_deliver").alias("avg_days_to_deliver"),
        F.coalesce("ia.one_star_count", F.lit(0)).alias("one_star_count"),
        F.when(reviewable > 0, float_ratio("ia.one_star_count", "ia.reviewable_orders"))
         .alias("one_star_rate"))


# ---------------------------------------------------------------- seller grain

def int_sellers_enriched(sellers: DataFrame, geo: DataFrame, items: DataFrame,
                         orders_enriched: DataFrame) -> DataFrame:
    """One row per seller with sales, delivery and review measures.

    Delivery and review measures use delivered orders and weigh each order by
    the seller's item rows in it; rates divide by the seller's distinct orders
    (all statuses for lateness, delivered for one-star).
    """
    promised = F.when(F.col("estimated_delivery_at").isNotNull(),
                      days_between("shipped_at", "estimated_delivery_at"))
    perf = orders_enriched.select(
        "order_id", (F.col("order_status") == "delivered").alias("delivered"),
        "days_to_deliver", "review_score", "is_late_delivery", promised.alias("promised_window"))
    # one row per (seller, order): all-order measures and delivered-order
    # measures are conditional aggregates of a single pass
    with_orders = _pairs(items, "seller_id").join(perf, "order_id", "left")
    d, n, score = F.coalesce("delivered", F.lit(False)), F.col("n"), F.col("review_score")

    def on_delivered(c):
        return F.when(d, F.col(c))

    ia = (with_orders.groupBy("seller_id").agg(
              F.count("order_id").alias("total_orders"),
              F.sum("n").alias("total_items_sold"),
              F.sum("price_sum").alias("total_revenue"),
              F.sum("freight_sum").alias("total_freight_collected"),
              _mean("price_sum", "price_n").alias("avg_item_price"),
              weighted_avg(on_delivered("days_to_deliver"), "n").alias("avg_days_to_deliver"),
              weighted_avg(on_delivered("promised_window"), "n").alias("avg_promised_window"),
              F.sum(F.when(d & F.col("is_late_delivery"), n).otherwise(0)).cast("bigint")
               .alias("late_orders"),
              F.count(F.when(d, F.lit(1))).alias("scorable_orders"),
              weighted_avg(on_delivered("review_score"), "n").alias("avg_review_score"),
              F.sum(F.when(d & (score == 1), n).otherwise(0)).cast("bigint")
               .alias("one_star_reviews"),
              F.sum(F.when(d & (score == 5), n).otherwise(0)).cast("bigint")
               .alias("five_star_reviews"))
          .join(_distinct_count(items, "seller_id", "product_id", "distinct_products"),
                "seller_id", "left")).alias("ia")
    s = with_geo(sellers, geo, "seller").alias("s")
    joined = s.join(ia, F.col("s.seller_id") == F.col("ia.seller_id"), "left")
    total_orders = F.coalesce("ia.total_orders", F.lit(0))
    revenue = F.coalesce("ia.total_revenue", F.lit(0)).cast("double")
    late = F.coalesce("ia.late_orders", F.lit(0))
    scorable = F.coalesce("ia.scorable_orders", F.lit(0))
    return joined.select(
        F.col("s.seller_id").alias("seller_id"), "s.zip_code_prefix", "s.state", "s.city",
        "s.seller_lat", "s.seller_lng",
        total_orders.alias("total_orders"),
        F.coalesce("ia.total_items_sold", F.lit(0)).alias("total_items_sold"),
        F.coalesce("ia.distinct_products", F.lit(0)).alias("distinct_products"),
        revenue.alias("total_revenue"),
        F.coalesce("ia.total_freight_collected", F.lit(0)).cast("double")
         .alias("total_freight_collected"),
        "ia.avg_item_price",
        "ia.avg_days_to_deliver", "ia.avg_promised_window",
        late.alias("late_orders"),
        F.when(total_orders > 0, float_ratio(late, "ia.total_orders")).alias("late_delivery_rate"),
        "ia.avg_review_score",
        F.coalesce("ia.one_star_reviews", F.lit(0)).alias("one_star_reviews"),
        F.coalesce("ia.five_star_reviews", F.lit(0)).alias("five_star_reviews"),
        F.when(scorable > 0, float_ratio("ia.one_star_reviews", "ia.scorable_orders"))
         .alias("one_star_rate"),
        ((revenue > 10000) & (F.coalesce("ia.avg_review_score", F.lit(5.0)) < 3))
         .alias("is_high_revenue_low_rating"))
