"""DuckDB SQL for every registered query: the correctness oracle.

Each model is one named CTE; a query is the WITH clause of the CTEs it needs
(in dependency order) plus a final SELECT. The ``src_*`` CTEs map the driver's
star-schema test tables (pre-registered views) to the raw marketplace tables,
expression for expression the same as :mod:`agora.sources.testdata`.
Ties in orderings are broken exactly as in the Spark builders.
"""

from __future__ import annotations

import re

from agora.operators import quality

# name -> SQL body of the CTE. Dependencies are read from the body (names of
# other CTEs it mentions), so the list below only needs to be complete.
CTES: dict[str, str] = {}


def _cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


# ------------------------------------------------------------ source mapping
_cte("src_orders", """
SELECT order_id, customer_id, order_status,
       p AS order_purchase_timestamp,
       p + INTERVAL 1 HOUR AS order_approved_at,
       CASE WHEN order_status IN ('delivered', 'shipped')
            THEN p + INTERVAL 1 DAY * CAST(1 + k % 4 AS INTEGER) END AS order_delivered_carrier_date,
       CASE WHEN order_status = 'delivered' AND k % 97 <> 0
            THEN p + INTERVAL 1 DAY * CAST(4 + (k * 7) % 30 AS INTEGER)
                   + INTERVAL 1 HOUR * CAST(k % 11 AS INTEGER) END AS order_delivered_customer_date,
       o_orderdate + INTERVAL 1 DAY * 25 AS order_estimated_delivery_date
FROM (
  SELECT o_orderkey AS order_id, o_orderkey AS k,
         CASE WHEN o_custkey >= 12 AND (o_custkey % 12 = 0
                                        OR (o_custkey % 12 = 1 AND o_orderkey % 8 <> 0)
                                        OR (o_custkey % 12 = 2 AND o_orderkey % 4 <> 0))
              THEN o_custkey - o_custkey % 12 - 1 ELSE o_custkey END AS customer_id, o_orderdate,
         o_orderdate + INTERVAL 1 HOUR * CAST(o_orderkey % 24 AS INTEGER) AS p,
         CASE WHEN o_orderstatus IN ('F', 'P') THEN
                CASE WHEN o_orderkey % 29 = 0 THEN 'canceled'
                     WHEN o_orderkey % 31 = 0 THEN 'unavailable'
                     ELSE 'delivered' END
              ELSE CASE o_orderkey % 4 WHEN 0 THEN 'shipped' WHEN 1 THEN 'processing'
                                       WHEN 2 THEN 'approved' ELSE 'invoiced' END
         END AS order_status
  FROM orders
) mapped""")

_cte("src_customers", """
SELECT c_custkey AS customer_id,
       c_custkey - c_custkey % 2 AS customer_unique_id,
       CAST(c_nationkey * 100 + c_custkey % 10 AS INTEGER) AS customer_zip_code_prefix,
       concat('  ', n_name, ' City ') AS customer_city,
       concat(' st', CAST(c_nationkey AS VARCHAR), ' ') AS customer_state
FROM customer JOIN nation ON c_nationkey = n_nationkey""")

_cte("src_sellers", """
SELECT s_suppkey AS seller_id,
       CAST(s_nationkey * 100 + s_suppkey % 10 AS INTEGER) AS seller_zip_code_prefix,
       concat(' ', n_name, ' Town ') AS seller_city,
       concat(' st', CAST(s_nationkey AS VARCHAR)) AS seller_state
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")

_cte("src_geolocation", """
SELECT CAST(n_nationkey * 100 + r_regionkey AS INTEGER) AS geolocation_zip_code_prefix,
       CAST(n_nationkey AS DOUBLE) + 0.5 + k * 0.25 AS geolocation_lat,
       CAST(r_regionkey AS DOUBLE) - 40.25 AS geolocation_lng,
       concat('geo ', n_name) AS geolocation_city,
       concat('ST', CAST(n_nationkey AS VARCHAR)) AS geolocation_state
FROM nation CROSS JOIN region CROSS JOIN (VALUES (0), (1)) pts(k)""")

_cte("src_products", """
SELECT p_partkey AS product_id,
       CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE lower(p_type) END AS product_category_name,
       CAST(length(p_name) AS INTEGER) AS product_name_lenght,
       CAST(length(p_name) * 10 AS INTEGER) AS product_description_lenght,
       CAST(p_partkey % 6 AS INTEGER) AS product_photos_qty,
       CASE WHEN p_partkey % 40 = 1 THEN NULL ELSE CAST(p_size * 100 AS DOUBLE) END AS product_weight_g,
       CASE WHEN p_partkey % 40 = 1 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS product_length_cm,
       CAST(1 + p_partkey % 60 AS DOUBLE) AS product_height_cm,
       CAST(5 + p_partkey % 45 AS DOUBLE) AS product_width_cm
FROM part""")

_cte("src_translation", """
SELECT DISTINCT lower(p_type) AS product_category_name,
       CASE WHEN lower(p_type) <> 'promo' THEN concat('en_', lower(p_type)) END
         AS product_category_name_english
FROM part""")

_cte("src_order_items", """
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
       CASE WHEN l_suppkey % 23 = 22 THEN l_suppkey - 1 ELSE l_suppkey END AS seller_id,
       l_shipdate AS shipping_limit_date,
       CAST(floor(l_extendedprice / CASE l_suppkey % 5 WHEN 0 THEN 100.0 WHEN 1 THEN 400.0
                                        WHEN 2 THEN 1600.0 WHEN 3 THEN 6400.0 ELSE 25600.0 END)
            + 1 AS DOUBLE) AS price,
       CAST(5 + l_quantity * 0.5 AS DOUBLE) AS freight_value
FROM lineitem""")

_cte("src_order_payments", """
SELECT o_orderkey AS order_id, 1 AS payment_sequential,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'boleto'
                            WHEN '3-MEDIUM' THEN 'debit_card' WHEN '4-NOT SPECIFIED' THEN 'voucher'
                            ELSE 'credit_card' END AS payment_type,
       CAST(1 + o_orderkey % 10 AS INTEGER) AS payment_installments,
       CAST(CASE WHEN o_orderkey % 3 = 0 THEN floor(o_totalprice * 0.7)
                 ELSE floor(o_totalprice) END AS DOUBLE) AS payment_value
FROM orders
UNION ALL
SELECT o_orderkey, 2, 'voucher', 1, CAST(floor(o_totalprice * 0.3) AS DOUBLE)
FROM orders WHERE o_orderkey % 3 = 0""")

_cte("src_order_reviews", """
SELECT o_orderkey * 10 + k AS review_id, o_orderkey AS order_id,
       CAST(1 + (o_orderkey * 3 + k) % 5 AS INTEGER) AS review_score,
       CAST(NULL AS VARCHAR) AS review_comment_title,
       CAST(NULL AS VARCHAR) AS review_comment_message,
       o_orderdate + INTERVAL 1 DAY * CAST(30 + k AS INTEGER) AS review_creation_date,
       o_orderdate + INTERVAL 1 DAY * CAST(31 + k AS INTEGER) AS review_answer_timestamp
FROM orders CROSS JOIN (VALUES (0), (1)) copies(k)
WHERE k = 0 OR o_orderkey % 20 = 0""")

# ------------------------------------------------------------------- staging
_cte("stg_orders", """
SELECT order_id, customer_id, order_status,
       order_purchase_timestamp AS purchased_at,
       order_approved_at AS approved_at,
       order_delivered_carrier_date AS shipped_at,
       order_delivered_customer_date AS delivered_at,
       order_estimated_delivery_date AS estimated_delivery_at,
       CASE WHEN order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL
            THEN order_delivered_customer_date > order_estimated_delivery_date END AS is_late_delivery,
       CASE WHEN order_delivered_customer_date IS NOT NULL AND order_purchase_timestamp IS NOT NULL
            THEN datediff('day', order_purchase_timestamp, order_delivered_customer_date) END
         AS days_to_deliver
FROM src_orders""")

_cte("stg_customers", """
SELECT customer_id, customer_unique_id, customer_zip_code_prefix AS zip_code_prefix,
       lower(trim(customer_city)) AS city, upper(trim(customer_state)) AS state
FROM src_customers""")

_cte("stg_order_items", """
SELECT order_id, order_item_id AS item_seq, product_id, seller_id,
       CAST(price AS DOUBLE) AS item_price, CAST(freight_value AS DOUBLE) AS freight_value,
       shipping_limit_date, CAST(price + freight_value AS DOUBLE) AS total_item_value
FROM src_order_items""")

_cte("stg_order_payments", """
SELECT order_id, CAST(payment_sequential AS INTEGER) AS payment_seq, payment_type,
       CAST(payment_installments AS INTEGER) AS installments,
       CAST(payment_value AS DOUBLE) AS payment_value
FROM src_order_payments""")

_cte("stg_order_reviews", """
SELECT review_id, order_id, review_score, comment_title, comment_message,
       review_created_at, review_answered_at,
       CASE WHEN review_score >= 4 THEN 'positive' WHEN review_score = 3 THEN 'neutral'
            ELSE 'negative' END AS sentiment
FROM (
  SELECT review_id, order_id, CAST(review_score AS INTEGER) AS review_score,
         review_comment_title AS comment_title, review_comment_message AS comment_message,
         review_creation_date AS review_created_at, review_answer_timestamp AS review_answered_at,
         row_number() OVER (PARTITION BY order_id
                            ORDER BY review_answer_timestamp DESC NULLS LAST, review_id DESC) AS rn
  FROM src_order_reviews
) ranked WHERE rn = 1""")

_cte("stg_product_category_name_translation", """
SELECT product_category_name, product_category_name_english FROM src_translation""")

_cte("stg_products", """
SELECT p.product_id,
       coalesce(t.product_category_name_english, p.product_category_name, 'unknown') AS category_name,
       p.product_category_name AS category_name_pt,
       CAST(p.product_name_lenght AS INTEGER) AS name_length,
       CAST(p.product_description_lenght AS INTEGER) AS description_length,
       CAST(p.product_photos_qty AS INTEGER) AS photos_qty,
       CAST(p.product_weight_g AS DOUBLE) AS weight_g,
       CAST(p.product_length_cm AS DOUBLE) AS length_cm,
       CAST(p.product_height_cm AS DOUBLE) AS height_cm,
       CAST(p.product_width_cm AS DOUBLE) AS width_cm,
       CAST(p.product_length_cm AS DOUBLE) * CAST(p.product_height_cm AS DOUBLE)
         * CAST(p.product_width_cm AS DOUBLE) AS volume_cm3
FROM src_products p
LEFT JOIN stg_product_category_name_translation t ON p.product_category_name = t.product_category_name""")

_cte("stg_sellers", """
SELECT seller_id, seller_zip_code_prefix AS zip_code_prefix,
       lower(trim(seller_city)) AS city, upper(trim(seller_state)) AS state
FROM src_sellers""")

_cte("stg_geolocation", """
SELECT geolocation_zip_code_prefix AS zip_code_prefix, geolocation_lat AS lat,
       geolocation_lng AS lng, lower(trim(geolocation_city)) AS city,
       upper(trim(geolocation_state)) AS state
FROM src_geolocation""")

_cte("geo_by_zip", """
SELECT zip_code_prefix, state, city, lat, lng FROM (
  SELECT *, row_number() OVER (PARTITION BY zip_code_prefix
                               ORDER BY lat NULLS LAST, lng NULLS LAST,
                                        city NULLS LAST, state NULLS LAST) AS rn
  FROM stg_geolocation
) ranked WHERE rn = 1""")

# -------------------------------------------------------------- intermediate
def _distinct_per_order(column: str) -> str:
    return (f"(SELECT order_id, count({column}) AS n FROM "
            f"(SELECT DISTINCT order_id, {column} FROM stg_order_items) pairs GROUP BY order_id)")


# one row per order: the sums of its items, and the sizes of its two sets of pairs
_cte("order_items_agg", f"""
SELECT t.order_id, t.n AS item_count, p.n AS distinct_products, s.n AS distinct_sellers,
       t.price AS items_revenue, t.freight AS freight_revenue, t.both_values AS gross_order_value
FROM (SELECT order_id, count(*) AS n, sum(item_price) AS price, sum(freight_value) AS freight,
             sum(total_item_value) AS both_values
      FROM stg_order_items GROUP BY order_id) t
JOIN {_distinct_per_order("product_id")} p ON p.order_id IS NOT DISTINCT FROM t.order_id
JOIN {_distinct_per_order("seller_id")} s ON s.order_id IS NOT DISTINCT FROM t.order_id""")

# one row per order and payment type, then per order: the type with the largest payment leads
_cte("order_type_payments", """
SELECT order_id, payment_type, sum(payment_value) AS value, max(payment_value) AS top,
       max(installments) AS installments
FROM stg_order_payments GROUP BY ALL""")

_cte("order_payments_agg", """
SELECT order_id, sum(value) AS total_payment_value, max(installments) AS max_installments,
       list_extract(list(payment_type ORDER BY top DESC NULLS LAST, payment_type NULLS LAST), 1)
         AS primary_payment_type,
       count(payment_type) AS payment_methods_used
FROM order_type_payments GROUP BY order_id""")

_cte("int_orders_enriched", """
SELECT o.order_id, o.customer_id, o.order_status, o.purchased_at, o.approved_at, o.shipped_at,
       o.delivered_at, o.estimated_delivery_at, o.days_to_deliver, o.is_late_delivery,
       coalesce(i.item_count, 0) AS item_count,
       coalesce(i.distinct_products, 0) AS distinct_products,
       coalesce(i.distinct_sellers, 0) AS distinct_sellers,
       coalesce(i.items_revenue, 0) AS items_revenue,
       coalesce(i.freight_revenue, 0) AS freight_revenue,
       coalesce(i.gross_order_value, 0) AS gross_order_value,
       coalesce(p.total_payment_value, 0) AS total_payment_value,
       p.primary_payment_type,
       coalesce(p.max_installments, 1) AS max_installments,
       coalesce(p.payment_methods_used, 0) AS payment_methods_used,
       r.review_score, r.sentiment AS review_sentiment,
       date_trunc('month', o.purchased_at) AS order_month,
       date_trunc('week', o.purchased_at) AS order_week,
       dayofweek(o.purchased_at) AS purchase_day_of_week,
       hour(o.purchased_at) AS purchase_hour
FROM stg_orders o
LEFT JOIN order_items_agg i ON o.order_id = i.order_id
LEFT JOIN order_payments_agg p ON o.order_id = p.order_id
LEFT JOIN stg_order_reviews r ON o.order_id = r.order_id""")

_cte("customer_orders_agg", """
SELECT customer_id, count(*) AS total_orders,
       count(CASE WHEN order_status = 'delivered' THEN 1 END) AS delivered_orders,
       sum(gross_order_value) AS lifetime_gmv, sum(freight_revenue) AS lifetime_freight,
       avg(gross_order_value) AS avg_order_value,
       -- summed as whole numbers of 1e-12: independent of the order of the rows
       CAST(sum(CAST(floor(CASE WHEN gross_order_value > 0
                                THEN freight_revenue / gross_order_value END * 1e12 + 0.5)
                     AS HUGEINT)) AS DOUBLE) / 1e12
         / count(CASE WHEN gross_order_value > 0 THEN 1 END) AS avg_freight_pct,
       min(purchased_at) AS first_order_at, max(purchased_at) AS last_order_at,
       avg(days_to_deliver) AS avg_days_to_deliver,
       CAST(sum(CASE WHEN is_late_delivery THEN 1 ELSE 0 END) AS BIGINT) AS late_orders,
       avg(review_score) AS avg_review_score,
       max(primary_payment_type) AS most_used_payment_type
FROM int_orders_enriched GROUP BY customer_id""")

_cte("customer_places", """
SELECT c.customer_id, c.customer_unique_id, c.zip_code_prefix,
       coalesce(g.state, c.state) AS state, coalesce(g.city, c.city) AS city,
       g.lat AS customer_lat, g.lng AS customer_lng
FROM stg_customers c LEFT JOIN geo_by_zip g ON c.zip_code_prefix = g.zip_code_prefix""")

_cte("int_customers_enriched", """
SELECT c.customer_id, c.customer_unique_id, c.zip_code_prefix, c.state, c.city,
       c.customer_lat, c.customer_lng,
       coalesce(o.total_orders, 0) AS total_orders,
       coalesce(o.delivered_orders, 0) AS delivered_orders,
       coalesce(o.lifetime_gmv, 0) AS lifetime_gmv,
       coalesce(o.lifetime_freight, 0) AS lifetime_freight,
       o.avg_order_value, o.avg_freight_pct,
       coalesce(o.total_orders, 0) > 1 AS is_repeat_buyer,
       o.first_order_at, o.last_order_at,
       datediff('day', o.first_order_at, o.last_order_at) AS customer_lifespan_days,
       o.avg_days_to_deliver,
       coalesce(o.late_orders, 0) AS late_orders,
       CASE WHEN coalesce(o.total_orders, 0) > 0
            THEN o.late_orders::FLOAT / o.total_orders END AS late_order_rate,
       o.avg_review_score, o.most_used_payment_type
FROM customer_places c LEFT JOIN customer_orders_agg o ON c.customer_id = o.customer_id""")

_cte("product_items_agg", """
SELECT product_id, count(*) AS times_ordered, count(DISTINCT order_id) AS distinct_orders,
       count(DISTINCT seller_id) AS distinct_sellers, sum(item_price) AS total_revenue,
       avg(item_price) AS avg_item_price, avg(freight_value) AS avg_freight_value,
       sum(freight_value) AS total_freight_value
FROM stg_order_items GROUP BY product_id""")

_cte("product_reviews_agg", """
SELECT i.product_id, avg(o.review_score) AS avg_review_score,
       avg(o.days_to_deliver) AS avg_days_to_deliver,
       CAST(sum(CASE WHEN o.review_score = 1 THEN 1 ELSE 0 END) AS BIGINT) AS one_star_count,
       count(DISTINCT i.order_id) AS reviewable_orders
FROM stg_order_items i JOIN int_orders_enriched o ON i.order_id = o.order_id
WHERE o.review_score IS NOT NULL
GROUP BY i.product_id""")

_cte("int_products_enriched", """
SELECT p.product_id, p.category_name_pt AS product_category_name,
       coalesce(t.product_category_name_english, p.category_name_pt) AS category_name_english,
       p.name_length AS product_name_length, p.description_length AS product_description_length,
       p.photos_qty AS product_photos_qty, p.weight_g AS product_weight_g,
       p.length_cm AS product_length_cm, p.height_cm AS product_height_cm,
       p.width_cm AS product_width_cm,
       p.length_cm * p.height_cm * p.width_cm AS product_volume_cm3,
       coalesce(ia.times_ordered, 0) AS times_ordered,
       coalesce(ia.distinct_orders, 0) AS distinct_orders,
       coalesce(ia.distinct_sellers, 0) AS distinct_sellers,
       coalesce(ia.total_revenue, 0) AS total_revenue,
       ia.avg_item_price, ia.avg_freight_value, ia.total_freight_value,
       CASE WHEN ia.avg_item_price > 0 THEN ia.avg_freight_value / ia.avg_item_price END
         AS freight_to_price_ratio,
       ra.avg_review_score, ra.avg_days_to_deliver,
       coalesce(ra.one_star_count, 0) AS one_star_count,
       CASE WHEN coalesce(ra.reviewable_orders, 0) > 0
            THEN ra.one_star_count::FLOAT / ra.reviewable_orders END AS one_star_rate
FROM stg_products p
LEFT JOIN stg_product_category_name_translation t ON p.category_name_pt = t.product_category_name
LEFT JOIN product_items_agg ia ON p.product_id = ia.product_id
LEFT JOIN product_reviews_agg ra ON p.product_id = ra.product_id""")

_cte("seller_items_agg", """
SELECT seller_id, count(DISTINCT order_id) AS total_orders, count(*) AS total_items_sold,
       count(DISTINCT product_id) AS distinct_products, sum(item_price) AS total_revenue,
       sum(freight_value) AS total_freight_collected, avg(item_price) AS avg_item_price
FROM stg_order_items GROUP BY seller_id""")

_cte("seller_perf_agg", """
SELECT i.seller_id, avg(o.days_to_deliver) AS avg_days_to_deliver,
       avg(CASE WHEN o.estimated_delivery_at IS NOT NULL
                THEN datediff('day', o.shipped_at, o.estimated_delivery_at) END) AS avg_promised_window,
       CAST(sum(CASE WHEN o.is_late_delivery THEN 1 ELSE 0 END) AS BIGINT) AS late_orders,
       count(DISTINCT i.order_id) AS scorable_orders,
       avg(o.review_score) AS avg_review_score,
       CAST(sum(CASE WHEN o.review_score = 1 THEN 1 ELSE 0 END) AS BIGINT) AS one_star_reviews,
       CAST(sum(CASE WHEN o.review_score = 5 THEN 1 ELSE 0 END) AS BIGINT) AS five_star_reviews
FROM stg_order_items i JOIN int_orders_enriched o ON i.order_id = o.order_id
WHERE o.order_status = 'delivered'
GROUP BY i.seller_id""")

_cte("int_sellers_enriched", """
SELECT s.seller_id, s.zip_code_prefix,
       coalesce(g.state, s.state) AS state, coalesce(g.city, s.city) AS city,
       g.lat AS seller_lat, g.lng AS seller_lng,
       coalesce(ia.total_orders, 0) AS total_orders,
       coalesce(ia.total_items_sold, 0) AS total_items_sold,
       coalesce(ia.distinct_products, 0) AS distinct_products,
       coalesce(ia.total_revenue, 0) AS total_revenue,
       coalesce(ia.total_freight_collected, 0) AS total_freight_collected,
       ia.avg_item_price, op.avg_days_to_deliver, op.avg_promised_window,
       coalesce(op.late_orders, 0) AS late_orders,
       CASE WHEN coalesce(ia.total_orders, 0) > 0
            THEN coalesce(op.late_orders, 0)::FLOAT / ia.total_orders END AS late_delivery_rate,
       op.avg_review_score,
       coalesce(op.one_star_reviews, 0) AS one_star_reviews,
       coalesce(op.five_star_reviews, 0) AS five_star_reviews,
       CASE WHEN coalesce(op.scorable_orders, 0) > 0
            THEN op.one_star_reviews::FLOAT / op.scorable_orders END AS one_star_rate,
       coalesce(ia.total_revenue, 0) > 10000 AND coalesce(op.avg_review_score, 5) < 3
         AS is_high_revenue_low_rating
FROM stg_sellers s
LEFT JOIN geo_by_zip g ON s.zip_code_prefix = g.zip_code_prefix
LEFT JOIN seller_items_agg ia ON s.seller_id = ia.seller_id
LEFT JOIN seller_perf_agg op ON s.seller_id = op.seller_id""")

_cte("int_customer_order_history", """
SELECT c.customer_unique_id,
       count(DISTINCT o.order_id) AS total_orders,
       sum(o.gross_order_value) AS lifetime_value,
       avg(o.gross_order_value) AS avg_order_value,
       min(o.purchased_at) AS first_order_at, max(o.purchased_at) AS last_order_at,
       avg(o.review_score) AS avg_review_score,
       avg(o.days_to_deliver) AS avg_days_to_deliver,
       CAST(sum(o.item_count) AS BIGINT) AS total_items_purchased,
       date_trunc('month', min(o.purchased_at)) AS cohort_month,
       CASE WHEN count(DISTINCT o.order_id) = 1 THEN 'one_time'
            WHEN count(DISTINCT o.order_id) BETWEEN 2 AND 3 THEN 'repeat'
            ELSE 'loyal' END AS customer_segment
FROM int_orders_enriched o JOIN stg_customers c ON o.customer_id = c.customer_id
WHERE o.order_status NOT IN ('canceled', 'unavailable')
GROUP BY c.customer_unique_id""")

# ---------------------------------------------------------------------- core
_cte("dim_customers", """
SELECT customer_id, customer_unique_id, state, city, customer_lat, customer_lng,
       CASE WHEN total_orders = 0 THEN 'no_orders' WHEN total_orders = 1 THEN 'one_time'
            WHEN total_orders BETWEEN 2 AND 3 THEN 'occasional' ELSE 'loyal' END AS customer_segment,
       is_repeat_buyer,
       CASE WHEN lifetime_gmv = 0 THEN 'no_spend' WHEN lifetime_gmv < 100 THEN 'low'
            WHEN lifetime_gmv < 500 THEN 'mid' WHEN lifetime_gmv < 2000 THEN 'high'
            ELSE 'vip' END AS ltv_bucket,
       total_orders, delivered_orders, lifetime_gmv, lifetime_freight, avg_order_value,
       avg_freight_pct, first_order_at, last_order_at, customer_lifespan_days,
       avg_days_to_deliver, late_orders, late_order_rate, avg_review_score, most_used_payment_type
FROM int_customers_enriched""")

_cte("dim_products", """
SELECT product_id, product_category_name, category_name_english, product_weight_g,
       product_length_cm, product_height_cm, product_width_cm, product_volume_cm3,
       CASE WHEN product_volume_cm3 IS NULL THEN 'unknown' WHEN product_volume_cm3 < 1000 THEN 'tiny'
            WHEN product_volume_cm3 < 10000 THEN 'small' WHEN product_volume_cm3 < 50000 THEN 'medium'
            ELSE 'large' END AS size_bucket,
       product_photos_qty, product_name_length, product_description_length, times_ordered,
       total_revenue, avg_item_price, avg_freight_value, freight_to_price_ratio,
       avg_review_score, avg_days_to_deliver, one_star_rate
FROM int_products_enriched""")

_cte("dim_sellers", """
SELECT seller_id, state, city, seller_lat, seller_lng,
       CASE WHEN total_revenue = 0 THEN 'inactive' WHEN total_revenue < 5000 THEN 'small'
            WHEN total_revenue < 50000 THEN 'mid' ELSE 'large' END AS seller_tier,
       CASE WHEN avg_review_score >= 4.5 THEN 'excellent' WHEN avg_review_score >= 4.0 THEN 'good'
            WHEN avg_review_score >= 3.0 THEN 'average' WHEN avg_review_score IS NULL THEN 'unrated'
            ELSE 'poor' END AS quality_tier,
       is_high_revenue_low_rating AS is_risk_seller,
       total_orders, total_items_sold, distinct_products, total_revenue, total_freight_collected,
       avg_item_price, avg_days_to_deliver, late_delivery_rate, avg_review_score,
       one_star_reviews, five_star_reviews, one_star_rate
FROM int_sellers_enriched""")

_cte("fct_orders", """
SELECT o.order_id, o.customer_id, c.state AS customer_state, c.city AS customer_city,
       o.order_status, o.purchased_at, o.approved_at, o.shipped_at, o.delivered_at,
       o.estimated_delivery_at, o.order_month, o.order_week, o.purchase_day_of_week,
       o.purchase_hour, o.item_count, o.distinct_products, o.distinct_sellers,
       o.items_revenue, o.freight_revenue, o.gross_order_value, o.total_payment_value,
       o.primary_payment_type, o.max_installments, o.payment_methods_used,
       o.days_to_deliver, o.is_late_delivery, o.review_score, o.review_sentiment
FROM int_orders_enriched o LEFT JOIN int_customers_enriched c ON o.customer_id = c.customer_id""")

# ----------------------------------------------------------------- analytics
_cte("mart_revenue_monthly", """
SELECT o.order_month, date_trunc('quarter', o.purchased_at) AS order_quarter,
       coalesce(p.category_name_english, 'unknown') AS category_name_english,
       o.primary_payment_type,
       count(DISTINCT o.order_id) AS order_count,
       sum(i.item_price + i.freight_value) AS gross_order_value,
       sum(i.item_price) AS items_revenue, sum(i.freight_value) AS freight_revenue,
       sum(i.item_price + i.freight_value) / nullif(count(DISTINCT o.order_id), 0) AS avg_order_value
FROM fct_orders o
JOIN stg_order_items i ON o.order_id = i.order_id
LEFT JOIN int_products_enriched p ON i.product_id = p.product_id
WHERE o.order_status IN ('delivered', 'shipped', 'processing', 'approved')
GROUP BY 1, 2, 3, 4""")

_cte("mart_delivery_performance", """
SELECT o.customer_state, s.seller_id,
       count(*) AS delivered_orders,
       CAST(sum(CASE WHEN o.is_late_delivery THEN 0 ELSE 1 END) AS BIGINT) AS on_time_orders,
       CAST(sum(CASE WHEN o.is_late_delivery THEN 1 ELSE 0 END) AS BIGINT) AS late_orders,
       sum(CASE WHEN o.is_late_delivery THEN 1 ELSE 0 END)::FLOAT / nullif(count(*), 0)
         AS late_delivery_rate,
       avg(o.days_late) AS avg_days_late,
       avg(CASE WHEN o.is_late_delivery THEN o.days_late END) AS avg_days_late_when_late,
       avg(o.days_to_deliver) AS avg_days_to_deliver,
       avg(o.review_score) AS avg_review_score,
       avg(CASE WHEN o.is_late_delivery THEN o.review_score END) AS avg_review_score_when_late,
       avg(CASE WHEN NOT o.is_late_delivery THEN o.review_score END) AS avg_review_score_when_on_time,
       CAST(sum(CASE WHEN o.review_sentiment = 'positive' THEN 1 ELSE 0 END) AS BIGINT) AS positive_reviews,
       CAST(sum(CASE WHEN o.review_sentiment = 'negative' THEN 1 ELSE 0 END) AS BIGINT) AS negative_reviews,
       count(DISTINCT o.order_month) AS active_months
FROM (
  SELECT *, CASE WHEN delivered_at IS NOT NULL AND estimated_delivery_at IS NOT NULL
                 THEN datediff('day', estimated_delivery_at, delivered_at) END AS days_late
  FROM fct_orders WHERE order_status = 'delivered'
) o
JOIN (SELECT DISTINCT order_id, seller_id FROM stg_order_items) s ON o.order_id = s.order_id
GROUP BY 1, 2""")

_cte("state_concentration", """
SELECT state, count(*) AS sellers_in_state,
       CAST(count(*) AS DOUBLE) * 100.0 / sum(count(*)) OVER () AS pct_of_all_sellers
FROM dim_sellers GROUP BY state""")

def _places(table: str, key: str, order: str) -> str:
    """(key, place) of a table's rows: places 1, 2, ... in the order given."""
    return (f"(SELECT unnest(list({key} ORDER BY {order}, {key})) AS {key}, "
            f"unnest(range(1, count(*) + 1)) AS place FROM {table})")


def _tile(place: str, total: str, k: int) -> str:
    """The one of ``k`` buckets, the first ones a row larger, that a place falls into."""
    whole, over = f"({total} // {k})", f"({total} % {k})"
    head = f"({over} * ({whole} + 1))"
    return (f"CASE WHEN {place} <= {head} THEN ({place} - 1) // ({whole} + 1) + 1 "
            f"ELSE {over} + ({place} - 1 - {head}) // greatest({whole}, 1) + 1 END")


_cte("ranked_sellers", "SELECT * FROM dim_sellers WHERE total_orders > 0")
_cte("seller_total", "SELECT count(*) AS n FROM ranked_sellers")
_cte("mart_seller_health", f"""
SELECT d.seller_id, d.state, d.city, d.seller_lat, d.seller_lng, d.seller_tier, d.quality_tier,
       d.is_risk_seller, rev.place AS revenue_rank, score.place AS review_rank,
       {_tile("rev.place", "total.n", 10)} AS revenue_decile, rev.place <= 10 AS is_top_10_seller,
       d.total_orders, d.total_items_sold, d.distinct_products, d.total_revenue,
       d.avg_item_price, d.avg_days_to_deliver, d.late_delivery_rate, d.avg_review_score,
       d.one_star_reviews, d.five_star_reviews, d.one_star_rate,
       c.sellers_in_state, c.pct_of_all_sellers AS pct_sellers_in_state
FROM {_places("ranked_sellers", "seller_id", "total_revenue DESC NULLS LAST")} rev
JOIN {_places("ranked_sellers", "seller_id", "avg_review_score DESC NULLS LAST")} score USING (seller_id)
JOIN ranked_sellers d USING (seller_id) LEFT JOIN state_concentration c ON c.state = d.state,
     seller_total total""")

# recency in days before the latest of all last orders
_cte("buyers", """
SELECT customer_id, total_orders AS frequency, lifetime_gmv AS monetary,
       datediff('day', last_order_at, max(last_order_at) OVER ()) AS recency_days
FROM dim_customers WHERE customer_segment <> 'no_orders'""")
_cte("buyer_total", "SELECT count(*) AS n FROM buyers")
_cte("rfm_scored", f"""
SELECT b.*, {_tile("r.place", "total.n", 5)} AS r_score, {_tile("f.place", "total.n", 5)} AS f_score,
       {_tile("m.place", "total.n", 5)} AS m_score
FROM buyers b JOIN {_places("buyers", "customer_id", "recency_days NULLS LAST")} r USING (customer_id)
JOIN {_places("buyers", "customer_id", "frequency NULLS LAST")} f USING (customer_id)
JOIN {_places("buyers", "customer_id", "monetary NULLS LAST")} m USING (customer_id), buyer_total total""")

# Conditions of the labels, the first that holds decides.
RFM_LABELS = (
    ("Champions", "r_score >= 4 AND f_score >= 4"),
    ("Loyal Customers", "r_score >= 3 AND f_score >= 3"),
    ("Recent Customers", "r_score >= 4 AND f_score <= 2"),
    ("Potential Loyalists", "r_score >= 3 AND f_score <= 3 AND m_score >= 3"),
    ("At Risk", "r_score <= 2 AND f_score >= 4"),
    ("Lost", "r_score <= 2 AND f_score <= 2 AND m_score <= 2"),
)
_RFM_LABEL = "coalesce({}, 'Needs Attention')".format(
    ", ".join(f"if({condition}, '{label}', NULL)" for label, condition in RFM_LABELS))

_cte("rfm_segmentation", f"""
SELECT {_RFM_LABEL} AS rfm_label, count(*) AS customer_count,
       round(avg(recency_days), 1) AS avg_recency_days, round(avg(frequency), 2) AS avg_orders,
       round(avg(monetary), 2) AS avg_ltv, round(sum(monetary), 2) AS total_ltv
FROM rfm_scored GROUP BY 1""")


# --------------------------------------------------------------- assembly
def _deps(sql: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", sql))
    return [name for name in CTES if name in words]


def with_clause(final_sql: str) -> str:
    """``WITH`` every CTE ``final_sql`` needs, dependencies first, then ``final_sql``."""
    ordered: list[str] = []

    def visit(name: str, stack: tuple[str, ...]) -> None:
        if name in ordered:
            return
        for dep in _deps(CTES[name]):
            if dep != name and dep not in stack:
                visit(dep, stack + (name,))
        ordered.append(name)

    for name in _deps(final_sql):
        visit(name, ())
    if not ordered:
        return final_sql
    body = ",\n".join(f"{name} AS (\n{CTES[name]}\n)" for name in ordered)
    return f"WITH {body}\n{final_sql}"


def model_sql(name: str) -> str:
    return with_clause(f"SELECT * FROM {name}")


# ------------------------------------------------------- data-quality checks
_SOURCE_CTE = {
    "orders": "src_orders", "customers": "src_customers", "order_items": "src_order_items",
    "products": "src_products", "sellers": "src_sellers", "order_reviews": "src_order_reviews",
    "order_payments": "src_order_payments",
    "product_category_name_translation": "src_translation",
}


def _sql_literal(v) -> str:
    return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"


def check_sql(check: "Check") -> str:
    """DuckDB SQL of one report row."""
    table = _SOURCE_CTE[check.model] if check.source else check.model
    col = check.column
    head = (f"SELECT '{check.model}' AS model, '{col}' AS column_name, '{check.kind}' AS test, "
            f"'{check.args}' AS args, '{check.severity}' AS severity, ")
    if check.kind == "not_null":
        body = f"count(*) AS failures FROM {table} WHERE {col} IS NULL"
    elif check.kind == "accepted_values":
        values = ", ".join(_sql_literal(v) for v in check.values)
        body = f"count(DISTINCT {col}) AS failures FROM {table} WHERE {col} NOT IN ({values})"
    elif check.kind == "between":
        conds = []
        if check.min_value is not None:
            conds.append(f"{col} < {check.min_value}")
        if check.max_value is not None:
            conds.append(f"{col} > {check.max_value}")
        body = f"count(*) AS failures FROM {table} WHERE {' OR '.join(conds)}"
    elif check.kind == "unique":
        body = (f"count(*) AS failures FROM (SELECT {col} FROM {table} WHERE {col} IS NOT NULL "
                f"GROUP BY {col} HAVING count(*) > 1) dup")
    elif check.kind == "relationships":
        body = (f"count(*) AS failures FROM {table} child WHERE child.{col} IS NOT NULL AND NOT "
                f"EXISTS (SELECT 1 FROM {check.to_model} parent "
                f"WHERE parent.{check.to_field} = child.{col})")
    elif check.kind == "assert_positive":
        body = f"count(*) AS failures FROM {table} WHERE {col} < 0"
    elif check.kind == "delivered_without_items":
        body = f"count(*) AS failures FROM {table} WHERE order_status = 'delivered' AND {col} = 0"
    else:
        raise ValueError(check.kind)
    return head + body


def report_sql(checks) -> str:
    """DuckDB SQL of a whole report."""
    union = "\nUNION ALL\n".join(check_sql(c) for c in checks)
    return with_clause(f"SELECT model, column_name, test, args, severity, failures, "
                       f"CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status "
                       f"FROM (\n{union}\n) checks")


def dq_oracle_sql() -> dict[str, str]:
    """One query per check kind: the report rows of its declared checks."""
    out = {}
    for kind in ("unique", "not_null", "accepted_values", "between", "relationships"):
        out[f"dq_{kind}"] = report_sql([c for c in quality.CHECKS if c.kind == kind])
    out["dq_assert_positive"] = report_sql(quality.AMOUNT_CHECKS)
    out["dq_business_rules"] = report_sql(
        [c for c in quality.CHECKS if c.kind == "delivered_without_items"])
    out["dq_delivered_without_items"] = with_clause(
        "SELECT order_id, order_status, item_count FROM fct_orders "
        "WHERE order_status = 'delivered' AND item_count = 0")
    return out
