"""Raw marketplace tables derived from the driver's star-schema test tables.

The mapping is deterministic and row-for-row the same as the SQL mapping used
by the DuckDB oracle (``agora.oracle``): every amount comes from ``floor`` of
the source values, so sums do not depend on row order. Ids stay BIGINT.
Each raw table is a narrow projection of one fact or dimension table, so the
mapping adds no shuffle except the ``distinct`` of the category list.

The key arithmetic (``%``) shapes the marketplace: it assigns statuses,
payment splits and second reviews, and gives some rows to another owner, so
that customers without or with few orders and sellers without sales exist. No
row is left out: every row of a source table is a row of its raw table (or
two, for split payments and second reviews), and the rare branches that the
whole tables do not reach are covered by hand-written rows in the tests.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _hours(n: Column) -> Column:
    return F.make_dt_interval(hours=n.cast("int"))


def _days(n: Column) -> Column:
    return F.make_dt_interval(days=n.cast("int"))


def read_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def map_orders(orders: DataFrame) -> DataFrame:
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    # some orders go to the last customer of the dozen before, which leaves
    # customers with none, one or few
    moved = (cust >= 12) & ((cust % 12 == 0) | ((cust % 12 == 1) & (k % 8 != 0))
                            | ((cust % 12 == 2) & (k % 4 != 0)))
    owner = F.when(moved, cust - cust % 12 - 1).otherwise(cust)
    closed = F.col("o_orderstatus").isin("F", "P")
    status = (F.when(closed & (k % 29 == 0), "canceled")
               .when(closed & (k % 31 == 0), "unavailable")
               .when(closed, "delivered")
               .when(k % 4 == 0, "shipped")
               .when(k % 4 == 1, "processing")
               .when(k % 4 == 2, "approved")
               .otherwise("invoiced"))
    purchase = F.col("o_orderdate") + _hours(k % 24)
    st = F.col("order_status")
    return (orders
            .select(k.alias("order_id"), owner.alias("customer_id"), status.alias("order_status"),
                    purchase.alias("p"), F.col("o_orderdate"), k.alias("k"))
            .select(
                "order_id", "customer_id", "order_status",
                F.col("p").alias("order_purchase_timestamp"),
                (F.col("p") + _hours(F.lit(1))).alias("order_approved_at"),
                F.when(st.isin("delivered", "shipped"), F.col("p") + _days(1 + F.col("k") % 4))
                 .alias("order_delivered_carrier_date"),
                F.when((st == "delivered") & (F.col("k") % 97 != 0),
                       F.col("p") + _days(4 + (F.col("k") * 7) % 30) + _hours(F.col("k") % 11))
                 .alias("order_delivered_customer_date"),
                (F.col("o_orderdate") + _days(F.lit(25))).alias("order_estimated_delivery_date")))


def map_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    ck = F.col("c_custkey")
    return (customer.join(nation, customer.c_nationkey == nation.n_nationkey, "inner")
            .select(ck.alias("customer_id"),
                    (ck - ck % 2).alias("customer_unique_id"),
                    (F.col("c_nationkey") * 100 + ck % 10).cast("int").alias("customer_zip_code_prefix"),
                    F.concat(F.lit("  "), F.col("n_name"), F.lit(" City ")).alias("customer_city"),
                    F.concat(F.lit(" st"), F.col("c_nationkey").cast("string"), F.lit(" "))
                     .alias("customer_state")))


def map_sellers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    sk = F.col("s_suppkey")
    return (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "inner")
            .select(sk.alias("seller_id"),
                    (F.col("s_nationkey") * 100 + sk % 10).cast("int").alias("seller_zip_code_prefix"),
                    F.concat(F.lit(" "), F.col("n_name"), F.lit(" Town ")).alias("seller_city"),
                    F.concat(F.lit(" st"), F.col("s_nationkey").cast("string")).alias("seller_state")))


def map_geolocation(nation: DataFrame, region: DataFrame) -> DataFrame:
    # two points for each nation and region; the regions are a handful, taken as one array
    keys = region.agg(F.collect_list("r_regionkey")).scalar()
    pts = (nation.withColumn("r_regionkey", F.explode(keys))
           .withColumn("k", F.explode(F.array(F.lit(0), F.lit(1)))))
    return pts.select(
        (F.col("n_nationkey") * 100 + F.col("r_regionkey")).cast("int").alias("geolocation_zip_code_prefix"),
        (F.col("n_nationkey").cast("double") + 0.5 + F.col("k") * 0.25).alias("geolocation_lat"),
        (F.col("r_regionkey").cast("double") - 40.25).alias("geolocation_lng"),
        F.concat(F.lit("geo "), F.col("n_name")).alias("geolocation_city"),
        F.concat(F.lit("ST"), F.col("n_nationkey").cast("string")).alias("geolocation_state"))


def map_products(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    odd_dims = pk % 40 == 1
    return part.select(
        pk.alias("product_id"),
        F.when(pk % 50 != 0, F.lower("p_type")).alias("product_category_name"),
        F.length("p_name").cast("int").alias("product_name_lenght"),
        (F.length("p_name") * 10).cast("int").alias("product_description_lenght"),
        (pk % 6).cast("int").alias("product_photos_qty"),
        F.when(~odd_dims, (F.col("p_size") * 100).cast("double")).alias("product_weight_g"),
        F.when(~odd_dims, F.col("p_size").cast("double")).alias("product_length_cm"),
        (1 + pk % 60).cast("double").alias("product_height_cm"),
        (5 + pk % 45).cast("double").alias("product_width_cm"))


def map_category_translation(part: DataFrame) -> DataFrame:
    """One category (promo) has no English name."""
    name = F.col("product_category_name")
    return (part.select(F.lower("p_type").alias("product_category_name"))
            .distinct()
            .select(name, F.when(name != "promo", F.concat(F.lit("en_"), name))
                     .alias("product_category_name_english")))


# Price divisor by l_suppkey % 5.
PRICE_DIVISORS = (100.0, 400.0, 1600.0, 6400.0, 25600.0)


def map_order_items(lineitem: DataFrame) -> DataFrame:
    sk = F.col("l_suppkey")
    divisor = F.element_at(F.array(*[F.lit(d) for d in PRICE_DIVISORS]), (sk % 5 + 1).cast("int"))
    # every 23rd seller's items are another seller's, which leaves it without sales
    seller = F.when(sk % 23 == 22, sk - 1).otherwise(sk)
    return (lineitem
            .select(F.col("l_orderkey").alias("order_id"),
                    F.col("l_linenumber").alias("order_item_id"),
                    F.col("l_partkey").alias("product_id"),
                    seller.alias("seller_id"),
                    F.col("l_shipdate").alias("shipping_limit_date"),
                    (F.floor(F.col("l_extendedprice") / divisor) + 1).cast("double").alias("price"),
                    (F.lit(5.0) + F.col("l_quantity") * 0.5).cast("double").alias("freight_value")))


# Payment type by order priority.
PRIORITY_PAYMENT = {
    "1-URGENT": "credit_card",
    "2-HIGH": "boleto",
    "3-MEDIUM": "debit_card",
    "4-NOT SPECIFIED": "voucher",
}


def map_order_payments(orders: DataFrame) -> DataFrame:
    """One payment per order, two (split 70/30, the second a voucher) when
    order key % 3 = 0. One scan: the second payment is an exploded row, not a
    second pass over orders."""
    k = F.col("o_orderkey")
    split = k % 3 == 0
    ptype = F.lit("credit_card")
    for priority, kind in reversed(list(PRIORITY_PAYMENT.items())):
        ptype = F.when(F.col("o_orderpriority") == priority, kind).otherwise(ptype)
    rows = (orders
            .withColumn("seq", F.explode(F.when(split, F.array(F.lit(1), F.lit(2)))
                                          .otherwise(F.array(F.lit(1))))))
    first = F.col("seq") == 1
    value = (F.when(~first, F.floor(F.col("o_totalprice") * 0.3))
              .when(split, F.floor(F.col("o_totalprice") * 0.7))
              .otherwise(F.floor(F.col("o_totalprice"))))
    return rows.select(
        k.alias("order_id"), F.col("seq").cast("int").alias("payment_sequential"),
        F.when(first, ptype).otherwise(F.lit("voucher")).alias("payment_type"),
        F.when(first, 1 + k % 10).otherwise(F.lit(1)).cast("int").alias("payment_installments"),
        value.cast("double").alias("payment_value"))


def map_order_reviews(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    rows = (orders
            .withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
            .where((F.col("k") == 0) | (k % 20 == 0)))
    return rows.select(
        (k * 10 + F.col("k")).alias("review_id"),
        k.alias("order_id"),
        (1 + (k * 3 + F.col("k")) % 5).cast("int").alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.lit(None).cast("string").alias("review_comment_message"),
        (F.col("o_orderdate") + _days(30 + F.col("k"))).alias("review_creation_date"),
        (F.col("o_orderdate") + _days(31 + F.col("k"))).alias("review_answer_timestamp"))


# raw table -> (mapping function, source tables it reads)
MAPPINGS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "orders": (map_orders, ("orders",)),
    "customers": (map_customers, ("customer", "nation")),
    "order_items": (map_order_items, ("lineitem",)),
    "order_payments": (map_order_payments, ("orders",)),
    "order_reviews": (map_order_reviews, ("orders",)),
    "products": (map_products, ("part",)),
    "sellers": (map_sellers, ("supplier", "nation")),
    "product_category_name_translation": (map_category_translation, ("part",)),
    "geolocation": (map_geolocation, ("nation", "region")),
}


class RawTables(Mapping[str, DataFrame]):
    """The nine raw tables, each mapped on first use (unused ones cost nothing)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._sources: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}

    def _source(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = read_source(self._spark, self._dir, name)
        return self._sources[name]

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._tables:
            build, sources = MAPPINGS[table]
            self._tables[table] = build(*[self._source(s) for s in sources])
        return self._tables[table]

    def __iter__(self) -> Iterator[str]:
        return iter(MAPPINGS)

    def __len__(self) -> int:
        return len(MAPPINGS)


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    """The nine raw marketplace tables over the test tables in ``sf_dir``."""
    return RawTables(spark, sf_dir)
