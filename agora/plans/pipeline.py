"""The model graph: raw tables in, staging / intermediate / marts out.

``Pipeline`` builds each model once (memoized DataFrame), so every consumer of
a model shares one plan. The order-grain table feeds five consumers; in a
full build it is materialized once (checkpointed to the shared checkpoint
folder, or persisted) and released afterwards.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass, field
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from agora.plans import core, enrich, marts, rfm, staging, staging_views
from agora.session import ensure_checkpoint_dir
from agora.sources import sinks

# Layer of each model (decides its sink and schema).
LAYERS = {
    "stg_orders": "staging", "stg_customers": "staging", "stg_order_items": "staging",
    "stg_order_payments": "staging", "stg_order_reviews": "staging", "stg_products": "staging",
    "stg_sellers": "staging", "stg_geolocation": "staging",
    "stg_product_category_name_translation": "staging",
    "int_orders_enriched": "intermediate", "int_customers_enriched": "intermediate",
    "int_products_enriched": "intermediate", "int_sellers_enriched": "intermediate",
    "int_customer_order_history": "intermediate",
    "dim_customers": "core", "dim_products": "core", "dim_sellers": "core", "fct_orders": "core",
    "mart_revenue_monthly": "analytics", "mart_delivery_performance": "analytics",
    "mart_seller_health": "analytics",
}
# Tables written partitioned by month; the models read from them have no such column.
BY_MONTH = ("stg_orders", "fct_orders")
MARTS = tuple(name for name, layer in LAYERS.items() if layer in ("core", "analytics"))


@dataclass
class Pipeline:
    """All models over one set of raw tables.

    ``date_window`` optionally keeps orders purchased within [start, end]
    (inclusive) for partial loads; by default every order is kept.
    ``num_partitions`` fixes the range partitions of the global rankings
    (default: sized by the planner).
    """

    raw: dict[str, DataFrame]
    date_window: tuple[dt.date, dt.date] | None = None
    num_partitions: int | None = None
    rfm_as_of: dt.datetime | None = None
    rfm_recency_desc: bool = False
    _materialized: list[DataFrame] = field(default_factory=list, repr=False)
    timings: dict[str, float] = field(default_factory=dict, repr=False)
    built: set[str] = field(default_factory=set, repr=False)  # models read from written tables
    _orders_shared: bool = field(default=False, repr=False)
    # failures of row-level checks counted while their marts were written
    counted: dict[tuple, int] = field(default_factory=dict, repr=False)

    # ------------------------------------------------------------- staging
    @cached_property
    def stg_orders(self) -> DataFrame:
        raw = self.raw["orders"]
        if self.date_window is not None:                    # reads its months of a partitioned table
            raw = sinks.in_window(raw, "order_purchase_timestamp", *self.date_window)
        return staging.stg_orders(raw)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw["customers"])

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw["order_items"])

    @cached_property
    def stg_order_payments(self) -> DataFrame:
        return staging.stg_order_payments(self.raw["order_payments"])

    @cached_property
    def stg_order_reviews(self) -> DataFrame:
        return staging.stg_order_reviews(self.raw["order_reviews"])

    @cached_property
    def latest_review_scores(self) -> DataFrame:
        return staging.latest_review_scores(self.raw["order_reviews"])

    @cached_property
    def stg_product_category_name_translation(self) -> DataFrame:
        return staging.stg_product_category_name_translation(
            self.raw["product_category_name_translation"])

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw["products"],
                                    self.raw["product_category_name_translation"])

    @cached_property
    def stg_sellers(self) -> DataFrame:
        return staging.stg_sellers(self.raw["sellers"])

    @cached_property
    def stg_geolocation(self) -> DataFrame:
        return staging.stg_geolocation(self.raw["geolocation"])

    @cached_property
    def geo(self) -> DataFrame:
        return enrich.geo_lookup(self.stg_geolocation)

    # -------------------------------------------------------- intermediate
    @cached_property
    def int_orders_enriched(self) -> DataFrame:
        return self._order_grain(distinct_counts=True)

    def _order_grain(self, distinct_counts: bool) -> DataFrame:
        """The order grain; facts of hot orders that are stored apart are rolled up apart."""
        facts = {"items": ("order_items", staging.stg_order_items),
                 "payments": ("order_payments", staging.stg_order_payments),
                 "reviews": ("order_reviews", staging.latest_review_scores)}
        whole = {"items": lambda: self.stg_order_items, "payments": lambda: self.stg_order_payments,
                 "reviews": lambda: self.latest_review_scores}
        parts = {name: build(self.raw[f"{table}_cold"]) if f"{table}_cold" in self.raw else whole[name]()
                 for name, (table, build) in facts.items()}
        hot = {name: build(self.raw[f"{table}_hot"]) for name, (table, build) in facts.items()
               if f"{table}_hot" in self.raw}
        return enrich.int_orders_enriched(self.stg_orders, parts["items"], parts["payments"],
                                          parts["reviews"], distinct_counts, hot)

    @property
    def order_sums(self) -> DataFrame:
        """The order grain for consumers that read no distinct count: the shared table, if any."""
        if self._orders_shared:
            return self.int_orders_enriched
        return self._order_grain(distinct_counts=False)

    @cached_property
    def customer_places(self) -> DataFrame:
        return enrich.customer_locations(self.stg_customers, self.geo)

    @cached_property
    def int_customers_enriched(self) -> DataFrame:
        return enrich.int_customers_enriched(self.stg_customers, self.geo, self.order_sums)

    @cached_property
    def int_products_enriched(self) -> DataFrame:
        return enrich.int_products_enriched(self.stg_products, self.stg_order_items,
                                            self.int_orders_enriched)

    @cached_property
    def int_sellers_enriched(self) -> DataFrame:
        return enrich.int_sellers_enriched(self.stg_sellers, self.geo, self.stg_order_items,
                                           self.int_orders_enriched)

    @cached_property
    def int_customer_order_history(self) -> DataFrame:
        return enrich.int_customer_order_history(self.int_orders_enriched, self.stg_customers)

    # ---------------------------------------------------------------- core
    @cached_property
    def dim_customers(self) -> DataFrame:
        return core.dim_customers(self.int_customers_enriched)

    @cached_property
    def dim_products(self) -> DataFrame:
        return core.dim_products(self.int_products_enriched)

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return core.dim_sellers(self.int_sellers_enriched)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return core.fct_orders(self.int_orders_enriched, self.customer_places, self.stg_orders)

    # ----------------------------------------------------------- analytics
    @cached_property
    def mart_revenue_monthly(self) -> DataFrame:
        # Only the category is read from the products, and no customer column
        # from the orders: the order grain is the order fact without its
        # row-preserving customer join (customer_id is unique, a declared check).
        return marts.mart_revenue_monthly(self.stg_order_items, self.dim_products, self.order_sums)

    @cached_property
    def mart_delivery_performance(self) -> DataFrame:
        return marts.mart_delivery_performance(self.fct_orders, self.stg_order_items)

    @cached_property
    def mart_seller_health(self) -> DataFrame:
        return marts.mart_seller_health(self.dim_sellers, self.num_partitions)

    @cached_property
    def rfm_segmentation(self) -> DataFrame:
        return rfm.rfm_segmentation(self.dim_customers, self.rfm_as_of,
                                    self.rfm_recency_desc, self.num_partitions)

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)

    # -------------------------------------------------------- materialize
    def share_orders(self, how: str = "checkpoint", distinct_counts: bool = True) -> DataFrame:
        """Compute the order-grain table once for all its consumers.

        ``distinct_counts=False``, for consumers that read none, leaves them out.

        ``checkpoint`` writes it to the shared checkpoint folder and cuts the
        lineage; ``persist`` keeps it in executor memory/disk (recomputed from
        lineage if an executor is lost).
        """
        orders = self.int_orders_enriched if distinct_counts else self._order_grain(False)
        if how == "checkpoint":
            ensure_checkpoint_dir(orders.sparkSession)
            shared = orders.checkpoint(eager=True)
        else:
            shared = orders.persist(StorageLevel.MEMORY_AND_DISK)
            self._materialized.append(shared)
        self.__dict__["int_orders_enriched"] = shared
        self._orders_shared = True
        return shared

    def share(self, name: str) -> DataFrame:
        """Compute a model once, to the shared checkpoint folder, for those built on it."""
        df = self.model(name)
        ensure_checkpoint_dir(df.sparkSession)
        self.__dict__[name] = df.checkpoint(eager=True)
        return self.__dict__[name]

    def release(self) -> None:
        for df in self._materialized:
            df.unpersist()
        self._materialized.clear()

    def _forget(self) -> None:
        """Drop every model built or shared so far: the next use starts from the raw tables."""
        self.release()
        for name in (*LAYERS, "rfm_segmentation", "customer_places", "latest_review_scores", "geo"):
            self.__dict__.pop(name, None)
        self.built.clear()
        self.counted.clear()
        self._orders_shared = False

    @staticmethod
    def _path(warehouse: str | None, name: str) -> str | None:
        schema = sinks.LAYER_SCHEMAS[LAYERS[name]]
        return None if warehouse is None else f"{warehouse.rstrip('/')}/{schema}/{name}"

    def build(self, spark: SparkSession, warehouse: str | None = None,
              names: tuple[str, ...] = MARTS, share: str = "checkpoint",
              staging_tables: bool = False, check: bool = False,
              raw_database: str | None = None) -> dict[str, str]:
        """Register staging views and write the marts (full refresh from the raw tables).

        With ``warehouse`` the marts are written under ``<warehouse>/<schema>/<name>``,
        else as catalog tables ``<schema>.<name>``. Every mart is written to a
        version of its own first, and a mart written earlier in the build is read
        back from it by the marts after it (``dim_products`` by the revenue mart,
        ``fct_orders`` by the delivery mart, ``dim_sellers`` by seller health),
        which cuts their lineage at a durable table instead of recomputing it.
        After the last one is written all are published; a build that fails
        before leaves the earlier tables as they were. With ``check`` the row-level
        checks of each mart are counted on its write (``counted``), and the
        checks that follow read the marts only for keys. The order grain is
        checked for repeated order ids, which later models rely on, in any case:
        a build with one raises ``DataQualityError`` and publishes nothing.

        The staging views belong to the session, as any DataFrame's; over raw
        tables of the catalog database ``raw_database`` they are created as catalog
        views of the ``staging`` schema, which later sessions read too.
        ``staging_tables`` writes the staging models as tables instead.
        """
        self._forget()
        staged: dict[str, sinks.Staged] = {}
        if raw_database and not staging_tables:
            staging_views.create_views(spark, raw_database, sinks.LAYER_SCHEMAS["staging"])
        try:
            for name, layer in LAYERS.items():
                if layer == "staging":
                    sinks.register_view(self.model(name), name)
                    if staging_tables:
                        self._stage(spark, staged, name, warehouse)
            self._require_unique_orders(self.share_orders(share))
            for name in names:
                started = time.perf_counter()
                self._stage(spark, staged, name, warehouse, check)
                self.__dict__[name] = spark.read.parquet(staged[name].location).drop(sinks.MONTH)
                self.timings[name] = time.perf_counter() - started
        except BaseException:
            sinks.discard(spark, list(staged.values()))
            raise
        finally:
            self.release()
        written = dict(zip(staged, sinks.publish(spark, list(staged.values()))))
        for name in names:
            self._read_built(spark, name, written[name])
        return written

    @staticmethod
    def _require_unique_orders(orders: DataFrame) -> None:
        from agora.operators.quality import DataQualityError, unique

        repeated = unique(orders, "order_id").limit(1).collect()
        if repeated:
            raise DataQualityError(f"order_id {repeated[0].unique_field} is repeated in the orders")

    def _stage(self, spark: SparkSession, staged: dict[str, sinks.Staged], name: str,
               warehouse: str | None, check: bool = False) -> None:
        from agora.operators import quality

        df = self.model(name)
        counters = quality.counters(name) if check else {}
        seen = Observation()
        if counters:
            df = df.observe(seen, *[c.alias(f"c{i}") for i, c in enumerate(counters.values())])
        months = name in BY_MONTH
        staged[name] = sinks.stage_table(
            spark, sinks.by_month(df, "purchased_at") if months else df, name,
            sinks.LAYER_SCHEMAS[LAYERS[name]], self._path(warehouse, name),
            partition_by=[sinks.MONTH] if months else [])
        for i, c in enumerate(counters):
            n = int(seen.get[f"c{i}"] or 0)
            # rows outside a list say nothing of how many values they hold, unless there are none
            if n == 0 or c.kind != "accepted_values":
                self.counted[quality.key_of(c)] = n

    def _read_built(self, spark: SparkSession, name: str, location: str) -> None:
        df = sinks.read_table(spark, location)
        if name in BY_MONTH and self.date_window is not None:
            df = sinks.in_window(df, "purchased_at", *self.date_window)
        self.__dict__[name] = df.drop(sinks.MONTH)
        self.built.add(name)

    def use_built(self, spark: SparkSession, warehouse: str | None = None,
                  names: tuple[str, ...] = MARTS) -> None:
        """Read the marts from the tables an earlier build wrote (a missing one is an error)."""
        for name in names:
            schema = sinks.LAYER_SCHEMAS[LAYERS[name]]
            self._read_built(spark, name, self._path(warehouse, name) or f"`{schema}`.`{name}`")

    def check(self, spark: SparkSession, kind: str | None = None,
              store_failures: bool = False, warehouse: str | None = None,
              severity: str | dict[str, str] | None = None) -> list:
        """Run the declared data-quality checks once; optionally store failing rows.

        Returns the report rows (one per check; severity ``warn`` unless
        overridden). With ``store_failures`` the failing rows of every check
        run are written to the ``audit`` schema (or under ``warehouse``), as
        full refreshes. ``quality.raise_on_error(rows)`` fails the run on
        failing ``error`` checks.
        """
        from agora.operators import quality

        # the failing rows are whole rows of the models
        results = quality.run_checks(self, kind=kind, severity=severity,
                                     keep_shared=store_failures).collect()
        if store_failures:
            quality.store_failures(self, spark, results, warehouse)
        return results


def from_testdata(spark: SparkSession, sf_dir: str, **kwargs) -> Pipeline:
    from agora.sources.testdata import raw_tables
    return Pipeline(raw_tables(spark, sf_dir), **kwargs)

