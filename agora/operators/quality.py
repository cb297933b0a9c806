"""Data-quality checks: each check's violations as a DataFrame, and a report.

Check kinds and what counts as a failure (one row of the failing-rows query):

* ``unique``: each non-null key value present more than once;
* ``not_null``: each NULL row;
* ``accepted_values``: each distinct non-null value outside the list;
* ``between``: each row outside ``[min, max]`` (either end optional; NULL passes);
* ``relationships``: each non-null child row whose key is missing in the parent;
* ``assert_positive``: each row with a negative value (zero passes);
* ``delivered_without_items``: each delivered order whose item count is zero.

The report reads every table once for all its row-level checks (only the
violations are exploded and counted; rows that pass are never copied), once
per unique key (a grouped count), and once per relationship (the child's
distinct keys with their counts, anti-joined to the parent's). Row-level checks
of a mart can also be counted while it is written (:func:`counters`,
``Pipeline.build(check=True)``); the report then takes those counts and reads
the mart for them no more.

Stored failures are written in one pass per table: every row is fanned out to
(check, value) once, tagged with the check, for all checks of the table, and
the table's failures are one write partitioned by check (:func:`failures`).
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.plans.core import DISTINCT_COUNTS

ROW_LEVEL = ("not_null", "accepted_values", "between", "assert_positive",
             "delivered_without_items")


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None
    to_model: str | None = None
    to_field: str | None = None
    severity: str = "warn"
    source: bool = False  # a raw table rather than a model

    @property
    def args(self) -> str:
        if self.kind == "accepted_values":
            return "values=" + ",".join(str(v) for v in self.values)
        if self.kind == "between":
            lo = "" if self.min_value is None else _num(self.min_value)
            hi = "" if self.max_value is None else _num(self.max_value)
            return f"min={lo};max={hi}"
        if self.kind == "relationships":
            return f"to={self.to_model}.{self.to_field}"
        return ""


def _num(v: float) -> str:
    return str(int(v)) if float(v).is_integer() else str(v)


# ------------------------------------------------------------ declared checks
def _checks() -> list[Check]:
    # The declared tests (table, column, kind, arguments).
    status = ("approved", "canceled", "delivered", "invoiced", "processing", "shipped",
              "unavailable")
    scores = (1, 2, 3, 4, 5)
    raw_payment_types = ("boleto", "credit_card", "debit_card", "not_defined", "voucher")
    mart_payment_types = ("credit_card", "boleto", "voucher", "debit_card")
    c: list[Check] = []

    def add(model, column, *kinds, source=False, **kw):
        for kind in kinds:
            c.append(Check(model, column, kind, source=source, **kw))

    # sources
    add("orders", "order_id", "unique", "not_null", source=True)
    add("orders", "customer_id", "not_null", source=True)
    add("orders", "order_status", "accepted_values", source=True, values=status)
    add("orders", "order_purchase_timestamp", "not_null", source=True)
    add("customers", "customer_id", "unique", "not_null", source=True)
    add("order_items", "order_id", "not_null", source=True)
    add("order_items", "product_id", "not_null", source=True)
    add("order_items", "seller_id", "not_null", source=True)
    add("order_items", "price", "not_null", source=True)
    add("order_items", "price", "between", source=True, min_value=0)
    add("order_items", "freight_value", "not_null", source=True)
    add("products", "product_id", "unique", "not_null", source=True)
    add("sellers", "seller_id", "unique", "not_null", source=True)
    add("order_reviews", "review_id", "not_null", source=True)
    add("order_reviews", "order_id", "not_null", source=True)
    add("order_reviews", "review_score", "accepted_values", source=True, values=scores)
    add("order_payments", "order_id", "not_null", source=True)
    add("order_payments", "payment_type", "accepted_values", source=True, values=raw_payment_types)
    add("order_payments", "payment_value", "not_null", source=True)
    add("product_category_name_translation", "product_category_name", "unique", "not_null",
        source=True)
    add("product_category_name_translation", "product_category_name_english", "not_null",
        source=True)
    # staging
    add("stg_orders", "order_id", "unique", "not_null")
    add("stg_orders", "customer_id", "not_null")
    add("stg_orders", "order_status", "not_null")
    add("stg_orders", "purchased_at", "not_null")
    add("stg_customers", "customer_id", "unique", "not_null")
    add("stg_customers", "customer_unique_id", "not_null")
    for col in ("order_id", "product_id", "seller_id", "item_price"):
        add("stg_order_items", col, "not_null")
    add("stg_products", "product_id", "unique", "not_null")
    add("stg_sellers", "seller_id", "unique", "not_null")
    add("stg_order_reviews", "review_id", "not_null")
    add("stg_order_reviews", "order_id", "not_null")
    add("stg_order_reviews", "review_score", "accepted_values", values=scores)
    add("stg_order_payments", "order_id", "not_null")
    add("stg_order_payments", "payment_type", "not_null")
    # core marts
    add("dim_customers", "customer_id", "unique", "not_null")
    for col in ("customer_unique_id", "state", "city"):
        add("dim_customers", col, "not_null")
    add("dim_customers", "customer_segment", "accepted_values",
        values=("no_orders", "one_time", "occasional", "loyal"))
    add("dim_customers", "is_repeat_buyer", "not_null")
    add("dim_customers", "ltv_bucket", "accepted_values",
        values=("no_spend", "low", "mid", "high", "vip"))
    add("dim_customers", "lifetime_gmv", "between", min_value=0)
    add("dim_customers", "avg_order_value", "between", min_value=0)
    add("dim_customers", "late_order_rate", "between", min_value=0, max_value=1)
    add("dim_customers", "total_orders", "between", min_value=0)
    add("dim_sellers", "seller_id", "unique", "not_null")
    add("dim_sellers", "state", "not_null")
    add("dim_sellers", "seller_tier", "accepted_values",
        values=("inactive", "small", "mid", "large"))
    add("dim_sellers", "quality_tier", "accepted_values",
        values=("excellent", "good", "average", "poor", "unrated"))
    add("dim_sellers", "is_risk_seller", "not_null")
    add("dim_sellers", "total_revenue", "between", min_value=0)
    add("dim_sellers", "late_delivery_rate", "between", min_value=0, max_value=1)
    add("dim_sellers", "avg_review_score", "between", min_value=1, max_value=5)
    add("dim_sellers", "one_star_rate", "between", min_value=0, max_value=1)
    add("dim_products", "product_id", "unique", "not_null")
    add("dim_products", "product_volume_cm3", "between", min_value=0)
    add("dim_products", "size_bucket", "accepted_values",
        values=("unknown", "tiny", "small", "medium", "large"))
    add("dim_products", "avg_review_score", "between", min_value=1, max_value=5)
    add("dim_products", "one_star_rate", "between", min_value=0, max_value=1)
    add("fct_orders", "order_id", "unique", "not_null")
    add("fct_orders", "customer_id", "not_null")
    add("fct_orders", "customer_id", "relationships", to_model="dim_customers",
        to_field="customer_id")
    add("fct_orders", "customer_state", "not_null")
    add("fct_orders", "order_status", "not_null")
    add("fct_orders", "order_status", "accepted_values", values=status)
    for col in ("gross_order_value", "items_revenue", "freight_revenue", "total_payment_value"):
        add("fct_orders", col, "between", min_value=0)
    add("fct_orders", "primary_payment_type", "accepted_values", values=mart_payment_types)
    add("fct_orders", "review_score", "between", min_value=1, max_value=5)
    add("fct_orders", "review_sentiment", "accepted_values",
        values=("positive", "neutral", "negative"))
    add("fct_orders", "item_count", "delivered_without_items")
    # analytics marts
    for col in ("order_month", "order_quarter", "category_name_english"):
        add("mart_revenue_monthly", col, "not_null")
    add("mart_revenue_monthly", "primary_payment_type", "accepted_values",
        values=mart_payment_types)
    add("mart_revenue_monthly", "order_count", "between", min_value=1)
    for col in ("gross_order_value", "items_revenue", "freight_revenue", "avg_order_value"):
        add("mart_revenue_monthly", col, "between", min_value=0)
    add("mart_delivery_performance", "customer_state", "not_null")
    add("mart_delivery_performance", "seller_id", "not_null")
    add("mart_delivery_performance", "seller_id", "relationships", to_model="dim_sellers",
        to_field="seller_id")
    add("mart_delivery_performance", "delivered_orders", "between", min_value=1)
    add("mart_delivery_performance", "late_delivery_rate", "between", min_value=0, max_value=1)
    add("mart_delivery_performance", "avg_review_score", "between", min_value=1, max_value=5)
    add("mart_seller_health", "seller_id", "unique", "not_null")
    add("mart_seller_health", "seller_tier", "accepted_values",
        values=("inactive", "small", "mid", "large"))
    add("mart_seller_health", "quality_tier", "accepted_values",
        values=("excellent", "good", "average", "poor", "unrated"))
    add("mart_seller_health", "is_risk_seller", "not_null")
    add("mart_seller_health", "is_top_10_seller", "not_null")
    add("mart_seller_health", "revenue_rank", "between", min_value=1)
    add("mart_seller_health", "revenue_decile", "between", min_value=1, max_value=10)
    add("mart_seller_health", "total_revenue", "between", min_value=0)
    add("mart_seller_health", "late_delivery_rate", "between", min_value=0, max_value=1)
    add("mart_seller_health", "pct_sellers_in_state", "between", min_value=0, max_value=100)
    return c


CHECKS: tuple[Check, ...] = tuple(_checks())

# The sign check over the item amounts (a generic test; no model declares it).
AMOUNT_CHECKS: tuple[Check, ...] = tuple(
    Check("stg_order_items", column, "assert_positive")
    for column in ("item_price", "freight_value", "total_item_value"))


# ---------------------------------------------------------- violation frames
def _violation(check: Check) -> Column:
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(*check.values)
    if check.kind == "between":
        cond = F.lit(False)
        if check.min_value is not None:
            cond = cond | (c < F.lit(check.min_value))
        if check.max_value is not None:
            cond = cond | (c > F.lit(check.max_value))
        return c.isNotNull() & cond
    if check.kind == "assert_positive":
        return c.isNotNull() & (c < 0)
    if check.kind == "delivered_without_items":
        return F.coalesce((F.col("order_status") == "delivered") & (c == 0), F.lit(False))
    raise ValueError(check.kind)


def unique(df: DataFrame, column: str) -> DataFrame:
    """Key values present more than once: (unique_field, n_records)."""
    return (df.where(F.col(column).isNotNull())
              .groupBy(F.col(column).alias("unique_field"))
              .agg(F.count(F.lit(1)).alias("n_records"))
              .where(F.col("n_records") > 1))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Values outside the list: (value_field, n_records); NULL passes."""
    check = Check("", column, "accepted_values", values=tuple(values))
    return (df.where(_violation(check))
              .groupBy(F.col(column).alias("value_field"))
              .agg(F.count(F.lit(1)).alias("n_records")))


def between(df: DataFrame, column: str, min_value=None, max_value=None) -> DataFrame:
    return df.where(_violation(Check("", column, "between", min_value=min_value,
                                     max_value=max_value)))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    keys = parent.select(F.col(field).alias("_parent_key")).distinct()
    return (child.where(F.col(column).isNotNull())
                 .join(keys, F.col(column) == F.col("_parent_key"), "left_anti"))


def assert_positive(df: DataFrame, column: str) -> DataFrame:
    """Rows with a negative value (zero passes)."""
    return df.where(_violation(Check("", column, "assert_positive")))


def delivered_without_items(fct: DataFrame) -> DataFrame:
    """Delivered orders that have no line item."""
    return (fct.where(_violation(Check("", "item_count", "delivered_without_items")))
               .select("order_id", "order_status", "item_count"))


def violations(check: Check, resolve: Callable[[Check, str], DataFrame]) -> DataFrame:
    """The failing rows of one check (what a stored-failures table holds)."""
    df = resolve(check, check.model)
    if check.kind == "unique":
        return unique(df, check.column)
    if check.kind == "accepted_values":
        return accepted_values(df, check.column, check.values)
    if check.kind == "relationships":
        return relationships(df, check.column, resolve(check, check.to_model), check.to_field)
    return df.where(_violation(check))


# ---------------------------------------------------------------- the report
REPORT_COLUMNS = ("model", "column_name", "test", "args", "severity", "failures", "status")


def _report_row(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.model).alias("model"), F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("test"), F.lit(check.args).alias("args"),
        F.lit(check.severity).alias("severity"), failures.cast("bigint").alias("failures"))


def _finish(rows: DataFrame) -> DataFrame:
    return rows.select(
        *REPORT_COLUMNS[:-1],
        F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity")).alias("status"))


def _row_level(df: DataFrame, group: Sequence[Check]) -> DataFrame:
    """Report rows of one table's row-level checks: one scan, violations only."""
    found = F.array(*[F.when(_violation(check), F.struct(
        F.lit(i).alias("i"),
        # a value outside its list is one failure however often it occurs
        (F.col(check.column).cast("string") if check.kind == "accepted_values"
         else F.lit(None).cast("string")).alias("value"))) for i, check in enumerate(group)])
    each = (df.select(F.explode(F.filter(found, lambda x: x.isNotNull())).alias("x"))
            .groupBy("x.i", "x.value").agg(F.count(F.lit(1)).alias("n")))
    listed = [i for i, check in enumerate(group) if check.kind == "accepted_values"]
    per_check = each.groupBy("i").agg(
        F.sum(F.when(F.col("i").isin(listed), 1).otherwise(F.col("n"))).alias("n"))
    # one row per check of this table, also for those without a violation
    counts = per_check.agg(F.map_from_entries(F.collect_list(F.struct("i", "n"))).alias("m"))
    rows = F.array(*[_report_row(check, F.coalesce(F.col("m")[i], F.lit(0)))
                     for i, check in enumerate(group)])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def _orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """One row ``n``: child rows without a parent, from the child's keys and their counts."""
    keys = (child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key"))
            .agg(F.count(F.lit(1)).alias("n")))
    parents = parent.select(F.col(field).alias("_key")).distinct()
    return keys.join(parents, "_key", "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


CheckKey = tuple[str, str, str, str]


def key_of(check) -> CheckKey:
    """Identity of a check (or of its report row)."""
    if isinstance(check, Check):
        return check.model, check.column, check.kind, check.args
    return check.model, check.column_name, check.test, check.args


def counters(model: str) -> dict[Check, Column]:
    """Aggregates that count the violating rows of a model's row-level checks, to be observed
    on its write."""
    return {c: F.sum(F.when(_violation(c), 1).otherwise(0)) for c in CHECKS
            if c.model == model and not c.source and c.kind in ROW_LEVEL}


def report(checks: Sequence[Check], resolve: Callable[[Check, str], DataFrame],
           known: Mapping[CheckKey, int] | None = None) -> DataFrame:
    """One row per check: model, column, test, args, severity, failures, status.

    ``known`` holds failures counted before (while the tables were written).
    """
    parts: list[DataFrame] = []
    by_model: dict[tuple[str, bool], list[Check]] = {}
    known = {} if known is None else known
    counted = [c for c in checks if key_of(c) in known]
    if counted:
        spark = SparkSession.active()
        parts.append(spark.createDataFrame(
            [(c.model, c.column, c.kind, c.args, c.severity, known[key_of(c)]) for c in counted],
            "model string, column_name string, test string, args string, severity string, failures long"))
    checks = [c for c in checks if key_of(c) not in known]
    for check in checks:
        if check.kind in ROW_LEVEL:
            by_model.setdefault((check.model, check.source), []).append(check)
    for group in by_model.values():
        parts.append(_row_level(resolve(group[0], group[0].model), group))
    for check in checks:
        if check.kind == "unique":
            failing = violations(check, resolve).agg(F.count(F.lit(1)).alias("n"))
        elif check.kind == "relationships":
            failing = _orphans(resolve(check, check.model), check.column,
                               resolve(check, check.to_model), check.to_field)
        else:
            continue
        parts.append(failing.select(_report_row(check, F.col("n")).alias("r")).select("r.*"))
    if not parts:
        raise ValueError("no checks selected")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return _finish(out)


def pipeline_resolver(pipeline) -> Callable[[Check, str], DataFrame]:
    def resolve(check: Check, name: str) -> DataFrame:
        if check.source and name == check.model:
            return pipeline.raw[name]
        return pipeline.model(name)
    return resolve


ORDER_GRAIN_CONSUMERS = ("dim_customers", "dim_products", "dim_sellers", "fct_orders",
                         "mart_revenue_monthly", "mart_delivery_performance",
                         "mart_seller_health")
SELLER_MODELS = {"dim_sellers", "mart_seller_health"}      # the second is built on the first


def select_checks(kind: str | None = None, models: Sequence[str] | None = None,
                  severity: str | Mapping[str, str] | None = None) -> list[Check]:
    """The declared checks of one kind and/or some models, with their severity.

    ``severity`` overrides the default ``warn``: one value for every check, or
    a mapping from model name to severity (e.g. ``error`` for the marts).
    """
    chosen = [c for c in CHECKS
              if (kind is None or c.kind == kind) and (models is None or c.model in models)]
    if severity is not None:
        chosen = [replace(c, severity=severity if isinstance(severity, str)
                          else severity.get(c.model, c.severity)) for c in chosen]
    return chosen


def run_checks(pipeline, kind: str | None = None, models: Sequence[str] | None = None,
               share_orders: bool = True, severity: str | Mapping[str, str] | None = None,
               keep_shared: bool = False) -> DataFrame:
    """Report over the declared checks (optionally one kind / some models).

    When several checked models read the order-grain table and are not built
    tables, it is first checkpointed once (``share_orders``) so the report's
    branches read it instead of each recomputing it, without the distinct counts
    where no check reads them; so are the sellers where the mart built on them is
    checked too. Both are the report's own, unless ``keep_shared`` leaves the whole
    order grain with the pipeline.
    """
    chosen = select_checks(kind, models, severity)
    consumers = {c.model for c in chosen if c.model in ORDER_GRAIN_CONSUMERS
                 and c.model not in pipeline.built}
    if share_orders and len(consumers) > 1 and "int_orders_enriched" not in pipeline.__dict__:
        counts = keep_shared or any(c.column in DISTINCT_COUNTS for c in chosen)
        pipeline = pipeline if keep_shared else copy.copy(pipeline)
        pipeline.share_orders("checkpoint", counts)
    if share_orders and SELLER_MODELS <= consumers and "dim_sellers" not in pipeline.__dict__:
        pipeline = pipeline if keep_shared else copy.copy(pipeline)
        pipeline.share("dim_sellers")
    return report(chosen, pipeline_resolver(pipeline), pipeline.counted)


class DataQualityError(Exception):
    """Raised when a check of severity ``error`` has failures."""


def raise_on_error(results: Sequence) -> Sequence:
    """Fail when any ``error``-severity check in the report rows failed; return them otherwise."""
    failed = [r for r in results if r.severity == "error" and r.failures > 0]
    if failed:
        lines = ", ".join(f"{r.test}({r.model}.{r.column_name})={r.failures}" for r in failed)
        raise DataQualityError(f"{len(failed)} failing checks: {lines}")
    return results


FAILURE_COLUMNS = "model string, check string, row string, value string, n_records long"


def check_name(check: Check) -> str:
    """Folder-safe name of a check within its model."""
    return f"{check.kind}_{check.column}"


def failures(checks: Sequence[Check], df: DataFrame,
             parent: Callable[[Check], DataFrame]) -> DataFrame:
    """Failing rows of all ``checks`` of one table, from one scan of it.

    (model, check, row, value, n_records): a row-level failure is the ``row`` as
    JSON with the ``value`` of the checked column; a value outside its list, a
    repeated key and a key without a parent are the value and its number of rows.
    Passing rows are fanned out only where a check needs every key (unique,
    relationships), as (check, key), combined map-side.
    """
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    nothing = F.lit(None).cast("string")
    tags = []
    for i, c in enumerate(checks):
        value = F.col(c.column).cast("string")
        grouped = c.kind in ("unique", "relationships", "accepted_values")
        found = F.col(c.column).isNotNull() if c.kind in ("unique", "relationships") else _violation(c)
        tags.append(F.when(found, F.struct(
            F.lit(i).alias("i"), (nothing if grouped else whole).alias("row"), value.alias("value"))))
    fan = df.select(F.explode(F.filter(F.array(*tags), lambda x: x.isNotNull())).alias("x")).select("x.*")
    counted = fan.groupBy("i", "row", "value").agg(F.count(F.lit(1)).alias("n_records"))
    unique_ids = [i for i, c in enumerate(checks) if c.kind == "unique"]
    found = counted.where(~F.col("i").isin(unique_ids) | (F.col("n_records") > 1))
    related = [(i, c) for i, c in enumerate(checks) if c.kind == "relationships"]
    if related:
        keys = None
        for i, c in related:
            each = parent(c).select(F.lit(i).alias("i"), F.col(c.to_field).cast("string").alias("value"))
            keys = each if keys is None else keys.unionByName(each)
        found = found.join(keys.distinct(), ["i", "value"], "left_anti")
    names = F.array(*[F.lit(check_name(c)) for c in checks])
    return found.select(F.lit(checks[0].model).alias("model"), F.element_at(names, F.col("i") + 1).alias("check"),
                        "row", "value", "n_records")


def store_failures(pipeline, spark: SparkSession, results: Sequence, warehouse: str | None = None,
                   schema: str | None = None) -> dict[str, str]:
    """Write the failing rows of every check in ``results`` (collected report rows).

    One table per checked table, written in one pass and partitioned by check. A
    full refresh: a run in which everything passes leaves an empty table, so no
    failures of an earlier run stay behind. Returns its place by table.
    """
    from agora.sources.sinks import FAILURES_SCHEMA, publish, stage_table

    schema = schema or FAILURES_SCHEMA
    resolve = pipeline_resolver(pipeline)
    counts = {key_of(r): r.failures for r in results}
    by_table: dict[tuple[str, bool], list[Check]] = {}
    for check in CHECKS:
        if key_of(check) in counts:
            by_table.setdefault((check.model, check.source), []).append(check)
    staged = {}
    for (model, source), checks in by_table.items():
        name = f"{'source_' if source else ''}{model}_failures"
        path = None if warehouse is None else f"{warehouse.rstrip('/')}/{schema}/{name}"
        failing = [c for c in checks if counts[key_of(c)]]
        found = (failures(failing, resolve(failing[0], model), lambda c: resolve(c, c.to_model))
                 if failing else spark.createDataFrame([], FAILURE_COLUMNS))
        # at most one file per check and task of the few failing rows
        staged[name] = stage_table(spark, found.select("model", "row", "value", "n_records", "check"),
                                   name, schema, path, partition_by=["check"] if failing else [])
    return dict(zip(staged, publish(spark, list(staged.values()))))
