import pytest
from pyspark.sql import functions as F

from agora.operators import quality as dq
from agora.plans import marts, questions
from tests.conftest import rows, ts


def test_revenue_monthly(shop):
    out = shop.mart_revenue_monthly
    got = rows(out, "order_month", "order_quarter", "category_name_english",
               "primary_payment_type", "order_count", "gross_order_value", "avg_order_value")
    assert got == [
        (ts("2018-03-01"), ts("2018-01-01"), "bed", "credit_card", 1, 220.0, 220.0),
        (ts("2018-03-01"), ts("2018-01-01"), "unknown", "boleto", 1, 55.0, 55.0),
        (ts("2018-05-01"), ts("2018-04-01"), "unknown", "debit_card", 1, 0.0, 0.0),
    ]  # the canceled order is left out


def test_revenue_counts_an_order_once_per_category(spark):
    items = spark.createDataFrame(
        [("o1", "p1", 10.0, 1.0), ("o1", "p2", 20.0, 2.0), ("o1", "p3", 5.0, 0.5),
         ("o2", "p1", 7.0, 0.0)],
        "order_id string, product_id string, item_price double, freight_value double")
    products = spark.createDataFrame([("p1", "a"), ("p2", "b"), ("p3", None)],
                                     "product_id string, category_name_english string")
    orders = spark.createDataFrame(
        [("o1", "delivered", ts("2018-01-05 00:00:00"), ts("2018-01-01"), "boleto"),
         ("o2", "invoiced", ts("2018-01-05 00:00:00"), ts("2018-01-01"), "boleto")],
        "order_id string, order_status string, purchased_at timestamp_ntz, "
        "order_month timestamp_ntz, primary_payment_type string")
    out = marts.mart_revenue_monthly(items, products, orders)
    assert rows(out, "category_name_english", "order_count", "gross_order_value") == [
        ("a", 1, 11.0), ("b", 1, 22.0), ("unknown", 1, 5.5)]


def test_delivery_performance(shop):
    out = shop.mart_delivery_performance
    got = rows(out, "customer_state", "seller_id", "delivered_orders", "on_time_orders",
               "late_orders", "late_delivery_rate", "avg_days_late", "avg_review_score",
               "avg_review_score_when_on_time", "positive_reviews", "negative_reviews",
               "active_months")
    assert got == [("GG", "s1", 1, 0, 1, 1.0, 2.0, 1.0, None, 0, 1, 1),
                   ("GG", "s2", 1, 1, 0, 0.0, -2.0, 5.0, 5.0, 1, 0, 1)]


def test_seller_health_on_shop(shop):
    out = shop.mart_seller_health
    got = rows(out, "seller_id", "revenue_rank", "review_rank", "revenue_decile",
               "sellers_in_state")
    # s3 has no orders: not ranked, but counted in its state's share
    assert got == [("s1", 1, 2, 1, 1), ("s2", 2, 1, 2, 2)]
    share = questions.seller_concentration(shop.dim_sellers)
    assert share.agg(F.sum("pct_of_all_sellers")).first()[0] == pytest.approx(100.0)


def test_questions_run(shop):
    on_time = questions.on_time_share(shop.mart_delivery_performance).first()
    assert (on_time.delivered_orders, on_time.late_orders, on_time.pct_late) == (2, 1, 50.0)
    aov = rows(questions.aov_by_payment_type(shop.fct_orders), "primary_payment_type", "orders")
    assert aov == [("boleto", 1), ("credit_card", 1), ("debit_card", 1)]
    assert questions.top_sellers(shop.mart_seller_health, 1).count() == 1
    cohorts = rows(questions.purchase_cohorts(shop.int_customer_order_history))
    assert cohorts == [(ts("2018-03-01"), 1, 3, 275.0, 1)]


# ------------------------------------------------------------------ checks
@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [(1, "a", 0.5, -1), (1, "b", None, 0), (2, "zz", 2.0, 3), (None, "zz", -0.1, None),
         (3, None, 1.0, 5)],
        "k int, s string, x double, n int")


def test_unique_counts_duplicated_values(table):
    assert rows(dq.unique(table, "k")) == [(1, 2)]


def test_not_null_accepted_between(table):
    assert dq.not_null(table, "k").count() == 1
    # NULL passes; each bad value once
    assert rows(dq.accepted_values(table, "s", ["a", "b"])) == [("zz", 2)]
    assert dq.between(table, "x", 0, 1).count() == 2          # 2.0 and -0.1; NULL passes
    assert dq.between(table, "x", min_value=0).count() == 1
    assert dq.assert_positive(table, "n").count() == 1         # zero passes


def test_relationships_null_child_passes(spark, table):
    parent = spark.createDataFrame([(1,), (3,)], "k int")
    assert rows(dq.relationships(table, "k", parent, "k"), "k") == [(2,)]


def test_report_one_pass_per_table(spark, table):
    checks = [dq.Check("t", "k", "unique"), dq.Check("t", "k", "not_null"),
              dq.Check("t", "s", "accepted_values", values=("a", "b")),
              dq.Check("t", "x", "between", min_value=0, max_value=1),
              dq.Check("t", "n", "assert_positive"),
              dq.Check("t", "k", "relationships", to_model="p", to_field="k")]
    parent = spark.createDataFrame([(1,), (3,)], "k int")
    report = dq.report(checks, lambda check, name: parent if name == "p" else table)
    got = {(r.column_name, r.test): (r.failures, r.status) for r in report.collect()}
    assert got == {("k", "unique"): (1, "warn"), ("k", "not_null"): (1, "warn"),
                   ("s", "accepted_values"): (1, "warn"), ("x", "between"): (2, "warn"),
                   ("n", "assert_positive"): (1, "warn"), ("k", "relationships"): (1, "warn")}


def test_declared_checks_inventory():
    kinds = {}
    for c in dq.CHECKS:
        kinds[c.kind] = kinds.get(c.kind, 0) + 1
    assert len(dq.CHECKS) == 116
    assert kinds == {"unique": 14, "not_null": 54, "accepted_values": 15, "between": 30,
                     "relationships": 2, "delivered_without_items": 1}


def test_declared_checks_on_shop(shop):
    report = dq.run_checks(shop)
    failing = {(r.model, r.column_name, r.test) for r in report.where("failures > 0").collect()}
    # the shop has a delivered-order rate above 1 (seller s1) and a NULL payment type
    assert ("dim_sellers", "one_star_rate", "between") in failing
    assert ("mart_seller_health", "seller_id", "unique") not in failing
    assert dq.delivered_without_items(shop.fct_orders).count() == 0


def test_failures_are_refreshed_also_on_pass(spark, tmp_path):
    import json

    from agora.plans.pipeline import Pipeline
    from agora.sources.sinks import read_table
    from tests.fixtures import raw, shop_pipeline

    where = str(tmp_path)
    name = f"{where}/audit/dim_sellers_failures"
    pipe = shop_pipeline(spark)
    results = pipe.check(spark, kind="between", store_failures=True, warehouse=where)
    assert {r.test for r in results} == {"between"} and len(results) == 30
    stored = read_table(spark, name).where("check = 'between_one_star_rate'").collect()
    assert [(json.loads(r.row)["seller_id"], r.value, r.n_records) for r in stored] == [("s1", "2.0", 1)]
    tables = dict(pipe.raw)
    tables["order_reviews"] = raw(spark, "order_reviews", [])
    Pipeline(tables).check(spark, kind="between", store_failures=True, warehouse=where)
    assert read_table(spark, name).where("check = 'between_one_star_rate'").count() == 0


def test_failures_of_all_checks_from_one_scan(spark, table):
    parent = spark.createDataFrame([(1,), (3,)], "k int")
    checks = [dq.Check("t", "k", "unique"), dq.Check("t", "k", "not_null"),
              dq.Check("t", "s", "accepted_values", values=("a", "b")),
              dq.Check("t", "x", "between", min_value=0, max_value=1),
              dq.Check("t", "n", "assert_positive"),
              dq.Check("t", "k", "relationships", to_model="p", to_field="k")]
    found = dq.failures(checks, table, lambda c: parent)
    got = {tuple(r) for r in found.select("check", "value", "n_records").collect()}
    assert got == {("accepted_values_s", "zz", 2), ("assert_positive_n", "-1", 1), ("between_x", "-0.1", 1),
                   ("between_x", "2.0", 1), ("relationships_k", "2", 1), ("unique_k", "1", 2),
                   ("not_null_k", None, 1)}
    table.write.mode("overwrite").saveAsTable("scan_once")
    plan = dq.failures(checks, spark.table("scan_once"), lambda c: parent)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.split("Initial Plan")[-1].count("FileScan") == 1
    # the report counts the same failures
    report = dq.report(checks, lambda check, name: parent if name == "p" else table)
    by_check = {f"{r.test}_{r.column_name}": r.failures for r in report.collect()}
    stored = found.groupBy("check").agg(F.count("*").alias("n"), F.sum("n_records").alias("r"))
    for r in stored.collect():
        assert by_check[r.check] == (r.r if r.check.startswith("relationships") else r.n)


def test_checks_counted_on_the_write_need_no_scan(spark, tmp_path):
    from agora.plans.pipeline import Pipeline
    from tests.fixtures import shop_pipeline

    pipe = shop_pipeline(spark)
    pipe.build(spark, warehouse=str(tmp_path), check=True)
    again = Pipeline(dict(pipe.raw))
    again.use_built(spark, warehouse=str(tmp_path))
    key = lambda rs: sorted(tuple(r) for r in rs)
    assert key(pipe.check(spark)) == key(again.check(spark))
    between = [c for c in dq.CHECKS if c.kind == "between" and not c.source]
    marts_only = [c for c in between if dq.key_of(c) in pipe.counted]
    assert len(marts_only) > 20
    plan = dq.report(marts_only, dq.pipeline_resolver(pipe), pipe.counted)
    assert "FileScan" not in plan._jdf.queryExecution().executedPlan().toString()


def test_build_stops_at_a_repeated_order(spark, tmp_path):
    from agora.plans.pipeline import Pipeline
    from tests.fixtures import shop_pipeline

    tables = dict(shop_pipeline(spark).raw)
    tables["orders"] = tables["orders"].union(tables["orders"].where("order_id = 'o1'"))
    with pytest.raises(dq.DataQualityError, match="o1"):
        Pipeline(tables).build(spark, warehouse=str(tmp_path), names=("fct_orders",))
    assert not (tmp_path / "core").exists() or not list((tmp_path / "core" / "fct_orders").glob("_current"))


def test_checks_on_built_tables(spark, tmp_path):
    from agora.plans.pipeline import Pipeline
    from tests.fixtures import shop_pipeline

    pipe = shop_pipeline(spark)
    written = pipe.build(spark, warehouse=str(tmp_path))
    bad = spark.read.parquet(written["fct_orders"]).withColumn("item_count", F.lit(0).cast("bigint"))
    rows_in = bad.collect()
    spark.createDataFrame(rows_in, bad.schema).write.mode("overwrite").parquet(written["fct_orders"])
    again = Pipeline(dict(pipe.raw))
    again.use_built(spark, warehouse=str(tmp_path))
    found = {r.test: r.failures for r in again.check(spark, kind="delivered_without_items")}
    assert found == {"delivered_without_items": 2}     # the written rows, not a rebuild


def test_row_level_checks_expand_nothing(spark, table):
    checks = [dq.Check("t", c, "accepted_values", values=v)
              for c, v in (("k", (1, 2)), ("s", ("a",)), ("n", (0, 3)))]
    report = dq.report(checks, lambda check, name: table)
    assert "Expand" not in report._jdf.queryExecution().executedPlan().toString()
    assert {r.column_name: r.failures for r in report.collect()} == {"k": 1, "s": 2, "n": 2}


def test_severity_override_and_raise(shop):
    results = dq.run_checks(shop, kind="between", severity={
        "dim_sellers": "error", "mart_seller_health": "error"}).collect()
    sev = {(r.model, r.column_name): (r.severity, r.status) for r in results}
    assert sev[("dim_sellers", "one_star_rate")] == ("error", "error")
    assert sev[("fct_orders", "gross_order_value")] == ("warn", "pass")
    with pytest.raises(dq.DataQualityError, match="one_star_rate"):
        dq.raise_on_error(results)
    fine = dq.run_checks(shop, kind="unique", severity="error").collect()
    assert len(dq.raise_on_error(fine)) == 14


def test_a_report_shares_what_its_checks_read(spark, monkeypatch):
    """The order grain of a report holds no distinct counts and the sellers are computed once;
    the pipeline keeps whole models."""
    from agora.plans.core import DISTINCT_COUNTS, FCT_ORDERS_COLUMNS
    from agora.plans.pipeline import Pipeline
    from tests.fixtures import shop_pipeline

    pipe, shared = shop_pipeline(spark), []
    share_orders, share = Pipeline.share_orders, Pipeline.share
    monkeypatch.setattr(Pipeline, "share_orders",
                        lambda self, *args: shared.append(share_orders(self, *args)))
    monkeypatch.setattr(Pipeline, "share",
                        lambda self, name: shared.append(share(self, name)))
    for kind in ("between", "not_null", "accepted_values"):
        got = dq.run_checks(pipe, kind=kind)
        orders, sellers = shared[-2:]
        assert "order_id" in orders.columns and not set(DISTINCT_COUNTS) & set(orders.columns)
        assert sellers.columns == pipe.dim_sellers.columns
        want = dq.run_checks(shop_pipeline(spark), kind=kind, share_orders=False)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        pipe = shop_pipeline(spark)
    dq.run_checks(pipe, kind="between")
    assert pipe.fct_orders.columns == list(FCT_ORDERS_COLUMNS)
