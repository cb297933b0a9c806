import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from agora.plans.pipeline import MARTS, Pipeline, from_testdata
from agora.sources import csv as csv_source
from agora.sources.schemas import RAW_FILES
from tests.conftest import conf, ts

TRANSLATION = "﻿product_category_name,product_category_name_english\r\nbeleza_saude,health_beauty\r\nartes,art\r\n"
REVIEWS = (
    'review_id,order_id,review_score,review_comment_title,review_comment_message,'
    'review_creation_date,review_answer_timestamp\n'
    'r1,o1,5,,"Muito bom, chegou ""rapido""\nrecomendo",2018-01-18 00:00:00,2018-01-18 21:46:59\n'
    'r2,o2,3.0,titulo,,2018-03-10 00:00:00,\n')
# column order differs from the schema: the header decides
SELLERS = 'seller_city,seller_id,seller_state,seller_zip_code_prefix\ncampinas,s1,SP,01046\n'


def _write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text)
    return path


def test_csv_quotes_breaks_bom_and_types(spark, tmp_path):
    folder = str(tmp_path)
    _write(folder, RAW_FILES["product_category_name_translation"], TRANSLATION)
    _write(folder, RAW_FILES["order_reviews"], REVIEWS)
    _write(folder, RAW_FILES["sellers"], SELLERS)
    tables = csv_source.read_raw_folder(spark, folder)
    assert set(tables) == {"product_category_name_translation", "order_reviews", "sellers"}
    tr = tables["product_category_name_translation"]
    assert tr.columns == ["product_category_name", "product_category_name_english"]
    assert sorted(tuple(r) for r in tr.collect()) == [("artes", "art"),
                                                      ("beleza_saude", "health_beauty")]
    rv = {r.review_id: r for r in tables["order_reviews"].collect()}
    assert rv["r1"].review_comment_message == 'Muito bom, chegou "rapido"\nrecomendo'
    assert rv["r1"].review_comment_title is None
    assert rv["r1"].review_answer_timestamp == ts("2018-01-18 21:46:59")
    assert rv["r2"].review_score == 3 and rv["r2"].review_answer_timestamp is None
    s = tables["sellers"].first()
    assert (s.seller_id, s.seller_zip_code_prefix, s.seller_city) == ("s1", 1046, "campinas")


def test_full_refresh_load_counts_rows(spark, tmp_path):
    src, target = str(tmp_path / "csv"), str(tmp_path / "raw")
    os.makedirs(src)
    _write(src, RAW_FILES["product_category_name_translation"], TRANSLATION)
    first = csv_source.load_raw(spark, src, target)
    again = csv_source.load_raw(spark, src, target)       # idempotent: overwrite
    assert [(r.table, r.rows) for r in first] == [("product_category_name_translation", 2)]
    assert [(r.table, r.rows) for r in again] == [("product_category_name_translation", 2)]
    loaded = csv_source.read_loaded(spark, target)
    assert loaded["product_category_name_translation"].count() == 2


def test_pipeline_build_writes_marts(spark, tmp_path, shop):
    pipe = Pipeline(dict(shop.raw))
    written = pipe.build(spark, warehouse=str(tmp_path / "wh"))
    assert set(written) == set(MARTS)
    fct = spark.read.parquet(written["fct_orders"])
    assert fct.count() == 4
    assert spark.read.parquet(written["mart_seller_health"]).count() == 2
    assert spark.table("stg_orders").count() == 4        # staging registered as views
    assert not pipe._materialized                       # shared order table released
    # a second build starts from the raw tables again
    pipe.__dict__["dim_products"] = None
    assert set(pipe.build(spark, warehouse=str(tmp_path / "wh"))) == set(MARTS)
    # later marts read earlier ones back from their written tables
    assert all("/core/fct_orders/" in f for f in pipe.fct_orders.inputFiles())


def test_testdata_mapping_counts(spark):
    p = from_testdata(spark, "/root/testdata/sf0.001")
    counts = {t: p.raw[t].count() for t in p.raw}
    assert counts == {"orders": 1500, "customers": 150, "order_items": 6000,
                      "order_payments": 2000, "order_reviews": 1575, "products": 200,
                      "sellers": 10, "product_category_name_translation": 6,
                      "geolocation": 250}


def test_testdata_mapping_keeps_every_row(spark):
    from agora.sources.testdata import read_source

    sf = "/root/testdata/sf0.001"
    p = from_testdata(spark, sf)
    for raw, source in (("orders", "orders"), ("order_items", "lineitem"), ("products", "part"),
                        ("customers", "customer"), ("sellers", "supplier")):
        assert p.raw[raw].count() == read_source(spark, sf, source).count(), raw
    ids = p.raw["orders"].select("order_id")
    for raw in ("order_payments", "order_reviews"):          # at least one per order
        assert ids.join(p.raw[raw], "order_id", "left_anti").count() == 0, raw
    assert p.dim_customers.where("customer_segment = 'no_orders'").count() > 0


def test_invariants_on_testdata(spark):
    p = from_testdata(spark, "/root/testdata/sf0.001")
    assert p.fct_orders.count() == p.stg_orders.count()
    for model, key in (("fct_orders", "order_id"), ("dim_customers", "customer_id"),
                       ("dim_sellers", "seller_id"), ("dim_products", "product_id"),
                       ("int_customer_order_history", "customer_unique_id")):
        df = p.model(model)
        assert df.count() == df.select(key).distinct().count(), model
    health = p.mart_seller_health
    n = health.count()
    assert sorted(r.revenue_rank for r in health.collect()) == list(range(1, n + 1))
    assert p.raw["orders"].where(F.col("order_id").isNull()).count() == 0


def test_catalog_tables_by_layer_schema(spark, shop):
    pipe = Pipeline(dict(shop.raw))
    written = pipe.build(spark, names=("fct_orders", "mart_revenue_monthly"))
    assert written == {"fct_orders": "`core`.`fct_orders`",
                       "mart_revenue_monthly": "`analytics`.`mart_revenue_monthly`"}
    assert spark.table("core.fct_orders").count() == 4
    pipe.build(spark, names=("fct_orders",))            # full refresh: same rows
    assert spark.table("core.fct_orders").count() == 4


def test_date_window_keeps_orders_in_range(spark, shop):
    import datetime as dt

    pipe = Pipeline(dict(shop.raw), date_window=(dt.date(2018, 3, 1), dt.date(2018, 3, 31)))
    assert sorted(r.order_id for r in pipe.fct_orders.collect()) == ["o1", "o2", "o3"]


def test_command_line_load_and_rfm(spark, tmp_path, capsys):
    from agora.__main__ import main

    src = str(tmp_path / "csv")
    os.makedirs(src)
    _write(src, RAW_FILES["product_category_name_translation"], TRANSLATION)
    assert main(["load", "--csv", src, "--raw", str(tmp_path / "raw")]) == 0
    assert "product_category_name_translation" in capsys.readouterr().out
    assert main(["rfm", "--testdata", "/root/testdata/sf0.001", "--as-of", "2000-01-01"]) == 0
    assert "customer_count" in capsys.readouterr().out


def test_results_do_not_depend_on_session_time_zone(spark):
    from tests.conftest import conf

    def run():
        p = from_testdata(spark, "/root/testdata/sf0.001")
        return [sorted(map(str, df.collect()))
                for df in (p.fct_orders, p.int_customer_order_history, p.mart_revenue_monthly)]

    with conf(spark, **{"spark.sql.session.timeZone": "UTC"}):
        utc = run()
    with conf(spark, **{"spark.sql.session.timeZone": "America/Sao_Paulo"}):
        local = run()
    assert utc == local


def test_build_with_checkpointed_order_grain(spark, tmp_path, shop):
    pipe = Pipeline(dict(shop.raw))
    written = pipe.build(spark, warehouse=str(tmp_path / "wh"), share="checkpoint",
                         names=("fct_orders", "mart_delivery_performance"))
    assert spark.read.parquet(written["fct_orders"]).count() == 4
    assert spark.read.parquet(written["mart_delivery_performance"]).count() == 2
    # the order grain now reads its checkpoint, not the raw tables
    plan = pipe.int_orders_enriched._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" in plan or "ExistingRDD" in plan


def test_large_csv_is_read_in_splits(spark, tmp_path):
    rows = "\n".join(f"o{i},1,credit_card,1,{i}.5" for i in range(40_000))
    _write(tmp_path, "p.csv",
           "order_id,payment_sequential,payment_type,payment_installments,payment_value\n" + rows)
    with conf(spark, **{"spark.sql.files.maxPartitionBytes": "128k",
                        "spark.sql.files.openCostInBytes": "1k"}):
        df = csv_source.read_raw_csv(spark, str(tmp_path / "p.csv"), "order_payments")
        assert df.rdd.getNumPartitions() > 1
        assert df.count() == 40_000


def test_csv_without_a_column_is_an_error(spark, tmp_path):
    _write(tmp_path, RAW_FILES["sellers"], "seller_id,seller_zip_code_prefix,seller_city\ns1,1,x\n")
    with pytest.raises(AnalysisException):
        csv_source.read_raw_folder(spark, str(tmp_path))
    (tmp_path / "empty").mkdir()
    assert csv_source.read_raw_folder(spark, str(tmp_path / "empty")) == {}


def _review_file(folder, name, n, eol="\n"):
    """Reviews whose messages hold line breaks, doubled quotes and commas; some long ones."""
    import random

    rnd = random.Random(11)
    parts = ["plain", '""quoted""', "a,b", "", f"line{eol}break", f"{eol}{eol}", '""', "x" * 300,
             f'""{eol}""']
    lines = [REVIEWS.splitlines()[0]]
    for i in range(n):
        message = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 6)))
        if i % 97 == 0:
            message += eol.join(["long"] * 900)          # longer than a split
        lines.append(f'r{i},o{i},{i % 5 + 1},"t{i}","{message}",2018-01-18 00:00:00,')
        if i % 50 == 0:
            lines.append("")
    return _write(folder, name, eol.join(lines) + (eol if n % 2 else ""))


@pytest.mark.parametrize("eol,n", [("\n", 400), ("\r\n", 301)])
def test_review_file_is_read_in_splits(spark, tmp_path, eol, n):
    path = _review_file(str(tmp_path), "reviews.csv", n, eol)
    want = (spark.read.option("header", True).option("multiLine", True).option("quote", '"')
            .option("escape", '"').csv(path).collect())
    with conf(spark, **{"spark.sql.files.maxPartitionBytes": "3k",
                        "spark.sql.files.openCostInBytes": "1"}):
        df = csv_source.read_raw_csv(spark, path, "order_reviews")
        got = df.collect()
        assert df.rdd.getNumPartitions() > 8
    assert len(got) == n
    key = "review_comment_message"
    assert sorted((r.review_id, r.review_comment_title, r[key]) for r in got if r[key]) == \
        sorted((r.review_id, r.review_comment_title, r[key]) for r in want if r[key])
    assert sorted(r.review_id for r in got) == sorted(r.review_id for r in want)


def test_folder_of_review_parts_and_faults(spark, tmp_path):
    from agora.sources.records import split_states

    folder = tmp_path / "parts"
    folder.mkdir()
    for i in range(3):
        _review_file(str(folder), f"p{i}.csv", 40)
    assert csv_source.read_raw_csv(spark, str(folder), "order_reviews").count() == 120
    # split 2 lies wholly inside the record that begins in split 1
    splits = [("f", 0, 3, True, True), ("f", 10, 2, False, False), ("f", 20, 2, True, True)]
    assert split_states(splits) == {("f", 0): None, ("f", 10): 0, ("f", 20): 0}
    _write(str(tmp_path), "odd.csv", REVIEWS + 'r3,o3,1,"open,,2018-01-18 00:00:00,\n')
    with pytest.raises(ValueError):
        csv_source.read_raw_csv(spark, str(tmp_path / "odd.csv"), "order_reviews")
    _write(str(tmp_path), "short.csv", REVIEWS + "r3,o3\n")
    with pytest.raises(Exception):
        csv_source.read_raw_csv(spark, str(tmp_path / "short.csv"), "order_reviews").collect()


def test_failed_load_leaves_the_earlier_tables(spark, tmp_path):
    src, target = str(tmp_path / "csv"), str(tmp_path / "raw")
    os.makedirs(src)
    _write(src, RAW_FILES["product_category_name_translation"], TRANSLATION)
    _write(src, RAW_FILES["sellers"], SELLERS)
    csv_source.load_raw(spark, src, target)
    before = csv_source.read_loaded(spark, target)["sellers"].collect()
    _write(src, RAW_FILES["sellers"], SELLERS.replace("s1", "s2"))
    # the last file of the load is broken: nothing is switched
    _write(src, RAW_FILES["product_category_name_translation"], TRANSLATION + "a,b,c,d\n")
    with pytest.raises(Exception):
        csv_source.load_raw(spark, src, target)
    tables = csv_source.read_loaded(spark, target)
    assert tables["sellers"].collect() == before
    assert tables["product_category_name_translation"].count() == 2
    assert len([f for f in os.listdir(f"{target}/sellers") if f.startswith("v-")]) == 1
    _write(src, RAW_FILES["product_category_name_translation"], TRANSLATION)
    csv_source.load_raw(spark, src, target)
    assert csv_source.read_loaded(spark, target)["sellers"].first().seller_id == "s2"


@pytest.mark.parametrize("catalog", [False, True])
def test_failed_build_leaves_the_earlier_tables(spark, tmp_path, shop, monkeypatch, catalog):
    from agora.plans import marts as mart_builders

    warehouse = None if catalog else str(tmp_path / "wh")
    names = ("fct_orders", "dim_sellers", "mart_seller_health")
    Pipeline(dict(shop.raw)).build(spark, warehouse, names=names)

    def fct():
        pipe = Pipeline({})
        pipe.use_built(spark, warehouse, names=names)
        return sorted(r.order_id for r in pipe.fct_orders.collect())
    want = fct()
    raw = dict(shop.raw)
    raw["orders"] = raw["orders"].where("order_id <> 'o1'")
    with monkeypatch.context() as m:
        m.setattr(mart_builders, "mart_seller_health", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            Pipeline(raw).build(spark, warehouse, names=names)
    assert fct() == want
    Pipeline(raw).build(spark, warehouse, names=names)
    assert fct() == [o for o in want if o != "o1"]


def test_versions_published_and_removed(spark, tmp_path):
    from agora.sources import sinks

    path = str(tmp_path / "t")
    opened = []
    for i in range(4):
        sinks.write_table(spark, spark.range(i + 1), "t", None, path)
        opened.append(sinks.read_table(spark, path))
    assert [df.count() for df in opened[2:]] == [3, 4]       # the version before stays readable
    assert len([f for f in os.listdir(path) if f.startswith("v-")]) == 2
    # a catalog table whose columns change
    sinks.write_table(spark, spark.range(3), "pub", "audit")
    sinks.write_table(spark, spark.range(5).selectExpr("id", "id * 2 AS twice"), "pub", "audit")
    assert spark.table("audit.pub").columns == ["id", "twice"] and spark.table("audit.pub").count() == 5


def _orders_by_month(months):
    header = ",".join(["order_id", "customer_id", "order_status", "order_purchase_timestamp",
                       "order_approved_at", "order_delivered_carrier_date",
                       "order_delivered_customer_date", "order_estimated_delivery_date"])
    return header + "\n" + "\n".join(
        f"o{m}{i},c{i},delivered,{2017 + m // 12}-{m % 12 + 1:02d}-{i + 1:02d} 10:00:00,,,,"
        for m in range(months) for i in range(5)) + "\nox,c1,created,,,,,\n"


def test_date_window_reads_its_months_only(spark, tmp_path):
    import datetime as dt
    import re

    src, target = str(tmp_path / "csv"), str(tmp_path / "raw")
    os.makedirs(src)
    _write(src, RAW_FILES["orders"], _orders_by_month(18))
    csv_source.load_raw(spark, src, target)
    raw = csv_source.read_loaded(spark, target)
    assert Pipeline(raw).stg_orders.count() == 91
    assert "purchase_month" not in Pipeline(raw).stg_orders.columns
    pipe = Pipeline(raw, date_window=(dt.date(2017, 11, 3), dt.date(2018, 1, 2)))
    df = pipe.stg_orders
    assert sorted(r.order_id for r in df.collect()) == sorted(
        [f"o10{i}" for i in range(2, 5)] + [f"o11{i}" for i in range(5)] + ["o120", "o121"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*purchase_month", plan)
    files = df.select(F.input_file_name().alias("f")).distinct().collect()
    assert {re.search(r"purchase_month=(\d+)", r.f)[1] for r in files} == {"201711", "201712", "201801"}
    # the written order fact too
    fct = spark.range(36).select(F.col("id").alias("order_id"), F.make_timestamp_ntz(
        F.lit(2017) + F.floor(F.col("id") / 12).cast("int"), (F.col("id") % 12 + 1).cast("int"),
        F.lit(5), F.lit(0), F.lit(0), F.lit(0.0)).alias("purchased_at"))
    from agora.sources import sinks
    where = sinks.write_table(spark, sinks.by_month(fct, "purchased_at"), "fct_orders", "core",
                              f"{tmp_path}/wh/core/fct_orders", partition_by=[sinks.MONTH])
    built = Pipeline({}, date_window=(dt.date(2018, 2, 1), dt.date(2018, 3, 31)))
    built.use_built(spark, f"{tmp_path}/wh", names=("fct_orders",))
    assert sorted(r.order_id for r in built.fct_orders.collect()) == [13, 14] and where
    assert built.fct_orders.columns == ["order_id", "purchased_at"]
    assert "purchase_month" in built.fct_orders._jdf.queryExecution().executedPlan().toString()


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    return plan.count("Exchange ")


def test_order_grain_of_bucketed_tables_needs_no_exchange(spark, monkeypatch):
    plain = from_testdata(spark, "/root/testdata/sf0.001")
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        raw = csv_source.load_bucketed(spark, plain.raw, buckets=4)
        stored = Pipeline(raw)
        assert _exchanges(stored.int_orders_enriched) == 0
        want = sorted(map(str, plain.int_orders_enriched.collect()))
        assert sorted(map(str, stored.int_orders_enriched.collect())) == want
        # a third of the items in one order: its rows lie apart and are spread
        tables = dict(plain.raw)
        tables["order_items"] = tables["order_items"].withColumn(
            "order_id", F.when(F.col("order_item_id") % 3 == 0, 7).otherwise(F.col("order_id")).cast("bigint"))
        monkeypatch.setattr(csv_source, "HOT_LEAST", 3000)
        skewed = Pipeline(csv_source.load_bucketed(spark, tables, buckets=4))
        assert {"order_items_cold", "order_items_hot"} <= set(skewed.raw)
        assert "order_payments_hot" not in skewed.raw
        hot = skewed.raw["order_items_hot"]
        assert hot.where("order_id = 7").count() == tables["order_items"].where("order_id = 7").count()
        assert hot.count() + skewed.raw["order_items_cold"].count() == 6000
        want = sorted(map(str, Pipeline(tables).int_orders_enriched.collect()))
        assert sorted(map(str, skewed.int_orders_enriched.collect())) == want
        monkeypatch.undo()
        again = csv_source.load_bucketed(spark, plain.raw, buckets=8)       # published anew
        assert "order_items_hot" not in again and again["order_items"].count() == 6000


def test_buckets_grow_with_the_tables(spark, monkeypatch):
    """A bucket holds a bounded number of rows however large the tables are."""
    plain = from_testdata(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(csv_source, "BUCKET_ROWS", 500)
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        raw = csv_source.load_bucketed(spark, plain.raw, buckets=2, database="grown")
        facts = {r.col_name: r.data_type
                 for r in spark.sql("DESCRIBE TABLE EXTENDED grown.order_items").collect()}
        assert facts["Num Buckets"] == "12"                 # 6000 items
        part = raw["order_items"].groupBy(F.input_file_name()).count().collect()
        assert max(r["count"] for r in part) < 1000
        stored = Pipeline(raw)
        assert _exchanges(stored.int_orders_enriched) == 0
        want = sorted(map(str, plain.int_orders_enriched.collect()))
        assert sorted(map(str, stored.int_orders_enriched.collect())) == want


def test_staging_views_outlive_the_session(spark, tmp_path):
    from agora.plans.staging_views import VIEWS
    from agora.sources import sinks

    plain = from_testdata(spark, "/root/testdata/sf0.001")
    for table, df in plain.raw.items():
        sinks.write_table(spark, df, table, "raw_views")
    raw = {t: spark.table(f"raw_views.{t}") for t in plain.raw}
    pipe = Pipeline(raw)
    pipe.build(spark, names=("fct_orders",), raw_database="raw_views")
    later = spark.newSession()
    for name in VIEWS:
        got, want = later.table(f"staging.{name}"), plain.model(name)
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema], name
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
    # a view follows its raw table to the next version
    sinks.write_table(spark, plain.raw["sellers"].limit(3), "sellers", "raw_views")
    assert spark.newSession().table("staging.stg_sellers").count() == 3
    for name in VIEWS:
        spark.sql(f"DROP VIEW staging.{name}")


def test_load_into_the_catalog(spark, tmp_path):
    src = str(tmp_path)
    _write(src, RAW_FILES["orders"], _orders_by_month(3))
    _write(src, RAW_FILES["sellers"], SELLERS)
    for _ in range(2):                                      # a full refresh each
        csv_source.load_raw(spark, src, None, database="raw_cat")
    tables = csv_source.read_loaded(spark, None, database="raw_cat")
    assert set(tables) == {"orders", "sellers"}
    assert tables["orders"].count() == 16 and tables["sellers"].count() == 1
    assert tables["orders"].where("purchase_month = 201702").count() == 5
