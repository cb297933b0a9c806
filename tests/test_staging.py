from agora.plans import staging
from tests.conftest import rows, ts
from tests.fixtures import raw


def test_stg_orders_lateness_and_days(spark):
    orders = raw(spark, "orders", [
        dict(order_id="a", order_purchase_timestamp=ts("2018-01-01 23:00:00"),
             order_delivered_customer_date=ts("2018-01-10 00:00:00"),
             order_estimated_delivery_date=ts("2018-01-10 00:00:00")),            # on time
        dict(order_id="b", order_purchase_timestamp=ts("2018-01-01 23:00:00"),
             order_delivered_customer_date=ts("2018-01-10 00:00:01"),
             order_estimated_delivery_date=ts("2018-01-10 00:00:00")),            # 1 s late
        dict(order_id="c", order_purchase_timestamp=ts("2018-01-01 23:00:00"),
             order_estimated_delivery_date=ts("2018-01-10 00:00:00")),            # not delivered
        dict(order_id="d", order_purchase_timestamp=ts("2018-01-01 23:00:00"),
             order_delivered_customer_date=ts("2018-01-02 01:00:00")),            # no estimate
    ])
    out = staging.stg_orders(orders)
    assert out.columns == ["order_id", "customer_id", "order_status", "purchased_at",
                           "approved_at", "shipped_at", "delivered_at", "estimated_delivery_at",
                           "is_late_delivery", "days_to_deliver"]
    got = rows(out, "order_id", "is_late_delivery", "days_to_deliver")
    assert got == [("a", False, 9), ("b", True, 9), ("c", None, None), ("d", None, 1)]


def test_stg_customers_and_sellers_clean_text(spark):
    cust = raw(spark, "customers", [dict(customer_id="c1", customer_unique_id="u1",
                                         customer_zip_code_prefix=1046,
                                         customer_city="  Sao Paulo ", customer_state=" sp ")])
    assert rows(staging.stg_customers(cust)) == [("c1", "u1", 1046, "sao paulo", "SP")]
    sel = raw(spark, "sellers", [dict(seller_id="s1", seller_zip_code_prefix=7,
                                      seller_city="\tCampinas ", seller_state="sp")])
    # trim strips blanks only: the tab stays
    assert rows(staging.stg_sellers(sel)) == [("s1", 7, "\tcampinas", "SP")]


def test_stg_order_reviews_keeps_latest(spark):
    reviews = raw(spark, "order_reviews", [
        dict(review_id="r1", order_id="o1", review_score=1,
             review_answer_timestamp=ts("2018-01-01 10:00:00")),
        dict(review_id="r2", order_id="o1", review_score=4,
             review_answer_timestamp=ts("2018-01-02 10:00:00")),   # later: kept
        dict(review_id="r3", order_id="o2", review_score=3,
             review_answer_timestamp=ts("2018-01-02 10:00:00")),
        dict(review_id="r4", order_id="o2", review_score=5,
             review_answer_timestamp=ts("2018-01-02 10:00:00")),   # equal time: higher id
        dict(review_id="r5", order_id="o3", review_score=2),        # NULL time only
        dict(review_id="r6", order_id="o4", review_score=None,
             review_answer_timestamp=ts("2018-01-02 10:00:00")),
        dict(review_id="r7", order_id="o4", review_score=5),        # NULL time loses
    ])
    out = staging.stg_order_reviews(reviews)
    got = rows(out, "order_id", "review_id", "review_score", "sentiment")
    assert got == [("o1", "r2", 4, "positive"), ("o2", "r4", 5, "positive"),
                   ("o3", "r5", 2, "negative"), ("o4", "r6", None, "negative")]
    narrow = staging.latest_review_scores(reviews)
    assert rows(narrow) == [(o, s, m) for o, _, s, m in got]


def test_stg_products_category_fallbacks_and_volume(spark):
    products = raw(spark, "products", [
        dict(product_id="p1", product_category_name="beleza", product_length_cm=10.0,
             product_height_cm=2.0, product_width_cm=3.0),
        dict(product_id="p2", product_category_name="sem_traducao", product_length_cm=None,
             product_height_cm=2.0, product_width_cm=3.0),
        dict(product_id="p3", product_category_name=None),
    ])
    translation = raw(spark, "product_category_name_translation",
                      [dict(product_category_name="beleza",
                            product_category_name_english="health_beauty")])
    out = staging.stg_products(products, translation)
    got = rows(out, "product_id", "category_name", "category_name_pt", "volume_cm3")
    assert got == [("p1", "health_beauty", "beleza", 60.0),
                   ("p2", "sem_traducao", "sem_traducao", None),
                   ("p3", "unknown", None, None)]


def test_geo_by_zip_picks_first_point(spark):
    geo = raw(spark, "geolocation", [
        dict(geolocation_zip_code_prefix=1, geolocation_lat=2.0, geolocation_lng=5.0,
             geolocation_city="B", geolocation_state="x"),
        dict(geolocation_zip_code_prefix=1, geolocation_lat=1.0, geolocation_lng=9.0,
             geolocation_city="A", geolocation_state="y"),
        dict(geolocation_zip_code_prefix=1, geolocation_lat=None, geolocation_lng=0.0,
             geolocation_city="C", geolocation_state="z"),
        dict(geolocation_zip_code_prefix=2, geolocation_lat=None, geolocation_lng=None,
             geolocation_city="D", geolocation_state="w"),
    ])
    out = staging.geo_by_zip(staging.stg_geolocation(geo))
    assert rows(out, "zip_code_prefix", "lat", "lng", "city", "state") == [
        (1, 1.0, 9.0, "a", "Y"), (2, None, None, "d", "W")]
