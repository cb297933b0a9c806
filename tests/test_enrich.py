import pytest

from tests.conftest import rows, ts


def test_orders_enriched(shop):
    out = shop.int_orders_enriched
    got = {r["order_id"]: r for r in out.collect()}
    o1, o2, o3, o4 = got["o1"], got["o2"], got["o3"], got["o4"]
    assert (o1.item_count, o1.distinct_products, o1.distinct_sellers) == (2, 1, 1)
    assert (o1.gross_order_value, o1.total_payment_value) == (220.0, 220.0)
    assert (o1.primary_payment_type, o1.max_installments, o1.payment_methods_used) == (
        "credit_card", 6, 2)
    assert o2.primary_payment_type == "boleto"           # equal values: type ascending
    assert o4.primary_payment_type == "debit_card"       # only a NULL value
    assert (o3.item_count, o3.gross_order_value, o3.total_payment_value,
            o3.max_installments, o3.payment_methods_used, o3.primary_payment_type) == (
        0, 0.0, 0.0, 1, 0, None)
    assert (o1.review_score, o1.review_sentiment, o3.review_score) == (1, "negative", None)
    assert (o1.order_month, o1.order_week) == (ts("2018-03-01"), ts("2018-02-26"))
    assert (o1.purchase_day_of_week, o1.purchase_hour) == (0, 10)   # a Sunday
    assert (o1.is_late_delivery, o1.days_to_deliver, o2.is_late_delivery) == (True, 8, False)


def test_customers_enriched(shop):
    got = {r["customer_id"]: r for r in shop.int_customers_enriched.collect()}
    c1, c2, c3 = got["c1"], got["c2"], got["c3"]
    # zip 10 has two points: the first by lat wins; state/city from it
    assert (c1.state, c1.city, c1.customer_lat) == ("GG", "geo town", -3.0)
    assert (c2.state, c2.city, c2.customer_lat) == ("BB", "other", None)
    assert (c1.total_orders, c1.delivered_orders, c1.lifetime_gmv) == (3, 2, 275.0)
    assert c1.is_repeat_buyer is True and c2.is_repeat_buyer is False
    # o4 has gross 0: left out of the freight ratio
    assert c1.avg_freight_pct == pytest.approx((20 / 220 + 5 / 55) / 2)
    assert (c1.late_orders, c1.customer_lifespan_days) == (1, 58)
    assert c1.late_order_rate == pytest.approx(1 / 3, rel=1e-6)
    assert c1.most_used_payment_type == "debit_card"    # max of text, not the mode
    assert (c3.total_orders, c3.lifetime_gmv, c3.late_order_rate, c3.first_order_at) == (
        0, 0.0, None, None)


def test_products_enriched_rates_can_exceed_one(shop):
    got = {r["product_id"]: r for r in shop.int_products_enriched.collect()}
    p1, p2 = got["p1"], got["p2"]
    assert (p1.product_category_name, p1.category_name_english) == ("cama", "bed")
    assert (p2.product_category_name, p2.category_name_english) == (None, None)
    assert (p1.times_ordered, p1.distinct_orders, p1.total_revenue) == (2, 1, 200.0)
    # two item rows of a one-star order over one reviewable order
    assert (p1.one_star_count, p1.one_star_rate) == (2, 2.0)
    assert p1.freight_to_price_ratio == pytest.approx(0.1)
    assert p2.freight_to_price_ratio == pytest.approx(2.5 / 25)   # (5+0)/2 over (50+0)/2


def test_sellers_enriched(shop):
    got = {r["seller_id"]: r for r in shop.int_sellers_enriched.collect()}
    s1, s2, s3 = got["s1"], got["s2"], got["s3"]
    assert (s1.total_orders, s1.total_items_sold, s1.distinct_products) == (2, 3, 2)
    # late item rows of delivered orders over all distinct orders: 2 / 2
    assert (s1.late_orders, s1.late_delivery_rate) == (2, 1.0)
    assert (s1.one_star_reviews, s1.one_star_rate) == (2, 2.0)
    assert s1.avg_days_to_deliver == 8.0              # item-weighted over delivered orders
    assert s1.avg_promised_window == 5.0
    assert (s2.late_orders, s2.five_star_reviews, s2.avg_review_score) == (0, 1, 5.0)
    assert (s3.total_orders, s3.total_revenue, s3.late_delivery_rate, s3.avg_review_score) == (
        0, 0.0, None, None)
    assert s1.is_high_revenue_low_rating is False


def test_customer_order_history(shop):
    got = {r["customer_unique_id"]: r for r in shop.int_customer_order_history.collect()}
    assert set(got) == {"u1"}                          # the canceled order is left out
    u1 = got["u1"]
    assert (u1.total_orders, u1.customer_segment, u1.total_items_purchased) == (3, "repeat", 4)
    assert u1.cohort_month == ts("2018-03-01")


def test_fct_orders_adds_customer_place(shop):
    out = shop.fct_orders
    assert len(out.columns) == 28
    assert rows(out, "order_id", "customer_state") == [
        ("o1", "GG"), ("o2", "GG"), ("o3", "BB"), ("o4", "GG")]
