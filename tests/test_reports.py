"""Each report over a hand-computed star, with the cases that are easy to lose."""

import datetime as dt

import pytest

from shopgrain.plans import REPORTS, register_views
from shopgrain.plans.order_summary import order_columns
from tests.conftest import rows_of

D1, D2 = dt.date(2020, 1, 6), dt.date(2020, 2, 3)


def ts(day, hour=0):
    return dt.datetime.combine(day, dt.time(hour))


def order(key, customer, status, day, delivered=None, carrier=None, promised=None):
    return {
        "order_id": key, "customer_trx_id": customer, "order_status": status,
        "order_purchase_timestamp": ts(day, 9) if day else None, "sale_date": day,
        "order_delivered_customer_date": delivered, "order_delivered_carrier_date": carrier,
        "order_estimated_delivery_date": promised,
    }


def item(key, n, product, seller, price, freight):
    total = None if price is None else round(price + freight, 2)
    return {
        "order_id": key, "order_item_id": n, "product_id": product, "seller_id": seller,
        "price": price, "freight_value": freight, "total_item_value": total,
    }


def pay(key, n, kind, parts, value):
    return {
        "order_id": key, "payment_sequential": n, "payment_type": kind,
        "payment_installments": parts, "payment_value": value,
    }


def review(key, order_id, score, asked=None, answered=None):
    return {
        "review_id": key, "order_id": order_id, "review_score": score,
        "review_creation_date": asked, "review_answer_timestamp": answered,
        "review_sentiment": "x",
    }


@pytest.fixture
def shop(star):
    return star(
        orders=[
            order("o1", "c1", "delivered", D1, ts(D1 + dt.timedelta(5), 1), ts(D1 + dt.timedelta(2), 23), ts(D1 + dt.timedelta(3))),
            order("o2", "c1", "canceled", D1),
            order("o3", "c2", "shipped", D2, carrier=ts(D2)),
            order("o4", "c2", None, D2),
            order("o5", "c9", "delivered", None, ts(D2), ts(D2), ts(D2 + dt.timedelta(1))),
        ],
        order_items=[
            item("o1", 1, "p1", "s1", 10.0, 1.0), item("o1", 2, "p1", "s1", 20.0, 2.0),
            item("o1", 3, "p2", "s2", 5.0, 0.5), item("o2", 1, "p1", "s1", 100.0, 10.0),
            item("o3", 1, "p3", "s1", 0.0, 4.0), item("gone", 1, "p1", "s1", 7.0, 1.0),
        ],
        order_payments=[
            pay("o1", 1, "card", 3, 30.0), pay("o1", 2, "voucher", 1, 8.5),
            pay("o2", 1, "card", 1, 110.0), pay("o3", 1, "boleto", 1, None),
            pay("gone", 1, "card", 2, 8.0), pay("o5", 1, "card", 1, 1000.0),
        ],
        order_reviews=[
            review("r1", "o1", 1, ts(D1, 10), ts(D1, 12)), review("r2", "o1", 4),
            review("r3", "gone", 1), review("r4", "o3", None), review("r5", "o5", 5),
        ],
        customers=[
            {"customer_trx_id": "c1", "customer_postal_code": "00001", "customer_city": "A", "age": 30,
             "first_order_date": dt.date(2019, 1, 1)},
            {"customer_trx_id": "c2", "customer_postal_code": "00001", "customer_city": "A"},
            {"customer_trx_id": "c3", "customer_postal_code": "00002", "customer_city": "B", "age": 60},
        ],
        sellers=[
            {"seller_id": "s1", "seller_postal_code": "00001"}, {"seller_id": "s2"},
            {"seller_id": "idle", "seller_postal_code": "00009"},
        ],
        products=[
            {"product_id": "p1", "product_weight_gr": 499.0, "product_volume_cm3": 1000.0},
            {"product_id": "p2"}, {"product_id": "p3"}, {"product_id": "idle"},
        ],
        geolocations=[
            {"geo_postal_code": "00001", "geo_lat": 1.0, "geo_lon": 2.0, "geolocation_city": "A"},
            {"geo_postal_code": "00002", "geo_lat": 3.0, "geo_lon": 4.0, "geolocation_city": "B"},
        ],
    )


def subset(row, **want):
    assert {k: row[k] for k in want} == want


def test_order_summary(shop):
    df = REPORTS["order_summary"](shop)
    assert len(df.columns) == 32
    got = rows_of(df, "order_id")
    assert len(got) == 5
    subset(
        got["o1"], is_delivered=True, is_canceled=False, is_in_transit=False, delivery_delay_days=2,
        shipping_days=3, order_cycle_days=5, total_payment_value=38.5, max_installments=3,
        primary_payment_type="card", payment_parts_count=2, total_items=3, unique_products=2,
        unique_sellers=2, items_subtotal=35.0, freight_total=3.5, order_gmv=38.5,
        payment_vs_gmv_diff=0.0, sale_day_name="Monday", sale_yearmonth="2020-01", sale_day=6,
    )
    subset(got["o3"], total_payment_value=None, payment_parts_count=1, primary_payment_type="boleto",
           is_in_transit=True, delivery_delay_days=None, payment_vs_gmv_diff=4.0)
    subset(got["o4"], is_delivered=False, is_canceled=False, is_in_transit=False, total_payment_value=None,
           total_items=None, payment_vs_gmv_diff=0.0, payment_parts_count=None)


@pytest.mark.parametrize(
    "values, want",
    [
        ([("a", 1, 5.0), ("b", 2, 9.0), ("c", 3, 9.0)], "b"),
        ([("a", 1, None), ("b", 2, 3.0)], "b"),
        ([("a", 2, None), ("b", 1, None)], "b"),
        ([(None, 1, 9.0), ("b", 2, 3.0)], None),
    ],
)
def test_primary_payment_type(star, values, want):
    tables = star(
        orders=[order("o", "c", "delivered", D1)],
        order_payments=[pay("o", n, kind, 1, value) for kind, n, value in values],
    )
    assert REPORTS["order_summary"](tables).first().primary_payment_type == want


def test_order_columns(shop):
    got = rows_of(order_columns(shop["orders"]), "order_id")
    subset(got["o1"], sale_year=2020, is_delivered=True, order_cycle_days=5)


def test_daily_sales(shop):
    df = REPORTS["daily_sales_performance"](shop)
    assert len(df.columns) == 17
    assert [r.sale_date for r in df.collect()] == [None, D1, D2]
    got = rows_of(df, "sale_date")
    subset(
        got[D1], total_orders=2, delivered_orders=1, canceled_orders=1, pending_orders=0,
        daily_revenue=148.5, avg_order_value=74.25, daily_gmv=148.5, daily_freight=13.5,
        total_items_sold=4.0, avg_delivery_delay_days=2.0, avg_shipping_days=3.0, cancellation_rate_pct=50.0,
    )
    subset(got[D2], total_orders=2, pending_orders=2, daily_revenue=None, avg_order_value=None,
           daily_gmv=4.0, cancellation_rate_pct=0.0)


def test_daily_sales_count_a_repeated_order_once(star):
    tables = star(orders=[order("o", "c", "delivered", D1)] * 2)
    row = REPORTS["daily_sales_performance"](tables).first()
    assert (row.total_orders, row.delivered_orders, row.pending_orders) == (1, 2, -1)


def test_customer_profile(shop):
    df = REPORTS["customer_profile"](shop)
    assert len(df.columns) == 26
    got = rows_of(df, "customer_trx_id")
    assert set(got) == {"c1", "c2", "c3"}
    subset(
        got["c1"], age_group="Millennial (25-34)", total_orders=2, lifetime_value=148.5, avg_order_value=74.25,
        max_order_value=110.0, min_order_value=38.5, first_order_date=dt.date(2019, 1, 1),
        first_purchase_date=D1, last_purchase_date=D1, customer_tenure_days=0, delivered_orders=1,
        canceled_orders=1, avg_delivery_delay_days=2.0, customer_segment="Low Value", geo_lat=1.0, geo_lon=2.0,
    )
    subset(got["c2"], age_group="Unknown", total_orders=2, lifetime_value=0.0, customer_segment="Inactive")
    subset(got["c3"], total_orders=0, first_purchase_date=None, customer_tenure_days=0, geo_lat=3.0)


def test_seller_performance(shop):
    df = REPORTS["seller_performance"](shop)
    assert len(df.columns) == 22
    got = rows_of(df, "seller_id")
    # Orders o1, o2, o3 and the unknown one; o1's items have a mean of 15.
    subset(
        got["s1"], total_orders=4, total_items_sold=5, total_revenue=137.0, total_freight=18.0,
        avg_item_price=30.5, avg_review_score=1.75, total_reviews=4, delivered_orders=1, canceled_orders=1,
        avg_delivery_delay_days=2.0, avg_shipping_days=3.0, seller_tier="Bronze", cancellation_rate_pct=25.0,
        geo_lat=1.0,
    )
    subset(got["idle"], total_orders=0, total_revenue=0.0, avg_review_score=None, total_reviews=0,
           avg_shipping_days=None, seller_tier="Bronze", cancellation_rate_pct=0.0, geo_lat=None)


def test_product_performance(shop):
    df = REPORTS["product_performance"](shop)
    assert len(df.columns) == 29
    got = rows_of(df, "product_id")
    assert set(got) == {"p1", "p2", "p3", "idle"}
    # Two items of o1 (mean score 2.5), one of o2, one of the unknown order.
    subset(
        got["p1"], total_orders=3, total_units_sold=4, unique_sellers=1, total_revenue=137.0, avg_price=34.25,
        min_price=7.0, max_price=100.0, total_freight=14.0, avg_freight=3.5, freight_to_price_pct=10.22,
        avg_review_score=2.0, total_reviews=5, positive_reviews=2, neutral_reviews=0, negative_reviews=3,
        delivered_orders=2, canceled_orders=1, cancellation_rate_pct=33.33, product_tier="Low Seller",
        weight_bucket="Light (< 500g)", size_bucket="Medium",
    )
    subset(got["p3"], total_orders=1, avg_price=0.0, avg_freight=4.0, freight_to_price_pct=None,
           avg_review_score=None, total_reviews=1, product_tier="No Sales")
    subset(got["idle"], total_orders=0, total_revenue=0.0, freight_to_price_pct=None, avg_review_score=None,
           cancellation_rate_pct=0.0, product_tier="No Sales", weight_bucket="Very Heavy (5kg+)",
           size_bucket="Extra Large")


def test_product_cancellations_may_pass_100_percent(star):
    tables = star(
        orders=[order("o", "c", "canceled", D1)], products=[{"product_id": "p"}],
        order_items=[item("o", n, "p", "s", 1.0, 0.0) for n in (1, 2, 3)],
    )
    assert REPORTS["product_performance"](tables).first().cancellation_rate_pct == 300.0


def test_payment_analysis(shop):
    df = REPORTS["payment_analysis"](shop)
    assert len(df.columns) == 18
    rows = df.collect()
    assert [(r.sale_yearmonth, r.payment_type) for r in rows] == [
        (None, "card"), ("2020-01", "card"), ("2020-01", "voucher"), ("2020-02", "boleto"),
    ]
    # The unknown month holds an order without a day and one without a row.
    subset(rows[0].asDict(), total_orders=2, total_payment_value=1008.0, pct_of_monthly_revenue=None,
           delivered_orders=1, installment_orders=1, installment_usage_pct=50.0, sale_year=None)
    subset(
        rows[1].asDict(), total_orders=2, total_payment_parts=2, total_payment_value=140.0, avg_payment_value=70.0,
        min_payment_value=30.0, max_payment_value=110.0, avg_installments=2.0, max_installments=3,
        installment_orders=1, single_payment_orders=1, delivered_orders=1, canceled_orders=1,
        pct_of_monthly_revenue=94.28, installment_usage_pct=50.0, sale_year=2020, sale_month=1,
    )
    subset(rows[3].asDict(), total_payment_value=None, pct_of_monthly_revenue=None, total_orders=1)


def test_review_sentiment(shop):
    df = REPORTS["review_sentiment"](shop)
    assert len(df.columns) == 26
    got = rows_of(df, "review_id")
    assert len(got) == 5
    subset(
        got["r1"], review_response_hours=2.0, sentiment_bucket="Negative", star_label="⭐ Very Poor",
        customer_trx_id="c1", is_delivered=True, is_canceled=False, delivery_delay_days=2,
        is_late_and_unhappy=True, is_early_and_happy=False, total_payment_value=38.5,
        primary_payment_type="card", review_sentiment="x", sale_yearmonth="2020-01",
    )
    subset(got["r2"], is_late_and_unhappy=False, sentiment_bucket="Positive", review_response_hours=None)
    subset(got["r3"], order_status=None, is_delivered=None, is_late_and_unhappy=False, total_payment_value=None)
    subset(got["r4"], star_label="No Rating", sentiment_bucket="Negative", is_delivered=False)
    subset(got["r5"], is_early_and_happy=True, sale_date=None, sale_year=None)


def _places(df):
    return {(r.customer_postal_code, r.sale_yearmonth, r.geo_lat): r.asDict() for r in df.collect()}


def test_geo_sales(shop):
    df = REPORTS["geo_sales_heatmap"](shop)
    assert len(df.columns) == 20
    got = _places(df)
    assert set(got) == {("00001", "2020-01", 1.0), ("00001", "2020-02", 1.0), ("00002", None, 3.0)}
    subset(
        got["00001", "2020-01", 1.0], total_orders=2, unique_customers=1, delivered_orders=1, canceled_orders=1,
        total_revenue=148.5, avg_order_value=74.25, max_order_value=110.0, avg_review_score=2.5,
        cancellation_rate_pct=50.0, delivery_rate_pct=50.0, revenue_per_customer=148.5, sale_year=2020,
    )
    subset(got["00002", None, 3.0], total_orders=0, unique_customers=1, delivered_orders=0, total_revenue=None,
           cancellation_rate_pct=None, delivery_rate_pct=None, revenue_per_customer=None, sale_month=None)


def test_geo_sales_with_a_code_under_several_cities(shop, make):
    """Equal coordinates merge and weigh double, other ones are a group apart."""
    def point(city, lat):
        return {"geo_postal_code": "00001", "geo_lat": lat, "geo_lon": 2.0, "geolocation_city": city}

    shop["geolocations"] = make("geolocations", point("A", 1.0), point("B", 1.0), point("C", 5.0))
    got = _places(REPORTS["geo_sales_heatmap"](shop))
    subset(
        got["00001", "2020-01", 1.0], total_orders=2, unique_customers=1, delivered_orders=2, canceled_orders=2,
        total_revenue=297.0, avg_order_value=74.25, max_order_value=110.0, cancellation_rate_pct=100.0,
        revenue_per_customer=297.0,
    )
    subset(got["00001", "2020-01", 5.0], total_orders=2, delivered_orders=1, total_revenue=148.5)


def test_views_answer_sql(spark, shop):
    names = register_views(shop)
    assert len(names) == 8
    assert spark.sql("SELECT count(*) FROM vw_order_summary").first()[0] == 5
    for name in names:
        spark.catalog.dropTempView(name)


def test_invariants(shop):
    summary = REPORTS["order_summary"](shop)
    daily = REPORTS["daily_sales_performance"](shop)
    assert summary.count() == shop["orders"].count()
    assert daily.agg({"total_orders": "sum"}).first()[0] == shop["orders"].select("order_id").distinct().count()
    assert REPORTS["product_performance"](shop).count() == shop["products"].count()
