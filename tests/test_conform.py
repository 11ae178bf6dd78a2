import datetime as dt

import pytest
from pyspark.sql import functions as F

from shopgrain.operators import conform
from shopgrain.operators.clean import clean, unify_nulls

AT = dt.datetime(2024, 1, 1)


def _one(df, fn):
    return fn(clean(df, AT)).first()


def _column(text, columns, fn, name, values, **fixed):
    """`fn` over rows that differ in one column; the results in order."""
    rows = []
    for i, v in enumerate(values):
        row = {**{c: None for c in columns}, **fixed, columns[0]: f"{i:03d}", name: v}
        rows.append(tuple(row[c] for c in columns))
    df = fn(clean(text(columns, *rows), AT))
    return [r[name] for r in df.orderBy(columns[0]).collect()]


CUSTOMER = [
    "customer_trx_id", "subscriber_id", "subscribe_date", "first_order_date",
    "customer_postal_code", "customer_city", "customer_country",
    "customer_country_code", "age", "gender",
]
ORDER = [
    "order_id", "customer_trx_id", "order_status", "order_purchase_timestamp",
    "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]
ITEM = [
    "order_id", "order_item_id", "product_id", "seller_id",
    "shipping_limit_date", "price", "freight_value",
]
REVIEW = [
    "review_id", "order_id", "review_score", "review_comment_title_en",
    "review_comment_message_en", "review_creation_date",
    "review_answer_timestamp",
]
PRODUCT = [
    "product_id", "product_category_name", "product_weight_gr",
    "product_length_cm", "product_height_cm", "product_width_cm",
]
SELLER = [
    "seller_id", "seller_name", "seller_postal_code", "seller_city",
    "country_code", "seller_country",
]
PAYMENT = [
    "order_id", "payment_sequential", "payment_type", "payment_installments",
    "payment_value",
]
GEO = ["geo_postal_code", "geo_lat", "geo_lon", "geolocation_city", "geo_country"]


@pytest.mark.parametrize(
    "column, values, want",
    [
        ("customer_postal_code", ["7", "01234", "123456", "NA", None],
         ["00007", "01234", "12345", "000NA", None]),
        ("customer_city", [" SÃO paulo ", "NA"], ["São Paulo", "Na"]),
        ("gender", ["FEMALE", "na"], ["Female", "Na"]),
        ("customer_country", [" brazil "], ["BRAZIL"]),
        ("customer_country_code", ["br"], ["br"]),
        ("age", ["33", "33.0", "33.9", "NA", None, "-4", "old", "1e3"],
         [33, 33, 33, None, None, -4, None, None]),
        ("subscribe_date", ["2017-10-02", "2017-10-02 11:00:00", "NA", "02/10/2017"],
         [dt.date(2017, 10, 2), dt.date(2017, 10, 2), None, None]),
    ],
)
def test_customers(text, column, values, want):
    assert _column(text, CUSTOMER, conform.customers, column, values) == want


@pytest.mark.parametrize(
    "column, values, want",
    [
        ("seller_postal_code", ["12"], ["00012"]),
        ("seller_city", ["rio de janeiro"], ["Rio De Janeiro"]),
        ("seller_country", ["brazil"], ["BRAZIL"]),
        ("country_code", [" br"], ["BR"]),
        ("seller_name", ["a B"], ["a B"]),
    ],
)
def test_sellers(text, column, values, want):
    assert _column(text, SELLER, conform.sellers, column, values) == want


def test_orders(text):
    values = ["2017-10-02 10:56:33", "2017-10-02", "02/10/2017 10:56", "NA"]
    want = [dt.datetime(2017, 10, 2, 10, 56, 33), dt.datetime(2017, 10, 2), None, None]
    for column in ORDER[3:]:
        assert _column(text, ORDER, conform.orders, column, values) == want
    assert _column(text, ORDER, conform.orders, "order_status", [" Delivered", "NULL"]) == [
        "delivered", "na",
    ]


def test_order_items(text):
    row = _one(
        text(ITEM, ("o", "1", "p", "s", "2017-01-01", "10.10", "2.25")),
        conform.order_items,
    )
    assert (row.order_item_id, row.price, row.total_item_value) == (1, 10.10, 12.35)
    row = _one(text(ITEM, ("o", "1", "p", "s", "x", "NA", "2.25")), conform.order_items)
    assert row.price is None and row.total_item_value is None
    assert row.shipping_limit_date is None


def test_order_payments(text):
    row = _one(
        text(PAYMENT, ("o", "2", " Credit_Card ", "3.0", "99.9")),
        conform.order_payments,
    )
    assert tuple(row)[:5] == ("o", 2, "credit_card", 3, 99.9)


def test_order_reviews(text):
    scores = ["5", "4", "3", "2", "1", "NA", None]
    want = ["positive"] * 2 + ["neutral"] + ["negative"] * 4
    rows = [(str(i), "o", s, "t", "m", "2017-01-01", "NA") for i, s in enumerate(scores)]
    df = conform.order_reviews(clean(text(REVIEW, *rows), AT))
    assert [r.review_sentiment for r in df.orderBy("review_id").collect()] == want


def test_products(text):
    row = _one(text(PRODUCT, ("p", "Toys ", "100", "10", "2.5", "3")), conform.products)
    assert (row.product_category_name, row.product_volume_cm3) == ("toys", 75.0)
    row = _one(text(PRODUCT, ("p", "Toys", "100", "10", "NA", "3")), conform.products)
    assert row.product_volume_cm3 is None


def test_geolocations_keep_the_lowest_row(text):
    df = text(
        GEO,
        ("7", "2.0", "1.0", "b", "x"), ("7", "1.0", "9.0", "a", "x"),
        ("7", "1.0", "8.0", "z", "x"), ("7", "NA", "0.0", "a", "x"),
        ("8", "1", "1", "new york", "us"),
    )
    got = {r.geo_postal_code: r for r in conform.geolocations(clean(df, AT)).collect()}
    assert set(got) == {"7", "8"}
    assert (got["7"].geo_lat, got["7"].geo_lon) == (1.0, 8.0)
    assert (got["8"].geolocation_city, got["8"].geo_country) == ("New York", "US")
    padded = conform.geolocations(clean(df, AT), pad=True).collect()
    assert {r.geo_postal_code for r in padded} == {"00007", "00008"}


def test_whole_numbers_are_matched_once(spark):
    """Cells with digits need no second match, and long text is not lowered (F10)."""
    cells = ["7", " -7.9 ", ".5", "-.5", ".", "7.", "99999999999", "NA", "x", "", None]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    read = df.select(conform.whole_number(F.col("c")).alias("n"))
    assert [r.n for r in read.collect()] == [7, -7, 0, 0, None, 7, None, None, None, None, None]
    plan = read._jdf.queryExecution().analyzed().toString()
    assert plan.index("regexp_extract") < plan.index("RLIKE")
    assert "octet_length" in unify_nulls(df)._jdf.queryExecution().analyzed().toString()
