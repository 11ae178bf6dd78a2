"""Amounts that are infinite, no number, or on half a cent."""

import datetime as dt
import math

import pytest

from shopgrain.operators import conform, control
from shopgrain.plans import REPORTS

DAY = dt.date(2024, 3, 5)
NOW = dt.datetime(2024, 3, 5, 12, tzinfo=dt.timezone.utc)


def _paid(star, *amounts):
    order = {"order_id": "o", "customer_trx_id": "c", "order_status": "delivered", "sale_date": DAY,
             "order_purchase_timestamp": dt.datetime.combine(DAY, dt.time(9))}
    payments = [
        {"order_id": "o", "payment_sequential": k, "payment_type": "card", "payment_installments": 1, "payment_value": x}
        for k, x in enumerate(amounts, 1)
    ]
    customer = {"customer_trx_id": "c", "customer_postal_code": "1", "customer_city": "A", "customer_country": "B"}
    return star(orders=[order], order_payments=payments, customers=[customer])


@pytest.mark.parametrize("amounts", [(1.5, math.nan), (math.inf, 2.0), (-math.inf, 2.0), (math.inf, -math.inf), (1.25, 2.5)])
def test_reports_keep_what_is_not_finite(star, amounts):
    want = sum(amounts)
    tables = _paid(star, *amounts)
    for report, column in (("payment_analysis", "total_payment_value"), ("geo_sales_heatmap", "total_revenue")):
        (row,) = REPORTS[report](tables).collect()
        got = row[column]
        assert got == want or (math.isnan(got) and math.isnan(want)), report


def test_a_month_with_an_infinite_payment_has_no_share(star):
    (row,) = REPORTS["payment_analysis"](_paid(star, math.inf)).collect()
    assert math.isnan(row.pct_of_monthly_revenue)


def test_half_cents_round_as_written(spark):
    text = spark.createDataFrame(
        [("o", "1", "1.000", "0.005", None), ("p", "1", "-1.000", "-0.005", None), ("q", "1", "1.1", "1.1", None)],
        "order_id string, order_item_id string, price string, freight_value string, shipping_limit_date string",
    )
    got = {r.order_id: r.total_item_value for r in conform.order_items(text).collect()}
    assert got == {"o": 1.01, "p": -1.01, "q": 2.2}


def test_a_run_recorded_twice_counts_once(spark, tmp_path):
    path = str(tmp_path / "audit")
    for hour, run, status in ((1, "a", "success"), (2, "b", "failed"), (3, "b", "success"), (4, "b", "success")):
        now = NOW + dt.timedelta(hours=hour)
        control.record_load(spark, path, "daily", run, DAY, status=status, now=now)
    rows = {r.run_id: r for r in control.read_audit(spark, path).collect()}
    assert sorted(rows) == ["a", "b"]
    assert rows["b"].status == "success"
    # The good load before it, not its own earlier record.
    assert rows["b"].prev_load_timestamp == rows["a"].load_timestamp
    assert control.check_freshness(spark, path, NOW + dt.timedelta(hours=5)) == "fresh"
