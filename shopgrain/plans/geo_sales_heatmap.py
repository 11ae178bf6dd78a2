"""Sales per place and month, with coordinates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import dates
from shopgrain.functions.numbers import from_units, not_finite, percent, round2, units
from shopgrain.operators.rollups import (
    order_facts,
    payment_totals,
    postal_centres,
    review_totals,
)

PLACE = [
    "customer_country",
    "customer_country_code",
    "customer_city",
    "customer_postal_code",
]
# Figures that add up when groups are merged.
ADDITIVE = [
    "delivered_orders",
    "canceled_orders",
    "paid_units",
    "paid_odd",
    "paid_orders",
    "score_units",
    "scored_orders",
]


def customer_months(
    orders: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Order figures per customer and month, in addable form.

    An order id has one customer and one month, so distinct orders counted
    here may be added up later.  A customer id shared by very many orders
    (guests, the 'NA' mark) is down to one row per month before it is joined.
    """
    paid = F.col("total_payment_value")
    score = units(F.col("avg_review_score"))
    return (
        order_facts(orders, "customer_trx_id", "sale_date")
        .join(payment_totals(payments), "order_id", "left")
        .join(review_totals(reviews), "order_id", "left")
        .groupBy(
            "customer_trx_id",
            dates.month_start(F.col("sale_date")).alias("month"),
        )
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.count_if("is_delivered").alias("delivered_orders"),
            F.count_if("is_canceled").alias("canceled_orders"),
            F.sum(units(paid)).alias("paid_units"),
            F.sum(not_finite(paid)).alias("paid_odd"),
            F.count(paid).alias("paid_orders"),
            F.max(paid).alias("max_order_value"),
            F.sum(score).alias("score_units"),
            F.count(score).alias("scored_orders"),
        )
    )


def place_months(customers: DataFrame, by_customer: DataFrame) -> DataFrame:
    """Merge customers of one place; those without orders have no month.

    Two steps: per customer inside the partitions of the join, then per place
    over the partial sums.  That makes the count of customers exact without a
    distinct of its own.
    """
    merged = [F.sum(c).alias(c) for c in ADDITIVE]
    highest = F.max("max_order_value").alias("max_order_value")
    return (
        customers.select("customer_trx_id", *PLACE)
        .join(by_customer, "customer_trx_id", "left")
        .groupBy(*PLACE, "month", "customer_trx_id")
        .agg(F.max("total_orders").alias("total_orders"), highest, *merged)
        .groupBy(*PLACE, "month")
        .agg(
            F.count("customer_trx_id").alias("unique_customers"),
            F.sum("total_orders").alias("total_orders"),
            highest,
            *merged,
        )
    )


def place_centres(geolocations: DataFrame) -> DataFrame:
    """Coordinates per postal code and how often each pair occurs.

    A code listed under several cities has several rows.  Where these agree on
    the coordinates, each order counts once per row, as it would if every
    order were joined to them; `copies` carries that factor.
    """
    return (
        postal_centres(geolocations, "geolocation_city", "geo_country")
        .groupBy(
            F.col("geo_postal_code").alias("customer_postal_code"),
            "geo_lat",
            "geo_lon",
        )
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def geo_sales_heatmap(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Coordinates are joined last, to places and months instead of orders."""
    months = customer_months(
        tables["orders"], tables["order_payments"], tables["order_reviews"]
    )
    copies = F.coalesce(F.col("copies"), F.lit(1))
    places = (
        place_months(tables["customers"], months)
        .join(place_centres(tables["geolocations"]), "customer_postal_code", "left")
        .withColumns({c: F.col(c) * copies for c in ADDITIVE})
        .withColumns(
            {
                "total_orders": F.coalesce("total_orders", F.lit(0)),
                "delivered_orders": F.coalesce("delivered_orders", F.lit(0)),
                "canceled_orders": F.coalesce("canceled_orders", F.lit(0)),
            }
        )
    )
    revenue = from_units(F.col("paid_units"), F.col("paid_odd"))
    orders = F.col("total_orders")
    return places.select(
        *PLACE,
        "geo_lat",
        "geo_lon",
        *dates.calendar(F.col("month"), "sale_year", "sale_month", "sale_yearmonth"),
        "total_orders",
        "unique_customers",
        "delivered_orders",
        "canceled_orders",
        round2(revenue).alias("total_revenue"),
        round2(F.try_divide(revenue, F.col("paid_orders"))).alias("avg_order_value"),
        round2(F.col("max_order_value")).alias("max_order_value"),
        round2(
            F.try_divide(from_units(F.col("score_units")), F.col("scored_orders"))
        ).alias("avg_review_score"),
        percent(F.col("canceled_orders"), orders).alias("cancellation_rate_pct"),
        percent(F.col("delivered_orders"), orders).alias("delivery_rate_pct"),
        round2(F.try_divide(revenue, F.col("unique_customers"))).alias(
            "revenue_per_customer"
        ),
    )
