"""One row per customer: demographics, place, lifetime value and segment."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import labels
from shopgrain.functions.numbers import amount_avg, amount_sum, or_zero, round2
from shopgrain.operators.joins import with_coordinates
from shopgrain.operators.rollups import order_facts, payment_totals


def customer_totals(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Purchase figures per customer; one customer may hold many orders."""
    paid = F.col("total_payment_value")
    return (
        order_facts(orders, "customer_trx_id", "sale_date")
        .join(payment_totals(payments), "order_id", "left")
        .groupBy("customer_trx_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            round2(amount_sum(paid)).alias("lifetime_value"),
            round2(amount_avg(paid)).alias("avg_order_value"),
            round2(F.max(paid)).alias("max_order_value"),
            round2(F.min(paid)).alias("min_order_value"),
            F.min("sale_date").alias("first_purchase_date"),
            F.max("sale_date").alias("last_purchase_date"),
            F.count_if("is_delivered").alias("delivered_orders"),
            F.count_if("is_canceled").alias("canceled_orders"),
            round2(F.avg("delivery_delay_days")).alias("avg_delivery_delay_days"),
        )
    )


def customer_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    tenure = F.datediff("last_purchase_date", "first_purchase_date")
    value = or_zero(F.col("lifetime_value"), "double")
    amounts = ["avg_order_value", "max_order_value", "min_order_value"]
    profiles = tables["customers"].join(
        customer_totals(tables["orders"], tables["order_payments"]),
        "customer_trx_id",
        "left",
    )
    return (
        with_coordinates(profiles, "customer_postal_code", tables["geolocations"])
        .select(
            "customer_trx_id",
            "subscriber_id",
            "age",
            "gender",
            labels.age_group(F.col("age")).alias("age_group"),
            "subscribe_date",
            "first_order_date",
            "customer_postal_code",
            "customer_city",
            "customer_country",
            "customer_country_code",
            "geo_lat",
            "geo_lon",
            or_zero(F.col("total_orders")).alias("total_orders"),
            value.alias("lifetime_value"),
            *[or_zero(F.col(c), "double").alias(c) for c in amounts],
            "first_purchase_date",
            "last_purchase_date",
            or_zero(tenure.cast("long")).alias("customer_tenure_days"),
            or_zero(F.col("delivered_orders")).alias("delivered_orders"),
            or_zero(F.col("canceled_orders")).alias("canceled_orders"),
            or_zero(F.col("avg_delivery_delay_days"), "double").alias(
                "avg_delivery_delay_days"
            ),
            labels.customer_segment(value).alias("customer_segment"),
            "etl_timestamp",
        )
    )
