"""One row per order: status, delivery, payment and item figures."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import dates, labels
from shopgrain.functions.numbers import or_zero, round2
from shopgrain.operators.rollups import item_totals, payment_totals

TIMESTAMPS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]
PAYMENT_FIGURES = [
    "total_payment_value",
    "max_installments",
    "primary_payment_type",
    "payment_parts_count",
]
ITEM_FIGURES = [
    "total_items",
    "unique_products",
    "unique_sellers",
    "items_subtotal",
    "freight_total",
    "order_gmv",
]


def order_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All three inputs meet on order_id; items are read twice, once for the sellers."""
    status = F.col("order_status")
    paid = or_zero(F.col("total_payment_value"), "double")
    sold = or_zero(F.col("order_gmv"), "double")
    return (
        tables["orders"]
        .join(payment_totals(tables["order_payments"]), "order_id", "left")
        .join(item_totals(tables["order_items"]), "order_id", "left")
        .select(
            "order_id",
            "customer_trx_id",
            "order_status",
            *TIMESTAMPS,
            "sale_date",
            *dates.calendar(F.col("sale_date")),
            labels.flag(labels.is_delivered(status)).alias("is_delivered"),
            labels.flag(labels.is_canceled(status)).alias("is_canceled"),
            labels.flag(labels.is_in_transit(status)).alias("is_in_transit"),
            dates.delivery_delay_days().alias("delivery_delay_days"),
            dates.shipping_days().alias("shipping_days"),
            dates.order_cycle_days().alias("order_cycle_days"),
            *PAYMENT_FIGURES,
            *ITEM_FIGURES,
            round2(F.abs(paid - sold)).alias("payment_vs_gmv_diff"),
            "etl_timestamp",
        )
    )


def order_columns(orders: DataFrame) -> DataFrame:
    """The orders table with its own derived columns, no other input."""
    status = F.col("order_status")
    return orders.select(
        "*",
        *dates.calendar(F.col("sale_date")),
        labels.flag(labels.is_delivered(status)).alias("is_delivered"),
        labels.flag(labels.is_canceled(status)).alias("is_canceled"),
        dates.delivery_delay_days().alias("delivery_delay_days"),
        dates.shipping_days().alias("shipping_days"),
        dates.order_cycle_days().alias("order_cycle_days"),
    )
