"""Orders, revenue and delivery per day of sale."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import dates
from shopgrain.functions.numbers import amount_avg, amount_sum, percent, round2
from shopgrain.operators.rollups import item_totals, order_facts, payment_totals


def daily_sales_performance(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Grouped by the day alone, as its calendar parts follow from it.

    The distinct count starts inside the partitions left by the joins on
    order_id, so only per-day partial sums cross the last shuffle.
    """
    paid = F.col("total_payment_value")
    pending = (
        F.col("total_orders") - F.col("delivered_orders") - F.col("canceled_orders")
    )
    daily = (
        order_facts(tables["orders"], "sale_date")
        .join(payment_totals(tables["order_payments"]), "order_id", "left")
        .join(item_totals(tables["order_items"]), "order_id", "left")
        .groupBy("sale_date")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.count_if("is_delivered").alias("delivered_orders"),
            F.count_if("is_canceled").alias("canceled_orders"),
            round2(amount_sum(paid)).alias("daily_revenue"),
            round2(amount_avg(paid)).alias("avg_order_value"),
            round2(amount_sum(F.col("order_gmv"))).alias("daily_gmv"),
            round2(amount_sum(F.col("freight_total"))).alias("daily_freight"),
            F.sum("total_items").cast("double").alias("total_items_sold"),
            round2(F.avg("delivery_delay_days")).alias("avg_delivery_delay_days"),
            round2(F.avg("shipping_days")).alias("avg_shipping_days"),
        )
    )
    return daily.select(
        "sale_date",
        *dates.calendar(
            F.col("sale_date"),
            "sale_year", "sale_month", "sale_day_name", "sale_yearmonth",
        ),
        "total_orders",
        "delivered_orders",
        "canceled_orders",
        pending.alias("pending_orders"),
        "daily_revenue",
        "avg_order_value",
        "daily_gmv",
        "daily_freight",
        "total_items_sold",
        "avg_delivery_delay_days",
        "avg_shipping_days",
        percent(F.col("canceled_orders"), F.col("total_orders")).alias(
            "cancellation_rate_pct"
        ),
    ).orderBy("sale_date")
