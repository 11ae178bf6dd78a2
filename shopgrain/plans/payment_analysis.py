"""Payment types per month: volume, installments, share of the month."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.functions import dates, labels
from shopgrain.functions.numbers import (
    amount_avg,
    from_units,
    not_finite,
    percent,
    round2,
    units,
)


def monthly_payment_types(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payments per type and month of sale, before labels and shares.

    `value_units` is the exact sum, kept whole for the share of the month;
    `value_odd` holds what is infinite or no number.
    """
    status = F.col("order_status")
    months = orders.select(
        "order_id",
        dates.month_start(F.col("sale_date")).alias("month"),
        labels.is_delivered(status).alias("is_delivered"),
        labels.is_canceled(status).alias("is_canceled"),
    )
    value, parts = F.col("payment_value"), F.col("payment_installments")
    return (
        payments.select(
            "order_id", "payment_type", "payment_sequential",
            "payment_installments", "payment_value",
        )
        .join(months, "order_id", "left")
        .groupBy("payment_type", "month")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.count("payment_sequential").alias("total_payment_parts"),
            F.sum(units(value)).alias("value_units"),
            F.sum(not_finite(value)).alias("value_odd"),
            round2(amount_avg(value)).alias("avg_payment_value"),
            round2(F.min(value)).alias("min_payment_value"),
            round2(F.max(value)).alias("max_payment_value"),
            round2(F.avg(parts)).alias("avg_installments"),
            F.max(parts).alias("max_installments"),
            F.count_if(parts > 1).alias("installment_orders"),
            F.count_if(parts == 1).alias("single_payment_orders"),
            F.count_if("is_delivered").alias("delivered_orders"),
            F.count_if("is_canceled").alias("canceled_orders"),
        )
    )


def month_total() -> Column:
    """Revenue of the row's month, rounded; NULL where the month is unknown.

    Taken over the grouped rows, a handful per month, so neither the payments
    nor the join is repeated.
    """
    month = Window.partitionBy("month")
    whole = from_units(F.sum("value_units").over(month), F.sum("value_odd").over(month))
    return F.when(F.col("month").isNotNull(), round2(whole))


def payment_analysis(tables: Mapping[str, DataFrame]) -> DataFrame:
    value = from_units(F.col("value_units"), F.col("value_odd"))
    return (
        monthly_payment_types(tables["order_payments"], tables["orders"])
        .withColumn("month_total", month_total())
        .select(
            "payment_type",
            *dates.calendar(
                F.col("month"), "sale_year", "sale_month", "sale_yearmonth"
            ),
            "total_orders",
            "total_payment_parts",
            round2(value).alias("total_payment_value"),
            "avg_payment_value",
            "min_payment_value",
            "max_payment_value",
            "avg_installments",
            "max_installments",
            "installment_orders",
            "single_payment_orders",
            "delivered_orders",
            "canceled_orders",
            percent(value, F.col("month_total")).alias("pct_of_monthly_revenue"),
            percent(F.col("installment_orders"), F.col("total_orders")).alias(
                "installment_usage_pct"
            ),
        )
        .orderBy("sale_yearmonth", F.col("total_payment_value").desc())
    )
