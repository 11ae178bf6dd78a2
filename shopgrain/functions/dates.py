"""Calendar parts and the day and hour differences the reports use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_gap(later: Column, earlier: Column) -> Column:
    """Whole UTC days from `earlier` to `later`; NULL if either is missing."""
    return F.datediff(F.to_date(later), F.to_date(earlier)).cast("long")


def delivery_delay_days() -> Column:
    """Positive when the parcel came after the promised day."""
    return day_gap(
        F.col("order_delivered_customer_date"),
        F.col("order_estimated_delivery_date"),
    )


def shipping_days() -> Column:
    return day_gap(
        F.col("order_delivered_customer_date"),
        F.col("order_delivered_carrier_date"),
    )


def order_cycle_days() -> Column:
    return day_gap(
        F.col("order_delivered_customer_date"),
        F.col("order_purchase_timestamp"),
    )


def elapsed_hours(later: Column, earlier: Column) -> Column:
    """Full hours between two instants, cut towards zero."""
    return F.timestamp_diff("HOUR", earlier, later).cast("double")


def month_start(day: Column) -> Column:
    """First day of the month: one small key for year, month and label."""
    return F.trunc(day, "month")


def year_of(day: Column) -> Column:
    return F.year(day).cast("long")


def month_of(day: Column) -> Column:
    return F.month(day).cast("long")


def day_of(day: Column) -> Column:
    return F.dayofmonth(day).cast("long")


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def calendar(day: Column, *parts: str) -> list[Column]:
    """The named `sale_*` columns of a day, all of them by default."""
    made = {
        "sale_year": year_of,
        "sale_month": month_of,
        "sale_day": day_of,
        "sale_day_name": weekday_name,
        "sale_yearmonth": year_month,
    }
    return [made[p](day).alias(p) for p in (parts or made)]
