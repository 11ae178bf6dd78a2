"""One row per seller: revenue, reviews, delivery and tier."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import labels
from shopgrain.functions.numbers import (
    amount_avg,
    amount_sum,
    or_zero,
    percent,
    round2,
)
from shopgrain.operators.joins import order_context, with_coordinates
from shopgrain.operators.rollups import seller_order_totals


def seller_totals(
    items: DataFrame, orders: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Sales per seller over its (seller, order) pairs.

    Pairing first shrinks the items before they meet the orders, so neither a
    busy seller nor a busy order id reaches the joins as raw item rows.  A pair
    is there once, and again only for further rows of its order, so a plain
    count of first rows is the number of orders: an exact distinct count would
    keep all sums of every pair in memory twice.
    """
    first = F.coalesce(F.col("nth"), F.lit(1)) == 1
    return (
        seller_order_totals(items)
        .join(order_context(orders, reviews), "order_id", "left")
        .groupBy("seller_id")
        .agg(
            F.count(F.when(first, F.col("order_id"))).alias("total_orders"),
            F.sum("items_in_order").alias("total_items_sold"),
            round2(amount_sum(F.col("order_revenue"))).alias("total_revenue"),
            round2(amount_sum(F.col("order_freight"))).alias("total_freight"),
            round2(amount_avg(F.col("avg_item_price"))).alias("avg_item_price"),
            round2(amount_avg(F.col("avg_review_score"))).alias("avg_review_score"),
            F.sum("total_reviews").alias("total_reviews"),
            F.count_if("is_delivered").alias("delivered_orders"),
            F.count_if("is_canceled").alias("canceled_orders"),
            round2(F.avg("delivery_delay_days")).alias("avg_delivery_delay_days"),
            round2(F.avg("shipping_days")).alias("avg_shipping_days"),
        )
    )


def seller_performance(tables: Mapping[str, DataFrame]) -> DataFrame:
    totals = seller_totals(
        tables["order_items"], tables["orders"], tables["order_reviews"]
    )
    revenue = or_zero(F.col("total_revenue"), "double")
    scored = tables["sellers"].join(totals, "seller_id", "left")
    return (
        with_coordinates(scored, "seller_postal_code", tables["geolocations"])
        .select(
            "seller_id",
            "seller_name",
            "seller_city",
            "seller_country",
            "country_code",
            "seller_postal_code",
            "geo_lat",
            "geo_lon",
            or_zero(F.col("total_orders")).alias("total_orders"),
            or_zero(F.col("total_items_sold")).alias("total_items_sold"),
            revenue.alias("total_revenue"),
            or_zero(F.col("total_freight"), "double").alias("total_freight"),
            or_zero(F.col("avg_item_price"), "double").alias("avg_item_price"),
            "avg_review_score",
            or_zero(F.col("total_reviews")).alias("total_reviews"),
            or_zero(F.col("delivered_orders")).alias("delivered_orders"),
            or_zero(F.col("canceled_orders")).alias("canceled_orders"),
            "avg_delivery_delay_days",
            "avg_shipping_days",
            labels.seller_tier(revenue).alias("seller_tier"),
            percent(
                or_zero(F.col("canceled_orders")),
                F.coalesce(F.col("total_orders"), F.lit(1)),
            ).alias("cancellation_rate_pct"),
            "etl_timestamp",
        )
    )
