"""Order-level building blocks shared by the reports.

Each returns one row per order (or postal code), so a join to it never fans
out.  A report picks the columns it needs; Catalyst drops the other aggregates,
the exact distinct counts included.  All are plain hash or sort aggregates with
map-side partial results: an order id that holds a third of the rows leaves
each map task as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import dates, labels
from shopgrain.functions.numbers import (
    amount_avg,
    amount_sum,
    coordinate_avg,
    round2,
)


def primary_payment_type() -> Column:
    """Type of the largest payment of a group, as a plain aggregate.

    Missing amounts come last but still yield a type; ties go to the lowest
    sequence number, then type.
    """
    amount = F.col("payment_value")
    rank = F.struct(
        amount.isNull(), -amount, "payment_sequential", "payment_type"
    )
    return F.min_by("payment_type", rank)


def payment_totals(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        round2(amount_sum(F.col("payment_value"))).alias("total_payment_value"),
        F.max("payment_installments").alias("max_installments"),
        primary_payment_type().alias("primary_payment_type"),
        F.count("payment_sequential").alias("payment_parts_count"),
    )


def item_totals(items: DataFrame) -> DataFrame:
    """Item figures of each known order id.

    Two exact distinct counts in one aggregate would make Spark copy every row
    three times.  Each gets an aggregate of its own instead: the sellers are
    counted over two narrow columns and joined back where both sides already
    lie by order.  A report without that count loses the join as well.
    """
    known = items.where(F.col("order_id").isNotNull())
    sellers = known.groupBy("order_id").agg(
        F.count_distinct("seller_id").alias("unique_sellers")
    )
    figures = known.groupBy("order_id").agg(
        F.count("order_item_id").alias("total_items"),
        F.count_distinct("product_id").alias("unique_products"),
        round2(amount_sum(F.col("price"))).alias("items_subtotal"),
        round2(amount_sum(F.col("freight_value"))).alias("freight_total"),
        round2(amount_sum(F.col("total_item_value"))).alias("order_gmv"),
    )
    return figures.join(sellers, "order_id", "left")


def review_totals(reviews: DataFrame) -> DataFrame:
    score = F.col("review_score")
    return reviews.groupBy("order_id").agg(
        round2(F.avg(score)).alias("avg_review_score"),
        F.count("review_id").alias("total_reviews"),
        F.count_if(score >= 4).alias("positive_reviews"),
        F.count_if(score == 3).alias("neutral_reviews"),
        F.count_if(score <= 2).alias("negative_reviews"),
    )


def seller_order_totals(items: DataFrame) -> DataFrame:
    """What one seller sold within one order."""
    return items.groupBy("seller_id", "order_id").agg(
        F.count("order_item_id").alias("items_in_order"),
        round2(amount_sum(F.col("price"))).alias("order_revenue"),
        round2(amount_sum(F.col("freight_value"))).alias("order_freight"),
        round2(amount_avg(F.col("price"))).alias("avg_item_price"),
    )


def postal_centres(geolocations: DataFrame, *within: str) -> DataFrame:
    """Mean coordinates per postal code, or per code and `within`."""
    return geolocations.groupBy("geo_postal_code", *within).agg(
        coordinate_avg(F.col("geo_lat")).alias("geo_lat"),
        coordinate_avg(F.col("geo_lon")).alias("geo_lon"),
    )


def order_facts(orders: DataFrame, *keep: str) -> DataFrame:
    """Status flags and delivery figures of each order row.

    The flags are NULL where the status is; a count of them is then the same
    as with FALSE.
    """
    status = F.col("order_status")
    return orders.select(
        "order_id",
        *keep,
        labels.is_delivered(status).alias("is_delivered"),
        labels.is_canceled(status).alias("is_canceled"),
        dates.delivery_delay_days().alias("delivery_delay_days"),
        dates.shipping_days().alias("shipping_days"),
    )
