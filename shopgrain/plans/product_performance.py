"""One row per product: size bands, sales, freight, reviews and tier."""

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
from shopgrain.operators.joins import order_context

REVIEW_COUNTS = [
    "total_reviews",
    "positive_reviews",
    "neutral_reviews",
    "negative_reviews",
]


def product_totals(
    items: DataFrame, orders: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Sales per product at item grain.

    Status counts and review figures weigh an order once per item of it, the
    order count does not.  Items move once, to a join that can split a busy
    order id, and are combined per product before they move again.  Distinct
    orders and sellers need no order row and are counted apart, each over two
    narrow columns: in one aggregate with the sums they would keep all of them
    for every (product, order) pair in memory.
    """
    price, freight = F.col("price"), F.col("freight_value")
    sold = items.where(F.col("product_id").isNotNull())
    distinct_orders = sold.groupBy("product_id").agg(
        F.count_distinct("order_id").alias("total_orders")
    )
    sellers = sold.groupBy("product_id").agg(
        F.count_distinct("seller_id").alias("unique_sellers")
    )
    sales = (
        sold.select(
            "product_id", "order_id", "order_item_id", "price", "freight_value"
        )
        .join(order_context(orders, reviews), "order_id", "left")
        .groupBy("product_id")
        .agg(
            F.count("order_item_id").alias("total_units_sold"),
            round2(amount_sum(price)).alias("total_revenue"),
            round2(amount_avg(price)).alias("avg_price"),
            round2(F.min(price)).alias("min_price"),
            round2(F.max(price)).alias("max_price"),
            round2(amount_sum(freight)).alias("total_freight"),
            round2(amount_avg(freight)).alias("avg_freight"),
            round2(amount_avg(F.col("avg_review_score"))).alias("avg_review_score"),
            *[F.sum(c).alias(c) for c in REVIEW_COUNTS],
            F.count_if("is_delivered").alias("delivered_orders"),
            F.count_if("is_canceled").alias("canceled_orders"),
        )
    )
    return sales.join(distinct_orders, "product_id", "left").join(sellers, "product_id", "left")


def product_performance(tables: Mapping[str, DataFrame]) -> DataFrame:
    totals = product_totals(
        tables["order_items"], tables["orders"], tables["order_reviews"]
    )
    revenue = or_zero(F.col("total_revenue"), "double")
    avg_price = or_zero(F.col("avg_price"), "double")
    avg_freight = or_zero(F.col("avg_freight"), "double")
    counts = ["total_orders", "total_units_sold", "unique_sellers"]
    return (
        tables["products"]
        .join(totals, "product_id", "left")
        .select(
            "product_id",
            "product_category_name",
            "product_weight_gr",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
            "product_volume_cm3",
            labels.weight_bucket(F.col("product_weight_gr")).alias("weight_bucket"),
            labels.size_bucket(F.col("product_volume_cm3")).alias("size_bucket"),
            *[or_zero(F.col(c)).alias(c) for c in counts],
            revenue.alias("total_revenue"),
            avg_price.alias("avg_price"),
            or_zero(F.col("min_price"), "double").alias("min_price"),
            or_zero(F.col("max_price"), "double").alias("max_price"),
            or_zero(F.col("total_freight"), "double").alias("total_freight"),
            avg_freight.alias("avg_freight"),
            percent(avg_freight, avg_price).alias("freight_to_price_pct"),
            "avg_review_score",
            *[or_zero(F.col(c)).alias(c) for c in REVIEW_COUNTS],
            or_zero(F.col("delivered_orders")).alias("delivered_orders"),
            or_zero(F.col("canceled_orders")).alias("canceled_orders"),
            percent(
                or_zero(F.col("canceled_orders")),
                F.coalesce(F.col("total_orders"), F.lit(1)),
            ).alias("cancellation_rate_pct"),
            labels.product_tier(revenue).alias("product_tier"),
            "etl_timestamp",
        )
    )
