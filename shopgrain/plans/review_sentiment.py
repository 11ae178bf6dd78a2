"""One row per review with the delivery and payment of its order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import dates, labels
from shopgrain.operators.joins import own_shuffle
from shopgrain.operators.rollups import order_facts, payment_totals


def review_sentiment(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Orders and payments are joined first, then each review once to both."""
    paid_orders = order_facts(
        tables["orders"], "customer_trx_id", "order_status", "sale_date"
    ).join(
        payment_totals(tables["order_payments"]).select(
            "order_id", "total_payment_value", "primary_payment_type"
        ),
        "order_id",
        "left",
    )
    reviews = tables["order_reviews"].drop("sale_date")
    score, delay = F.col("review_score"), F.col("delivery_delay_days")
    context = own_shuffle(paid_orders, "order_id")
    return reviews.join(context, "order_id", "left").select(
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title_en",
        "review_comment_message_en",
        "review_creation_date",
        "review_answer_timestamp",
        "review_sentiment",
        dates.elapsed_hours(
            F.col("review_answer_timestamp"), F.col("review_creation_date")
        ).alias("review_response_hours"),
        labels.sentiment_bucket(score).alias("sentiment_bucket"),
        labels.star_label(score).alias("star_label"),
        "customer_trx_id",
        "order_status",
        "sale_date",
        *dates.calendar(
            F.col("sale_date"), "sale_year", "sale_month", "sale_yearmonth"
        ),
        "is_delivered",
        "is_canceled",
        "delivery_delay_days",
        "shipping_days",
        labels.is_late_and_unhappy(delay, score).alias("is_late_and_unhappy"),
        labels.is_early_and_happy(delay, score).alias("is_early_and_happy"),
        "total_payment_value",
        "primary_payment_type",
        "etl_timestamp",
    )
