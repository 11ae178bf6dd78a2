"""The eight reports by name, and their registration as views."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from shopgrain.plans.customer_profile import customer_profile
from shopgrain.plans.daily_sales_performance import daily_sales_performance
from shopgrain.plans.geo_sales_heatmap import geo_sales_heatmap
from shopgrain.plans.order_summary import order_summary
from shopgrain.plans.payment_analysis import payment_analysis
from shopgrain.plans.product_performance import product_performance
from shopgrain.plans.review_sentiment import review_sentiment
from shopgrain.plans.seller_performance import seller_performance

Report = Callable[[Mapping[str, DataFrame]], DataFrame]

REPORTS: dict[str, Report] = {
    "order_summary": order_summary,
    "daily_sales_performance": daily_sales_performance,
    "customer_profile": customer_profile,
    "seller_performance": seller_performance,
    "product_performance": product_performance,
    "payment_analysis": payment_analysis,
    "review_sentiment": review_sentiment,
    "geo_sales_heatmap": geo_sales_heatmap,
}


def register_views(
    tables: Mapping[str, DataFrame], prefix: str = "vw_"
) -> list[str]:
    """Make each report a temporary view; nothing runs until one is read."""
    names = []
    for name, report in REPORTS.items():
        report(tables).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
