"""Named bands, one function each, and the order and review flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Report labels with their bounds, first match wins.
AGE_GROUPS = [
    (25, "Gen Z (< 25)"),
    (35, "Millennial (25-34)"),
    (45, "Gen X (35-44)"),
    (55, "Boomer (45-54)"),
]
AGE_OLDEST = "Senior (55+)"
AGE_UNKNOWN = "Unknown"
WEIGHT_BUCKETS = [
    (500, "Light (< 500g)"),
    (2000, "Medium (500g-2kg)"),
    (5000, "Heavy (2kg-5kg)"),
]
WEIGHT_REST = "Very Heavy (5kg+)"
SIZE_BUCKETS = [(1000, "Small"), (5000, "Medium"), (20000, "Large")]
SIZE_REST = "Extra Large"
CUSTOMER_SEGMENTS = [
    (1000, "High Value"),
    (500, "Mid Value"),
    (100, "Low Value"),
]
CUSTOMER_REST = "Inactive"
PRODUCT_TIERS = [
    (10000, "Top Seller"),
    (1000, "Good Seller"),
    (100, "Low Seller"),
]
PRODUCT_REST = "No Sales"
SELLER_TIERS = [(50000, "Platinum"), (10000, "Gold"), (1000, "Silver")]
SELLER_REST = "Bronze"
STARS = {
    5: "⭐⭐⭐⭐⭐ Excellent",
    4: "⭐⭐⭐⭐ Good",
    3: "⭐⭐⭐ Average",
    2: "⭐⭐ Poor",
    1: "⭐ Very Poor",
}
NO_STARS = "No Rating"


def _below(c: Column, bands: list[tuple[int, str]], rest: str) -> Column:
    """First band whose bound lies above `c`; NULL falls to `rest`."""
    out = F.when(c < bands[0][0], bands[0][1])
    for bound, label in bands[1:]:
        out = out.when(c < bound, label)
    return out.otherwise(rest)


def _from(c: Column, bands: list[tuple[int, str]], rest: str) -> Column:
    """First band whose bound `c` reaches; NULL falls to `rest`."""
    out = F.when(c >= bands[0][0], bands[0][1])
    for bound, label in bands[1:]:
        out = out.when(c >= bound, label)
    return out.otherwise(rest)


def age_group(age: Column) -> Column:
    known = _below(age, AGE_GROUPS, AGE_OLDEST)
    return F.when(age.isNull(), AGE_UNKNOWN).otherwise(known)


def weight_bucket(grams: Column) -> Column:
    return _below(grams, WEIGHT_BUCKETS, WEIGHT_REST)


def size_bucket(cm3: Column) -> Column:
    return _below(cm3, SIZE_BUCKETS, SIZE_REST)


def customer_segment(lifetime_value: Column) -> Column:
    return _from(lifetime_value, CUSTOMER_SEGMENTS, CUSTOMER_REST)


def product_tier(revenue: Column) -> Column:
    return _from(revenue, PRODUCT_TIERS, PRODUCT_REST)


def seller_tier(revenue: Column) -> Column:
    return _from(revenue, SELLER_TIERS, SELLER_REST)


def sentiment_bucket(score: Column) -> Column:
    """Title-case sentiment; a missing score counts as negative."""
    return (
        F.when(score >= 4, "Positive")
        .when(score == 3, "Neutral")
        .otherwise("Negative")
    )


def review_sentiment(score: Column) -> Column:
    """The lower-case form stored with the review at cleaning."""
    return F.lower(sentiment_bucket(score))


def star_label(score: Column) -> Column:
    out = None
    for value, label in STARS.items():
        hit = score == value
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(NO_STARS)


def is_delivered(status: Column) -> Column:
    """NULL for a missing status; wrap in `flag` where FALSE is wanted."""
    return status == "delivered"


def is_canceled(status: Column) -> Column:
    return status == "canceled"


def is_in_transit(status: Column) -> Column:
    return status.isin("shipped", "out_for_delivery")


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def is_late_and_unhappy(delay: Column, score: Column) -> Column:
    return flag((F.coalesce(delay, F.lit(0)) > 0) & (score <= 2))


def is_early_and_happy(delay: Column, score: Column) -> Column:
    return flag((F.coalesce(delay, F.lit(0)) < 0) & (score >= 4))
