"""Typing and derived columns of each table, after the shared cleaning.

Each function is one projection (geolocations also picks one row per postal
code), so cleaning a table is a single scan.  A value that does not parse
becomes NULL, as the cleaned data still holds the 'NA' mark in any column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.functions.labels import review_sentiment
from shopgrain.functions.numbers import round_cells
from shopgrain.operators.clean import NULL_MARK
from shopgrain.operators.dedup import first_per_key

POSTAL_WIDTH = 5


def whole_number(c: Column) -> Column:
    """Integer from text; a decimal tail is cut, other text gives NULL.

    The digits are picked out first: a failing cast of text to an integer is
    an exception inside, far dearer than the match.
    """
    digits = F.regexp_extract(c, r"^\s*([+-]?\d+)(\.\d*)?\s*$", 1)
    # Decimals alone are a number below one; a lone point is none.
    # They are looked for only where no digits were found.
    below_one = F.when(c.rlike(r"^\s*[+-]?\.\d+\s*$"), 0)
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("int"), below_one)


def _parsed(c: Column, kind: str) -> Column:
    """Typed value or NULL; the usual 'NA' is set aside before the cast, as a
    cast that fails is slow."""
    return F.nullif(c, F.lit(NULL_MARK)).try_cast(kind)


def number(c: Column) -> Column:
    return _parsed(c, "double")


def instant(c: Column) -> Column:
    return _parsed(c, "timestamp")


def day(c: Column) -> Column:
    return _parsed(c, "date")


def postal_code(c: Column) -> Column:
    """Text of five characters with leading zeros; longer codes are cut."""
    return F.lpad(c.cast("string"), POSTAL_WIDTH, "0")


def title(c: Column) -> Column:
    return F.initcap(F.lower(F.trim(c)))


def lower(c: Column) -> Column:
    return F.lower(F.trim(c))


def upper(c: Column) -> Column:
    return F.upper(F.trim(c))


def _rewrite(df: DataFrame, rules: dict[str, Callable]) -> DataFrame:
    """Apply a rule to each named column in place, in one projection."""
    return df.select(
        [rules[c](F.col(c)).alias(c) if c in rules else F.col(c)
         for c in df.columns]
    )


def customers(df: DataFrame) -> DataFrame:
    return _rewrite(df, {
        "customer_postal_code": postal_code,
        "subscribe_date": day,
        "first_order_date": day,
        "age": whole_number,
        "customer_city": title,
        "customer_country": upper,
        "gender": title,
    })


def sellers(df: DataFrame) -> DataFrame:
    return _rewrite(df, {
        "seller_postal_code": postal_code,
        "seller_city": title,
        "seller_country": upper,
        "country_code": upper,
    })


def products(df: DataFrame) -> DataFrame:
    sides = ["product_length_cm", "product_height_cm", "product_width_cm"]
    typed = _rewrite(df, {
        "product_category_name": lower,
        "product_weight_gr": number,
        **dict.fromkeys(sides, number),
    })
    length, height, width = map(F.col, sides)
    return typed.withColumn(
        "product_volume_cm3", round_cells(length * height * width)
    )


def geolocations(df: DataFrame, pad: bool = False) -> DataFrame:
    """One row per postal code: the lowest by coordinates, city, country.

    Codes stay as written unless `pad`, so an unpadded code does not meet the
    padded ones of customers and sellers.
    """
    rules = {
        "geo_lat": number,
        "geo_lon": number,
        "geolocation_city": title,
        "geo_country": upper,
    }
    if pad:
        rules["geo_postal_code"] = postal_code
    order = ["geo_lat", "geo_lon", "geolocation_city", "geo_country"]
    return first_per_key(
        _rewrite(df, rules),
        ["geo_postal_code"],
        [F.col(c).asc_nulls_last() for c in order],
    )


def orders(df: DataFrame) -> DataFrame:
    stamps = [
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ]
    return _rewrite(
        df, {"order_status": lower, **dict.fromkeys(stamps, instant)}
    )


def order_items(df: DataFrame) -> DataFrame:
    typed = _rewrite(df, {
        "price": number,
        "freight_value": number,
        "order_item_id": whole_number,
        "shipping_limit_date": instant,
    })
    return typed.withColumn(
        "total_item_value", round_cells(F.col("price") + F.col("freight_value"))
    )


def order_payments(df: DataFrame) -> DataFrame:
    return _rewrite(df, {
        "payment_sequential": whole_number,
        "payment_installments": whole_number,
        "payment_value": number,
        "payment_type": lower,
    })


def order_reviews(df: DataFrame) -> DataFrame:
    typed = _rewrite(df, {
        "review_score": whole_number,
        "review_creation_date": instant,
        "review_answer_timestamp": instant,
    })
    return typed.withColumn(
        "review_sentiment", review_sentiment(F.col("review_score"))
    )


CONFORM: dict[str, Callable[[DataFrame], DataFrame]] = {
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "customers": customers,
    "sellers": sellers,
    "products": products,
    "geolocations": geolocations,
}
