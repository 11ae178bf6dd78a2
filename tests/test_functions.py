import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from shopgrain.functions import dates, labels, numbers


def _map(spark, fn, values, kind="double"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r.y for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def test_round2(spark):
    values = [0.125, -0.125, 2.5, 1.005, -1.0, 0.0, -0.001, None, 12345.678]
    got = _map(spark, numbers.round2, values)
    assert got == [0.13, -0.13, 2.5, 1.0, -1.0, 0.0, 0.0, None, 12345.68]
    assert math.copysign(1, got[6]) == 1.0


def test_sums_do_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9 + 0.01, -1e9, 0.07] * 50
    out = set()
    for n in (1, 3, 7):
        df = spark.createDataFrame([(v,) for v in values[::-1 if n == 3 else 1]], "x double")
        df = df.repartition(n)
        row = df.agg(
            numbers.amount_sum(F.col("x")).alias("s"),
            numbers.amount_avg(F.col("x")).alias("a"),
        ).first()
        out.add((row.s, row.a))
    assert len(out) == 1
    assert out.pop()[0] == 34.0


def test_sum_and_mean_of_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    row = df.agg(
        numbers.amount_sum(F.col("x")).alias("s"), numbers.amount_avg(F.col("x")).alias("a")
    ).first()
    assert (row.s, row.a) == (None, None)


def test_not_a_number_stays_one(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (float("inf"),)], "x double")
    row = df.agg(
        numbers.amount_sum(F.col("x")).alias("s"), numbers.amount_avg(F.col("x")).alias("a")
    ).first()
    assert math.isnan(row.s) and math.isnan(row.a)


def test_sums_are_not_cut_or_capped(spark):
    tiny = spark.range(1000).select(F.lit(0.00004).alias("x"))
    assert tiny.agg(numbers.amount_sum(F.col("x")).alias("s")).first().s == 0.04
    large = spark.createDataFrame([(8e14,)] * 4 + [(9.5e15,)], "x double")
    assert large.agg(numbers.amount_sum(F.col("x")).alias("s")).first().s == 1.27e16
    beyond = spark.createDataFrame([(1e19,)], "x double")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        beyond.agg(numbers.amount_sum(F.col("x")).alias("s")).first()
    rounded = spark.createDataFrame([(5e17,), (-5e17,), (float("inf"),)], "x double").select(numbers.round2(F.col("x")).alias("r"))
    assert [r.r for r in rounded.collect()] == [5e17, -5e17, float("inf")]


def test_coordinates_keep_all_digits(spark):
    lat = -23.545621281154637
    df = spark.createDataFrame([(lat,), (None,)], "x double")
    assert df.agg(numbers.coordinate_avg(F.col("x")).alias("m")).first().m == lat


@pytest.mark.parametrize(
    "part, whole, want", [(1, 2, 50.0), (1, 0, None), (None, 2, None), (1, None, None), (1, 3, 33.33)]
)
def test_percent(spark, part, whole, want):
    df = spark.createDataFrame([(part, whole)], "p long, w long")
    assert df.select(numbers.percent(F.col("p"), F.col("w")).alias("r")).first().r == want


def test_hours_are_cut_towards_zero(spark):
    d = dt.datetime
    rows = [
        (1, d(2020, 1, 1, 10, 59), d(2020, 1, 1, 12, 0)),
        (2, d(2020, 1, 1, 12, 0), d(2020, 1, 1, 10, 1)),
        (3, None, d(2020, 1, 1)),
    ]
    df = spark.createDataFrame(rows, "i int, a timestamp, b timestamp")
    got = df.select(dates.elapsed_hours(F.col("b"), F.col("a")).alias("h")).collect()
    assert [r.h for r in got] == [1.0, -1.0, None]


def test_day_gap_counts_calendar_days(spark):
    d = dt.datetime
    df = spark.createDataFrame(
        [(d(2020, 1, 2, 0, 5), d(2020, 1, 1, 23, 55)), (d(2020, 1, 1), None)],
        "a timestamp, b timestamp",
    )
    got = df.select(dates.day_gap(F.col("a"), F.col("b")).alias("n")).collect()
    assert [r.n for r in got] == [1, None]


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2017, 10, 2),), (None,)], "d date")
    got = [tuple(r) for r in df.select(dates.calendar(F.col("d"))).collect()]
    assert got == [(2017, 10, 2, "Monday", "2017-10"), (None,) * 5]


BANDS = [
    (labels.age_group, [24, 25, 34, 35, 44, 45, 54, 55, None],
     ["Gen Z (< 25)", "Millennial (25-34)", "Millennial (25-34)", "Gen X (35-44)", "Gen X (35-44)",
      "Boomer (45-54)", "Boomer (45-54)", "Senior (55+)", "Unknown"]),
    (labels.customer_segment, [1000, 999.99, 500, 499, 100, 99, 0, None],
     ["High Value", "Mid Value", "Mid Value", "Low Value", "Low Value", "Inactive", "Inactive", "Inactive"]),
    (labels.weight_bucket, [499, 500, 1999, 2000, 4999, 5000, None],
     ["Light (< 500g)", "Medium (500g-2kg)", "Medium (500g-2kg)", "Heavy (2kg-5kg)", "Heavy (2kg-5kg)",
      "Very Heavy (5kg+)", "Very Heavy (5kg+)"]),
    (labels.size_bucket, [999, 1000, 4999, 5000, 19999, 20000, None],
     ["Small", "Medium", "Medium", "Large", "Large", "Extra Large", "Extra Large"]),
    (labels.product_tier, [10000, 9999, 1000, 999, 100, 99, None],
     ["Top Seller", "Good Seller", "Good Seller", "Low Seller", "Low Seller", "No Sales", "No Sales"]),
    (labels.seller_tier, [50000, 49999, 10000, 9999, 1000, 999, None],
     ["Platinum", "Gold", "Gold", "Silver", "Silver", "Bronze", "Bronze"]),
    (labels.sentiment_bucket, [5, 4, 3, 2, None],
     ["Positive", "Positive", "Neutral", "Negative", "Negative"]),
    (labels.review_sentiment, [4, 3, 2, None], ["positive", "neutral", "negative", "negative"]),
    (labels.star_label, [5, 1, 6, None],
     ["⭐⭐⭐⭐⭐ Excellent", "⭐ Very Poor", "No Rating", "No Rating"]),
]


@pytest.mark.parametrize("fn, values, want", BANDS, ids=lambda v: getattr(v, "__name__", ""))
def test_bands(spark, fn, values, want):
    cast = [None if v is None else float(v) for v in values]
    assert _map(spark, fn, cast) == want


def test_order_flags(spark):
    df = spark.createDataFrame(
        [("delivered",), ("canceled",), ("shipped",), ("out_for_delivery",), (None,)], "s string"
    )
    s = F.col("s")
    got = df.select(
        labels.is_delivered(s), labels.is_canceled(s), labels.is_in_transit(s),
        labels.flag(labels.is_delivered(s)),
    ).collect()
    assert [tuple(r) for r in got] == [
        (True, False, False, True), (False, True, False, False), (False, False, True, False),
        (False, False, True, False), (None, None, None, False),
    ]


def test_delay_flags(spark):
    df = spark.createDataFrame(
        [(1, 2), (1, 3), (None, 1), (-1, 4), (-1, None), (0, 5)], "delay long, score long"
    )
    d, s = F.col("delay"), F.col("score")
    got = df.select(labels.is_late_and_unhappy(d, s), labels.is_early_and_happy(d, s)).collect()
    assert [tuple(r) for r in got] == [
        (True, False), (False, False), (False, False), (False, True), (False, False), (False, False),
    ]
