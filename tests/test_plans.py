"""What the plans look like: scans, pruning, shuffles, hot keys."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from shopgrain.operators import clean, load, rollups
from shopgrain.operators.joins import with_coordinates
from shopgrain.plans import REPORTS
from shopgrain.schemas import TABLES
from shopgrain.sources.testdata import SalesTables
from shopgrain.session import RUNTIME_SETTINGS

QUERIES = entry_points.queries()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan as adapted at run time."""
    df.collect()
    return plan_of(df)


def exchanges(plan):
    return len(re.findall(r"Exchange (?:hash|range|Single|Round)", plan))


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return SalesTables(spark, sf_dir)


@pytest.mark.parametrize("name", REPORTS)
def test_no_python_and_no_cross_join(tables, name):
    plan = plan_of(REPORTS[name](tables))
    for bad in ("Python", "Pandas", "Cartesian", "NestedLoop"):
        assert bad not in plan


def test_scan_reads_only_needed_columns(spark, sf_dir):
    plan = plan_of(QUERIES["payment_analysis"](spark, sf_dir))
    schema = re.search(r"FileScan parquet \[o_[^\]]*\]", plan).group()
    assert "o_totalprice" not in schema and "o_orderpriority" not in schema


@pytest.mark.parametrize("name", REPORTS)
def test_no_report_copies_rows_for_distinct_counts(tables, name):
    assert "Expand" not in plan_of(REPORTS[name](tables))


def test_unused_distinct_counts_vanish(tables):
    """The daily report shares the item roll-up but needs no distinct of it."""
    daily = plan_of(REPORTS["daily_sales_performance"](tables))
    summary = plan_of(REPORTS["order_summary"](tables))
    assert daily.count("lineitem.parquet") == 2
    assert summary.count("lineitem.parquet") == 3


def test_filter_on_a_day_prunes_directories(spark, tmp_path, make):
    import datetime as dt

    path = str(tmp_path / "orders")
    rows = [
        {"order_id": str(i), "sale_date": dt.date(2020, 1, 1 + i % 5), "order_status": "x"}
        for i in range(20)
    ]
    load.load_fact(spark, TABLES["orders"], path, make("orders", *rows))
    stored = {name: make(name) for name in TABLES}
    stored["orders"] = load.read_fact(spark, TABLES["orders"], path)
    report = REPORTS["daily_sales_performance"](stored).where("sale_date = DATE'2020-01-02'")
    plan = plan_of(report)
    scan = plan[plan.index("PartitionFilters"):]
    assert "2020-01-02" in scan[: scan.index("PushedFilters")] or "18263" in scan[:300]
    assert report.first().total_orders == 4


def test_key_filter_reaches_both_sides(tables):
    one = REPORTS["order_summary"](tables).where("customer_trx_id = '7'")
    assert "PushedFilters" in plan_of(one)


def test_small_coordinates_are_broadcast_by_size(spark, tables):
    plan = final_plan(REPORTS["customer_profile"](tables))
    assert "BroadcastHashJoin" in plan


def test_joins_on_order_id_share_one_partitioning(spark, tables):
    """Three inputs, three shuffles on order_id, two more for the distincts."""
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = plan_of(REPORTS["daily_sales_performance"](tables))
        # orders, payments, items; then per day, then the final order.
        assert exchanges(plan) == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skew_settings(spark):
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k in SKEW:
        spark.conf.unset(k)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture
def hot(tables, spark):
    """A third of items, payments and reviews on one order id, and one
    customer behind a third of the orders."""
    out = {name: df for name, df in tables.everything().items()}
    for name in ("order_items", "order_payments", "order_reviews"):
        df = out[name]
        turn = F.xxhash64(*df.columns) % 3 == 0
        key = F.when(turn, F.lit("NA")).otherwise(F.col("order_id"))
        out[name] = df.withColumn("order_id", key).repartition(6)
    orders = out["orders"]
    turn = F.xxhash64("order_id") % 3 == 0
    orders = orders.withColumn(
        "customer_trx_id", F.when(turn, F.lit("NA")).otherwise(F.col("customer_trx_id"))
    )
    guest = orders.limit(1).withColumn("order_id", F.lit("NA"))
    out["orders"] = orders.unionByName(guest).repartition(6)
    return out


@pytest.mark.parametrize("name", ["payment_analysis", "product_performance", "review_sentiment"])
def test_hot_order_is_split(spark, hot, skew_settings, name):
    assert "skew=true" in final_plan(REPORTS[name](hot))


def test_hot_order_of_many_sellers_is_split(spark, hot, skew_settings):
    many = hot["order_items"].withColumn("seller_id", F.concat(F.lit("s"), F.monotonically_increasing_id()))
    plan = final_plan(REPORTS["seller_performance"]({**hot, "order_items": many}))
    assert "skew=true" in plan


def test_hot_order_is_split_at_load(spark, hot, skew_settings):
    staged = hot["order_items"].drop("sale_date")
    assert "skew=true" in final_plan(load.with_sale_date(staged, hot["orders"]))
    plan = final_plan(load.fact_batch(TABLES["order_items"], staged, hot["orders"]))
    assert "skew=true" in plan
    few = hot["order_items"].select("order_id", "price")
    assert "skew=true" in final_plan(clean.flag_orphans(few, hot["orders"], "order_id"))


def test_hot_postal_code_is_split(spark, hot, skew_settings):
    wide = hot["order_items"].withColumnRenamed("order_id", "customer_postal_code")
    plan = final_plan(with_coordinates(wide, "customer_postal_code", hot["geolocations"]))
    assert "skew=true" in plan


@pytest.mark.parametrize("name", REPORTS)
def test_hot_keys_do_not_change_results(spark, hot, name):
    cached = {n: df.cache() for n, df in hot.items()}
    try:
        plain = sorted(map(repr, REPORTS[name](cached).collect()))
        for k, v in SKEW.items():
            spark.conf.set(k, v)
        split = sorted(map(repr, REPORTS[name](cached).collect()))
    finally:
        for k in SKEW:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        for df in cached.values():
            df.unpersist()
    assert plain == split


def test_hot_order_leaves_each_task_as_one_row(spark, hot, skew_settings):
    """Roll-ups combine before the shuffle: few rows of the hot key move."""
    df = rollups.payment_totals(hot["order_payments"])
    assert plan_of(df).count("partial_sum") >= 1
    below = plan_of(df).split("Exchange hashpartitioning")[1]
    assert "Aggregate" in below


def test_settings_are_applied(spark):
    for key, value in RUNTIME_SETTINGS.items():
        assert spark.conf.get(key) == value


def test_no_sums_are_kept_per_product_and_order(tables):
    """An exact distinct beside the sums would hold all of them for every pair (F9)."""
    for keys in re.findall(r"HashAggregate\(keys=\[([^\]]*)\], functions=\[[^\]]*sum\(", plan_of(REPORTS["product_performance"](tables))):
        assert not ("product_id" in keys and "order_id" in keys)


def test_seller_orders_are_counted_without_a_distinct(tables):
    """The pairs are distinct already; a distinct would keep their sums twice more (F11)."""
    plan = plan_of(REPORTS["seller_performance"](tables))
    assert "distinct" not in plan
    # by pair: partial and final
    assert len(re.findall(r"HashAggregate\(keys=\[seller_id#\d+, order_id#\d+", plan)) == 2


@pytest.mark.parametrize("name", ["product_performance", "seller_performance"])
def test_an_order_there_twice_counts_once(star, name):
    items = [
        {"order_id": o, "order_item_id": n, "product_id": "p", "seller_id": "s", "price": 2.0, "freight_value": 1.0}
        for o, n in [("1", 1), ("1", 2), ("2", 1), ("3", 1), (None, 1)]
    ]
    orders = [{"order_id": o, "order_status": "delivered"} for o in ("1", "1", "2")]
    tables = star(
        order_items=items, orders=orders, products=[{"product_id": "p"}], sellers=[{"seller_id": "s"}],
        order_reviews=[{"review_id": "r", "order_id": "3", "review_score": 5}],
    )
    assert REPORTS[name](tables).first().total_orders == 3
