"""Each cleaning, loading, control and roll-up step as a query of its own.

Every step runs the library operator over whole tables derived from the given
files, so that it can be compared with SQL.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.functions import labels
from shopgrain import pipeline
from shopgrain.files import scratch_path
from shopgrain.operators import catalog, clean, conform, control, load, rollups
from shopgrain.operators.dedup import keep_latest
from shopgrain.pipeline import clean_table
from shopgrain.plans import daily_sales_performance, register_views
from shopgrain.plans.lasting import create_views
from shopgrain.plans.order_summary import order_columns
from shopgrain.schemas import LOAD_AUDIT_SCHEMA, TABLES
from shopgrain.session import configure
from shopgrain.sources import gate
from shopgrain.sources.delimited import read_delimited
from shopgrain.sources.parquet import day_path, read_staging, write_day
from shopgrain.sources.testdata import STAMP, SalesTables, as_raw_text

Step = Callable[[SparkSession, str], DataFrame]
STEPS: dict[str, Step] = {}

AUDIT_DAY = dt.date(1997, 6, 15)
NOW = dt.datetime(2024, 1, 12, tzinfo=dt.timezone.utc)
DATE_FORMATS = ["dd/MM/yyyy HH:mm", "yyyyMMdd", "MMM d, yyyy"]


def step(run: Callable[[SalesTables], DataFrame]) -> Callable:
    def over_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(SalesTables(configure(spark), sf_dir))

    STEPS[run.__name__] = over_folder
    return run


def _raw(t: SalesTables, name: str) -> DataFrame:
    source = t.geo_points() if name == "geolocations" else t[name]
    return as_raw_text(source, name)


# ------------------------------------------------------------ files in and out


def _as_file(df: DataFrame, separator: str) -> str:
    """Write text with a header as a spreadsheet export might name it."""
    path = scratch_path(df.sparkSession, "delimited")
    shown = df.toDF(*[c.replace("_", "-").title() for c in df.columns])
    shown.write.csv(
        path,
        header=True,
        sep=separator,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return path


@step
def delimited_scan(t: SalesTables) -> DataFrame:
    raw = _raw(t, "orders")
    return read_delimited(raw.sparkSession, _as_file(raw, ";"))


@step
def staging_round_trip(t: SalesTables) -> DataFrame:
    spark = t["order_payments"].sparkSession
    zone = scratch_path(spark, "processed")
    cleaned = t["order_payments"].drop("sale_date")
    write_day(cleaned, day_path(zone, "order_payments", "2024-01-01"))
    return read_staging(spark, zone, "order_payments", "2024-01-01")


@step
def files_to_daily_sales(t: SalesTables) -> DataFrame:
    """Delimited files, cleaned, staged and deduplicated, as the daily report."""
    spark = t["orders"].sparkSession
    zone, when = scratch_path(spark, "processed"), "2024-01-01"
    batches: dict[str, DataFrame] = {}
    for name in ("orders", "order_items", "order_payments"):
        table = TABLES[name]
        text = t[name].select([F.col(c).cast("string") for c in table.source_columns])
        cleaned = clean_table(spark, name, _as_file(text, "|"), at=STAMP)
        write_day(cleaned, day_path(zone, name, when))
        staged = read_staging(spark, zone, name, when)
        batches[name] = load.fact_batch(table, staged, batches.get("orders"))
    return daily_sales_performance(batches)


@step
def sql_over_views(t: SalesTables) -> DataFrame:
    """What a dashboard does: plain SQL on the registered views."""
    spark = t["orders"].sparkSession
    register_views(t)
    return spark.sql(
        "SELECT customer_country, customer_segment, count(*) AS customers,"
        " max(lifetime_value) AS best_value FROM vw_customer_profile"
        " GROUP BY customer_country, customer_segment"
    )


# ------------------------------------------------------------------- cleaning


def _with_faults(t: SalesTables, name: str) -> DataFrame:
    """Text of a table where some dates cannot be read and some keys are blank."""
    raw = _raw(t, name)
    seven = F.col(TABLES[name].key[0]).like("%7%")
    if name == "orders":
        when = F.col("order_purchase_timestamp")
        return raw.withColumn("order_purchase_timestamp", F.when(seven, F.concat(F.lit("week "), when)).otherwise(when))
    if name == "order_payments":
        key = F.col("payment_sequential")
        return raw.withColumn("payment_sequential", F.when(seven, "none").otherwise(key))
    return raw


@step
def read_report(t: SalesTables) -> DataFrame:
    """What cleaning all eight files side by side saw in its one scan of each."""
    spark = t["orders"].sparkSession
    sources = {name: _as_file(_with_faults(t, name), ";") for name in TABLES}
    reports = pipeline.clean_reports(spark, sources, scratch_path(spark, "processed"), "2024-01-01", STAMP)
    return pipeline.read_report(spark, reports)


@step
def source_check(t: SalesTables) -> DataFrame:
    """Six sources with rows, one with a header only, one that is not there."""
    spark = t["orders"].sparkSession
    sources = {name: _as_file(_raw(t, name), "|") for name in TABLES if name not in ("products", "sellers")}
    sources["products"] = _as_file(_raw(t, "products").limit(0), "|")
    sources["sellers"] = scratch_path(spark, "nothing")
    return gate.source_check(spark, sources, TABLES)


@step
def strict_cleaning(t: SalesTables) -> DataFrame:
    """Orders with control characters, blanks and dates in five forms, cleaned strictly."""
    spark = t["orders"].sparkSession
    when = F.col("order_purchase_timestamp")
    noisy = t["orders"].select(
        [F.col(c).cast("string").alias(c) for c in TABLES["orders"].source_columns]
    ).withColumns({
        "order_status": F.concat(F.lit(" \x07"), F.upper("order_status"), F.lit("\t \x1f")),
        "order_purchase_timestamp": _dates_as_text(when.cast("timestamp")),
    })
    return pipeline.clean_table(spark, "orders", _as_file(noisy, ";"), STAMP, how=pipeline.STRICT)


@step
def clean_strings(t: SalesTables) -> DataFrame:
    return clean.trim_strings(_raw(t, "customers"))


@step
def clean_null_tokens(t: SalesTables) -> DataFrame:
    return clean.clean(_raw(t, "order_reviews"), at=STAMP)


@step
def null_tokens_to_null(t: SalesTables) -> DataFrame:
    return clean.clean(_raw(t, "order_reviews"), at=STAMP, mark=None)


def _conform_step(name: str) -> None:
    def run(t: SalesTables) -> DataFrame:
        df = conform.CONFORM[name](clean.clean(_raw(t, name), at=STAMP))
        return clean.align_to_schema(
            df, TABLES[name].schema
        ).select(TABLES[name].cleaned_columns)

    run.__name__ = f"conform_{name}"
    step(run)


for _name in TABLES:
    _conform_step(_name)


@step
def schema_align(t: SalesTables) -> DataFrame:
    return clean.align_to_schema(
        t["sellers"].withColumnRenamed("seller_id", "customer_trx_id"),
        TABLES["customers"].schema,
    )


@step
def missing_value_flags(t: SalesTables) -> DataFrame:
    few = t["order_reviews"].select("review_id", "order_id", "review_score")
    return clean.flag_missing(few, ["order_id", "review_score"])


@step
def orphan_flags(t: SalesTables) -> DataFrame:
    few = t["order_payments"].select("order_id", "payment_sequential", "payment_value")
    return clean.flag_orphans(few, t["orders"], "order_id")


def _dates_as_text(when: Column) -> Column:
    """Times as four kinds of text, one order in five unreadable."""
    turn = F.col("order_id").cast("long") % 5
    return (
        F.when(turn == 0, F.date_format(when, "yyyy-MM-dd HH:mm:ss"))
        .when(turn == 1, F.date_format(when, "dd/MM/yyyy HH:mm"))
        .when(turn == 2, F.date_format(when, "yyyyMMdd"))
        .when(turn == 3, F.date_format(when, "MMM d, yyyy"))
        .otherwise(F.concat(F.lit("week "), F.date_format(when, "D")))
    )


@step
def multi_format_dates(t: SalesTables) -> DataFrame:
    """Purchase times as four kinds of text, one of them unreadable."""
    text = _dates_as_text(F.col("order_purchase_timestamp"))
    texts = t["orders"].select("order_id", text.alias("bought_at"))
    return clean.parse_timestamps(texts, ["bought_at"], DATE_FORMATS)


@step
def scrub_text(t: SalesTables) -> DataFrame:
    return clean.scrub_strings(t.source("documents").select("doc_id", "text"))


@step
def geo_centroid(t: SalesTables) -> DataFrame:
    return rollups.postal_centres(t.geo_points())


# -------------------------------------------------------------------- loading


@step
def fact_dedup_latest(t: SalesTables) -> DataFrame:
    return keep_latest(t.item_lines(), list(TABLES["order_items"].key))


@step
def fact_batch_orders(t: SalesTables) -> DataFrame:
    return load.fact_batch(TABLES["orders"], t["orders"].drop("sale_date"))


@step
def fact_sale_date_inherit(t: SalesTables) -> DataFrame:
    return load.fact_batch(
        TABLES["order_items"], t.item_lines().drop("sale_date"), t["orders"]
    )


def _returns(t: SalesTables) -> DataFrame:
    """A later batch of items: one correction per order, dated at purchase."""
    zero = F.lit(0.0)
    return t["orders"].select(
        "order_id",
        F.lit(1).cast("long").alias("order_item_id"),
        F.lit("NA").alias("product_id"),
        F.lit("NA").alias("seller_id"),
        F.col("order_purchase_timestamp").alias("shipping_limit_date"),
        zero.alias("price"),
        zero.alias("freight_value"),
        zero.alias("total_item_value"),
        "sale_date",
        "etl_timestamp",
    )


@step
def partition_replace(t: SalesTables) -> DataFrame:
    return load.replace_day(
        t.item_lines(), _returns(t).select(t.item_lines().columns), AUDIT_DAY
    )


@step
def fact_load(t: SalesTables) -> DataFrame:
    """All items by day, then a batch of corrections that moves some of them."""
    table = TABLES["order_items"]
    spark = t["orders"].sparkSession
    path = scratch_path(spark, "fact")
    lines = keep_latest(t.item_lines(), list(table.key))
    for batch in (lines, _returns(t)):
        load.load_fact(spark, table, path, batch.select(table.schema.names))
    return load.read_fact(spark, table, path)


@step
def fact_day_reload(t: SalesTables) -> DataFrame:
    """All items by day on disk, then one day deleted and the corrections inserted."""
    table = TABLES["order_items"]
    spark = t["orders"].sparkSession
    path = scratch_path(spark, "fact-day")
    lines = keep_latest(t.item_lines(), list(table.key))
    load.load_fact(spark, table, path, lines.select(table.schema.names))
    load.load_fact_day(spark, table, path, _returns(t).select(table.schema.names), AUDIT_DAY)
    return load.read_fact(spark, table, path)


@step
def read_during_load(t: SalesTables) -> DataFrame:
    """Rows of a reader that began before a load, and of one that began after it."""
    table = TABLES["order_items"]
    spark = t["orders"].sparkSession
    path = scratch_path(spark, "fact-read")
    lines = keep_latest(t.item_lines(), list(table.key)).select(table.schema.names)
    load.load_fact(spark, table, path, lines, keep=2)
    before = load.read_fact(spark, table, path)
    load.load_fact(spark, table, path, _returns(t).select(table.schema.names), keep=2)
    after = load.read_fact(spark, table, path)
    return before.withColumn("reader", F.lit("before")).unionByName(after.withColumn("reader", F.lit("after")))


def _database(spark: SparkSession) -> str:
    name = f"shopgrain_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


@step
def catalog_fact(t: SalesTables) -> DataFrame:
    """The fact load as a catalog table, published after each batch."""
    table = TABLES["order_items"]
    spark = t["orders"].sparkSession
    path, name = scratch_path(spark, "fact-table"), f"{_database(spark)}.order_items"
    lines = keep_latest(t.item_lines(), list(table.key))
    for batch in (lines, _returns(t)):
        load.load_fact(spark, table, path, batch.select(table.schema.names), keep=2)
        catalog.publish_table(spark, table, name, path)
    return spark.table(name)


@step
def catalog_dimension(t: SalesTables) -> DataFrame:
    """The dimension load as a catalog table, published after each batch."""
    table = TABLES["customers"]
    spark = t["customers"].sparkSession
    path, name = scratch_path(spark, "dimension-table"), f"{_database(spark)}.customers"
    for staged in (t["customers"], _seller_customers(t)):
        load.load_dimension(spark, table, path, load.dimension_batch(table, staged))
        catalog.publish_table(spark, table, name, path)
    return spark.table(name)


@step
def views_after_reload(t: SalesTables) -> DataFrame:
    """Stored views made after the first of two loads, read in another session."""
    spark = t["orders"].sparkSession
    house, database = scratch_path(spark, "house"), _database(spark)
    for late in (False, True):
        for name in ("orders", "order_items", "order_payments"):
            table = TABLES[name]
            rows = t[name].select(table.schema.names)
            batch = rows if late else rows.where("order_id LIKE '%1'")
            load.load_fact(spark, table, f"{house}/{name}", batch, keep=2)
        catalog.publish_all(spark, house, database)
        if not late:
            create_views(spark, database)
    return configure(spark.newSession()).table(f"{database}.vw_order_summary")


def _seller_customers(t: SalesTables) -> DataFrame:
    """Sellers as a batch of customers: known keys change, others are new."""
    key = F.col("seller_id")
    new = key.cast("long") % 19 == 0
    return t["sellers"].select(
        F.when(new, F.concat(F.lit("S"), key)).otherwise(key).alias("customer_trx_id"),
        F.col("seller_name").alias("subscriber_id"),
        F.lit(None).cast("date").alias("subscribe_date"),
        F.lit(None).cast("date").alias("first_order_date"),
        F.col("seller_postal_code").alias("customer_postal_code"),
        F.col("seller_city").alias("customer_city"),
        F.col("seller_country").alias("customer_country"),
        F.col("country_code").alias("customer_country_code"),
        F.lit(None).cast("long").alias("age"),
        F.lit("NA").alias("gender"),
        "etl_timestamp",
    )


@step
def dimension_upsert(t: SalesTables) -> DataFrame:
    batch = load.dimension_batch(TABLES["customers"], _seller_customers(t))
    return load.upsert(t["customers"], batch, list(TABLES["customers"].key))


@step
def dimension_load(t: SalesTables) -> DataFrame:
    table = TABLES["customers"]
    spark = t["customers"].sparkSession
    path = scratch_path(spark, "dimension")
    for staged in (t["customers"], _seller_customers(t), _seller_customers(t)):
        load.load_dimension(spark, table, path, load.dimension_batch(table, staged))
    return load.read_dimension(spark, table, path)


# -------------------------------------------------------------------- control


def _audit_rows(t: SalesTables) -> DataFrame:
    """One load per hour of the event log; an hour of many errors failed."""
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    loads = t.source("events").groupBy(hour.alias("hour")).agg(
        F.max(F.col("ts").cast("timestamp")).alias("load_timestamp"),
        F.count_distinct("event_type").alias("files_loaded"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.count(F.lit(1)).alias("n"),
    )
    return loads.select(
        F.lit("staging").alias("dag_id"),
        F.date_format("hour", "yyyyMMddHH").alias("run_id"),
        F.to_date("hour").alias("logical_date"),
        "load_timestamp",
        F.lit(None).cast("timestamp").alias("prev_load_timestamp"),
        "files_loaded",
        F.when(F.col("errors") * 4 > F.col("n"), "failed").otherwise("success").alias("status"),
        F.lit(None).cast("string").alias("notes"),
    ).select(LOAD_AUDIT_SCHEMA.names)


@step
def latest_success(t: SalesTables) -> DataFrame:
    return control.latest(_audit_rows(t), only_success=True)


@step
def freshness_status(t: SalesTables) -> DataFrame:
    return control.freshness(_audit_rows(t), NOW)


@step
def audit_history(t: SalesTables) -> DataFrame:
    """The audit table on disk after all loads, with every failed one run again."""
    loads = _audit_rows(t)
    path = scratch_path(loads.sparkSession, "audit")
    control.append(loads, path)
    again = loads.where("status = 'failed'").withColumns(
        {
            "load_timestamp": F.col("load_timestamp") + F.expr("INTERVAL 10 MINUTES"),
            "status": F.lit("success"),
        }
    )
    for _ in range(2):
        control.append(again, path)
    return control.read_audit(loads.sparkSession, path)


@step
def load_audit(t: SalesTables) -> DataFrame:
    return control.load_audit(t.everything(), AUDIT_DAY)


@step
def row_counts(t: SalesTables) -> DataFrame:
    return control.row_counts(t.everything())


# ------------------------------------------------------------------- roll-ups


@step
def payment_totals(t: SalesTables) -> DataFrame:
    return rollups.payment_totals(t["order_payments"])


@step
def primary_payment_type(t: SalesTables) -> DataFrame:
    return t["order_payments"].groupBy("order_id").agg(
        rollups.primary_payment_type().alias("primary_payment_type")
    )


@step
def item_totals(t: SalesTables) -> DataFrame:
    return rollups.item_totals(t["order_items"])


@step
def review_totals(t: SalesTables) -> DataFrame:
    return rollups.review_totals(t["order_reviews"])


@step
def seller_order_totals(t: SalesTables) -> DataFrame:
    return rollups.seller_order_totals(t["order_items"])


@step
def delivery_metrics(t: SalesTables) -> DataFrame:
    return rollups.order_facts(t["orders"])


@step
def order_derived_columns(t: SalesTables) -> DataFrame:
    return order_columns(t["orders"])


@step
def item_bands(t: SalesTables) -> DataFrame:
    """Every amount and size band, over item prices as stand-in measures."""
    price = F.col("price") * 100.0
    return t["order_items"].select(
        labels.customer_segment(price).alias("customer_segment"),
        labels.product_tier(price * 2.0).alias("product_tier"),
        labels.seller_tier(price * 8.0).alias("seller_tier"),
        labels.weight_bucket(price).alias("weight_bucket"),
        labels.size_bucket(price * 4.0).alias("size_bucket"),
    ).groupBy(
        "customer_segment", "product_tier", "seller_tier",
        "weight_bucket", "size_bucket",
    ).agg(F.count(F.lit(1)).alias("items"))


@step
def review_labels(t: SalesTables) -> DataFrame:
    score = F.col("review_score")
    return t["order_reviews"].groupBy(
        "review_score",
        labels.sentiment_bucket(score).alias("sentiment_bucket"),
        labels.review_sentiment(score).alias("review_sentiment"),
        labels.star_label(score).alias("star_label"),
    ).agg(F.count(F.lit(1)).alias("reviews"))


@step
def age_groups(t: SalesTables) -> DataFrame:
    return t["customers"].groupBy(
        "age", labels.age_group(F.col("age")).alias("age_group")
    ).agg(F.count(F.lit(1)).alias("customers"))
