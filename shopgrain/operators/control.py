"""Load-audit rows, the freshness gate, and row counts per table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain import files
from shopgrain.schemas import LOAD_AUDIT_SCHEMA, TABLES

MAX_AGE_HOURS = 25


class StaleSource(RuntimeError):
    """The source data must not be processed."""


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    if not files.children(spark, path):
        return spark.createDataFrame([], LOAD_AUDIT_SCHEMA)
    stored = spark.read.schema(LOAD_AUDIT_SCHEMA).parquet(path)
    return last_of_each_run(stored.select(LOAD_AUDIT_SCHEMA.names))


def last_of_each_run(audit: DataFrame) -> DataFrame:
    """The newest row of each run; its other columns decide between equal stamps.

    Rows are only ever appended, which two writers may do at once, and a run
    that is recorded again counts once.
    """
    run = ["dag_id", "run_id"]
    rest = [c for c in LOAD_AUDIT_SCHEMA.names if c not in [*run, "load_timestamp"]]
    newest = F.max(F.struct("load_timestamp", *rest)).alias("newest")
    return audit.groupBy(*run).agg(newest).select(*run, "newest.*").select(LOAD_AUDIT_SCHEMA.names)


def ensure_audit(spark: SparkSession, path: str) -> None:
    """Create the empty audit table where there is none."""
    if not files.children(spark, path):
        append(spark.createDataFrame([], LOAD_AUDIT_SCHEMA), path)


def append(rows: DataFrame, path: str) -> None:
    """Add audit rows; those of a run that is already there take its place in `read_audit`."""
    by_day = rows.withColumn("load_day", F.to_date("load_timestamp"))
    by_day.write.mode("append").partitionBy("load_day").parquet(path)


def latest(audit: DataFrame, only_success: bool = False) -> DataFrame:
    """The newest load row, as a top-1 without a full sort."""
    rows = audit.where("status = 'success'") if only_success else audit
    return rows.orderBy(F.col("load_timestamp").desc()).limit(1)


def record_load(
    spark: SparkSession,
    path: str,
    dag_id: str,
    run_id: str,
    logical_date: dt.date,
    files_loaded: int = len(TABLES),
    status: str = "success",
    now: dt.datetime | None = None,
    notes: str | None = None,
) -> None:
    """Append one audit row that points back at the last good load of another run."""
    now = now or dt.datetime.now(dt.timezone.utc)
    own = F.col("dag_id").eqNullSafe(F.lit(dag_id)) & F.col("run_id").eqNullSafe(F.lit(run_id))
    previous = latest(read_audit(spark, path).where(~own), only_success=True).first()
    if notes is None:
        notes = f"{logical_date}: {files_loaded} files, finished {now:%Y-%m-%dT%H:%M:%SZ}"
    row = (
        dag_id, run_id, logical_date, now,
        previous.load_timestamp if previous else None,
        files_loaded, status, notes,
    )
    append(spark.createDataFrame([row], LOAD_AUDIT_SCHEMA), path)


def freshness(
    audit: DataFrame, now: dt.datetime, max_age_hours: float = MAX_AGE_HOURS
) -> DataFrame:
    """One row: outcome, status, age in hours of the newest load.

    The outcome is `first_load`, `failed`, `stale` or `fresh`.
    """
    instant = F.lit(now).cast("timestamp")
    age = (
        F.unix_micros(instant) - F.unix_micros(F.col("load_timestamp"))
    ) / F.lit(3.6e9)
    newest = latest(audit).select("status", age.alias("age_hours"))
    outcome = (
        F.when(F.col("n") == 0, "first_load")
        .when(~F.col("status").eqNullSafe("success"), "failed")
        .when(F.col("age_hours") > max_age_hours, "stale")
        .otherwise("fresh")
    )
    # A global aggregate turns "no row" into one row that says so.
    return newest.agg(
        F.count(F.lit(1)).alias("n"),
        F.max("status").alias("status"),
        F.max("age_hours").alias("age_hours"),
    ).select(outcome.alias("outcome"), "status", "age_hours")


def check_freshness(
    spark: SparkSession,
    path: str,
    now: dt.datetime | None = None,
    max_age_hours: float = MAX_AGE_HOURS,
) -> str:
    """`first_load` or `fresh`; anything else stops the run."""
    now = now or dt.datetime.now(dt.timezone.utc)
    row = freshness(read_audit(spark, path), now, max_age_hours).first()
    if row.outcome == "failed":
        raise StaleSource(f"last load ended with status {row.status!r}")
    if row.outcome == "stale":
        raise StaleSource(
            f"last load is {row.age_hours:.1f} h old, limit {max_age_hours} h"
        )
    return row.outcome


def load_audit(tables: Mapping[str, DataFrame], day: dt.date) -> DataFrame:
    """Rows in each table and, for facts, on `day`; plus a grand total.

    One pass per table over at most the date column.
    """
    parts = []
    for name, df in tables.items():
        if TABLES[name].is_fact:
            on_day = F.count_if(F.col("sale_date") == F.lit(day).cast("date"))
        else:
            on_day = F.lit(None).cast("long")
        parts.append(
            df.agg(F.count(F.lit(1)).alias("total_rows"), on_day.alias("day_rows"))
            .select(F.lit(name).alias("table_name"), "total_rows", "day_rows")
        )
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return counts.rollup("table_name").agg(
        F.sum("total_rows").alias("total_rows"),
        F.sum("day_rows").alias("day_rows"),
    ).withColumn("table_name", F.coalesce("table_name", F.lit("TOTAL")))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table; an input of zero rows is one to skip or report."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts
