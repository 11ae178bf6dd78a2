"""The daily run: delimited files to cleaned Parquet to tables to views."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shopgrain import files
from shopgrain.operators import catalog, clean, conform, control, load
from shopgrain.plans import register_views
from shopgrain.plans.lasting import create_views
from shopgrain.schemas import DIMENSIONS, FACTS, TABLES, Table
from shopgrain.sources.delimited import read_delimited
from shopgrain.sources.gate import require_sources
from shopgrain.sources.parquet import day_path, read_staging, write_day

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Cleaning:
    """How text is cleaned before it is typed.

    `mark` replaces the spellings of "no value"; None makes them NULL.  `scrub`
    drops control characters first.  `date_formats` are tried where a date or
    time is not in the usual form.
    """

    mark: str | None = clean.NULL_MARK
    scrub: bool = False
    date_formats: tuple[str, ...] = ()


USUAL = Cleaning()
STRICT = Cleaning(
    mark=None, scrub=True, date_formats=("dd/MM/yyyy HH:mm", "yyyyMMdd", "MMM d, yyyy")
)

READ_REPORT = "table_name string, rows long, columns long, bad_dates long, missing_keys long"


def _known(c: Column, mark: str | None) -> Column:
    """Whether a cleaned text cell holds a value."""
    return c.isNotNull() if mark is None else c.isNotNull() & (c != mark)


def _date_columns(table: Table) -> list[str]:
    kinds = {"date", "timestamp"}
    return [c for c in table.source_columns if table.schema[c].dataType.typeName() in kinds]


def _observed(df: DataFrame, table: Table, width: int, how: Cleaning, report: Observation) -> DataFrame:
    """Count what the scan reads; the figures arrive with the first action."""
    bad, gone = F.lit(0).cast("long"), F.lit(False)
    for c in _date_columns(table):
        read = clean.parse_any_timestamp(F.col(c), list(how.date_formats))
        bad = bad + F.count_if(_known(F.col(c), how.mark) & read.isNull())
    for c in table.key:
        gone = gone | ~_known(F.col(c), how.mark)
    return df.observe(
        report,
        F.count(F.lit(1)).alias("rows"),
        F.max(F.lit(width).cast("long")).alias("columns"),
        bad.alias("bad_dates"),
        F.count_if(gone).alias("missing_keys"),
    )


def clean_table(
    spark: SparkSession,
    name: str,
    source: str,
    at: dt.datetime | None = None,
    report: Observation | None = None,
    how: Cleaning = USUAL,
) -> DataFrame:
    """Read and clean one table's files; columns the file lacks are NULL.

    With `at` all rows carry that load stamp, otherwise the time of the query.
    """
    raw = read_delimited(spark, source)
    absent = [c for c in TABLES[name].source_columns if c not in raw.columns]
    if absent:
        log.warning("%s: adding absent columns %s as NULL", name, absent)
    table = TABLES[name]
    text = _with_absent(raw, absent)
    cleaned = clean.clean(clean.scrub_strings(text) if how.scrub else text, at, how.mark)
    if report is not None:
        cleaned = _observed(cleaned, table, len(raw.columns), how, report)
    if how.date_formats:
        cleaned = cleaned.withColumns({
            c: F.coalesce(
                clean.parse_any_timestamp(F.col(c), list(how.date_formats)).cast("string"), F.col(c)
            )
            for c in _date_columns(table)
        })
    typed = conform.CONFORM[name](cleaned)
    return clean.align_to_schema(typed, table.schema).select(table.cleaned_columns)


def _with_absent(raw: DataFrame, absent: list[str]) -> DataFrame:
    if not absent:
        return raw
    return raw.selectExpr("*", *[f"CAST(NULL AS STRING) AS {c}" for c in absent])


def clean_reports(
    spark: SparkSession,
    sources: Mapping[str, str],
    zone: str,
    day: str,
    at: dt.datetime | None = None,
    how: Cleaning = USUAL,
    side_by_side: int = 4,
) -> dict[str, dict]:
    """Clean each table into its `partition=day` directory; figures per table.

    A few tables are cleaned at once, so that a small one does not wait for
    the last tasks of a large one.  If one fails the others are finished first.
    """

    def one(name: str) -> dict:
        return clean_with_report(spark, name, sources[name], day_path(zone, name, day), at, how)

    with ThreadPoolExecutor(max_workers=max(1, side_by_side)) as pool:
        return dict(zip(sources, pool.map(inheritable_thread_target(spark)(one), sources)))


def read_report(spark: SparkSession, reports: Mapping[str, dict]) -> DataFrame:
    """The figures of `clean_reports` as rows."""
    names = [c.split()[0] for c in READ_REPORT.split(", ")][1:]
    rows = [(table, *[figures[n] for n in names]) for table, figures in reports.items()]
    return spark.createDataFrame(rows, READ_REPORT)


def clean_day(
    spark: SparkSession,
    sources: Mapping[str, str],
    zone: str,
    day: str,
    at: dt.datetime | None = None,
) -> dict[str, int]:
    """Clean each table into its `partition=day` directory; rows read per table.

    One scan of the input per table: the row count is observed by the write.
    An input without rows is reported; what was cleaned earlier stays.
    """
    reports = clean_reports(spark, sources, zone, day, at)
    return {name: figures["rows"] for name, figures in reports.items()}


def clean_to(
    spark: SparkSession,
    name: str,
    source: str,
    output: str,
    at: dt.datetime | None = None,
) -> int:
    """Clean one table's files into a directory; returns the rows read."""
    return clean_with_report(spark, name, source, output, at)["rows"]


def clean_with_report(
    spark: SparkSession,
    name: str,
    source: str,
    output: str,
    at: dt.datetime | None = None,
    how: Cleaning = USUAL,
) -> dict:
    """Clean one table's files into a directory; rows, columns and faults read."""
    raw = read_delimited(spark, source)
    if raw.isEmpty():
        log.warning("%s: no rows in %s, earlier output stays", name, source)
        return {"rows": 0, "columns": len(raw.columns), "bad_dates": 0, "missing_keys": 0}
    seen = Observation(f"read {name}")
    write_day(clean_table(spark, name, source, at, seen, how), output)
    return dict(seen.get)


def load_day(
    spark: SparkSession,
    zone: str,
    warehouse: str,
    day: str,
    only: Collection[str] | None = None,
) -> None:
    """Load every table that was cleaned for `day`, or those named in `only`.

    Orders come first: the other facts take their day of sale from the orders
    as they are after this load.
    """
    orders = None
    for name in [*FACTS, *DIMENSIONS]:
        if only is not None and name not in only:
            continue
        if not files.exists(spark, day_path(zone, name, day)):
            log.warning("%s: nothing staged for %s", name, day)
            continue
        table = TABLES[name]
        staged = read_staging(spark, zone, name, day)
        target = f"{warehouse.rstrip('/')}/{name}"
        if table.is_fact:
            if name != "orders" and orders is None:
                orders = load.read_table(spark, "orders", warehouse)
            batch = load.fact_batch(table, staged, orders)
            load.load_fact(spark, table, target, batch, keep=2)
        else:
            load.load_dimension(
                spark, table, target, load.dimension_batch(table, staged)
            )


def open_tables(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    return {name: load.read_table(spark, name, warehouse) for name in TABLES}


def publish(spark: SparkSession, warehouse: str, database: str) -> list[str]:
    """Show the loaded tables in the catalog, with the reports as stored views."""
    catalog.publish_all(spark, warehouse, database)
    return create_views(spark, database)


def run_day(
    spark: SparkSession,
    sources: Mapping[str, str],
    zone: str,
    warehouse: str,
    day: str,
    at: dt.datetime | None = None,
    how: Cleaning = USUAL,
    database: str | None = None,
) -> list[str]:
    """Clean, load and publish one day; returns the names of the views.

    Nothing is written unless every source is there.  An input without rows is
    skipped.  With `database` tables and views are kept by the catalog,
    otherwise the views are temporary.
    """
    require_sources(spark, sources)
    reports = clean_reports(spark, sources, zone, day, at, how)
    load_day(spark, zone, warehouse, day, [n for n, r in reports.items() if r["rows"]])
    if database is not None:
        return publish(spark, warehouse, database)
    return register_views(open_tables(spark, warehouse))


def run_chain(
    spark: SparkSession,
    sources: Mapping[str, str],
    zone: str,
    warehouse: str,
    day: str,
    audit: str,
    run_id: str,
    at: dt.datetime | None = None,
    how: Cleaning = USUAL,
    database: str | None = None,
    max_age_hours: float = control.MAX_AGE_HOURS,
) -> DataFrame:
    """Stage and record, then the freshness gate, load, publish, row counts.

    All eight sources are wanted.  A staging that fails is recorded as failed,
    and nothing is loaded until a later one succeeds.
    """
    logical = dt.date.fromisoformat(day)
    control.ensure_audit(spark, audit)
    try:
        require_sources(spark, sources, TABLES)
        reports = clean_reports(spark, sources, zone, day, at, how)
    except Exception as failure:
        control.record_load(
            spark, audit, "staging", run_id, logical, 0, "failed", at, notes=str(failure)[:500]
        )
        raise
    filled = [name for name, figures in reports.items() if figures["rows"]]
    control.record_load(spark, audit, "staging", run_id, logical, len(filled), now=at)
    control.check_freshness(spark, audit, at, max_age_hours)
    load_day(spark, zone, warehouse, day, filled)
    if database is not None:
        publish(spark, warehouse, database)
    return control.load_audit(open_tables(spark, warehouse), logical)
