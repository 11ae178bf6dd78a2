"""Loading cleaned batches into the fact and dimension tables.

The first half holds pure DataFrame steps; the second half applies them to
Parquet directories.  Facts are laid out by `sale_date`; the days a batch
touches are written anew beside the old ones and published together (see
`states`).  Dimensions are rewritten as a new snapshot directory beside the
old one, and readers take the newest complete snapshot.  Either way a lost job
leaves the previous state readable.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain import files
from shopgrain.files import Scratch
from shopgrain.operators import states
from shopgrain.operators.dedup import keep_latest
from shopgrain.schemas import TABLES, Table

# Parquet that one task sorts and writes.  In memory it is some ten times as
# large, and a sort that fits there is not spilled.
BYTES_PER_TASK = 64 * 1024 * 1024

# --------------------------------------------------------------- DataFrames


def with_sale_date(batch: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Add the day of sale: own purchase time, or that of the row's order.

    A row whose order is unknown keeps a NULL day.  The orders table has one
    row per id.  Both sides are shuffled on order_id, which a following dedup
    on (order_id, ...) builds on; a busy order id can be split.
    """
    purchase = F.to_date("order_purchase_timestamp").alias("sale_date")
    if orders is None:
        return batch.withColumn("sale_date", purchase)
    return batch.join(orders.select("order_id", purchase), "order_id", "left")


def fact_batch(
    table: Table, staging: DataFrame, orders: DataFrame | None = None
) -> DataFrame:
    """Staged rows ready to insert: day of sale, one row per key, in order."""
    dated = with_sale_date(staging, orders)
    return keep_latest(dated, list(table.key)).select(table.schema.names)


def dimension_batch(table: Table, staging: DataFrame) -> DataFrame:
    return keep_latest(staging, list(table.key)).select(table.schema.names)


def _same_key(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool) -> Column:
    cond = F.lit(True)
    for k in keys:
        same = left[k].eqNullSafe(right[k]) if null_safe else left[k] == right[k]
        cond = cond & same
    return cond


def upsert(
    target: DataFrame, batch: DataFrame, keys: list[str], null_safe: bool = False,
    known: DataFrame | None = None,
) -> DataFrame:
    """Batch rows replace target rows of the same key; all others stay.

    With plain equality a NULL key matches nothing and such rows pile up with
    every load; `null_safe` makes a NULL a key like any other.  `known` has
    those keys of the batch that may be in the target, where they were found
    before: the target then meets these alone and not the whole batch.
    """
    incoming = (batch if known is None else known).select(keys).alias("incoming")
    stay = target.alias("target").join(
        incoming,
        _same_key(target.alias("target"), incoming, keys, null_safe),
        "left_anti",
    )
    return stay.unionByName(batch)


def replace_day(existing: DataFrame, batch: DataFrame, day: dt.date) -> DataFrame:
    """Drop one day's rows, then insert the whole batch.

    Batch rows of other days are added to what those days already hold; use
    `upsert` with the table key where a load may be repeated.
    """
    is_day = F.col("sale_date").eqNullSafe(F.lit(day).cast("date"))
    return existing.where(~is_day).unionByName(batch)


# ------------------------------------------------------------------- Parquet


def create_table_sql(table: Table, name: str, location: str) -> str:
    """DDL for the catalog; does nothing where the table is known."""
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in table.schema
    )
    layout = "PARTITIONED BY (sale_date) " if table.is_fact else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"{layout}LOCATION '{location}'"
    )


def create_table(spark: SparkSession, table: Table, name: str, location: str) -> None:
    spark.sql(create_table_sql(table, name, location))


def drop_staging(spark: SparkSession, name: str) -> None:
    """Forget a staging view or table; no error where it is absent."""
    spark.catalog.dropTempView(name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_fact(spark: SparkSession, table: Table, path: str) -> DataFrame:
    """Rows of the newest state; a filter on sale_date opens only those days.

    The state is taken when this is called: what a later load publishes does
    not show in it.
    """
    path = path.rstrip("/")
    return states.read_days(spark, table, path, states.read_state(spark, path).days)


def _days_of(df: DataFrame) -> set[dt.date | None]:
    """Distinct days, at most one small row per partition directory."""
    return {r.sale_date for r in df.select("sale_date").distinct().toLocalIterator()}


def _tasks(spark: SparkSession, size: int, folders: int) -> int:
    """Write tasks: enough for the bytes, more where many folders (days, buckets) are small."""
    by_folders = min(folders, spark.sparkContext.defaultParallelism)
    return max(1, by_folders, math.ceil(size / BYTES_PER_TASK))


def _publish(
    spark: SparkSession,
    table: Table,
    path: str,
    state: states.State,
    rows: DataFrame,
    touched: set[dt.date | None],
    batch: DataFrame,
    known: DataFrame | None,
    size: int,
    keep: int,
) -> None:
    """Make `rows` the content of the touched days and publish that."""
    load = states.new_load()
    stored = [states.day_dir(path, d, state.days[d]) for d in touched if d in state.days]
    total = size + sum(files.size(spark, folder) for folder in stored)
    states.write_days(rows, path, load, list(table.key), _tasks(spark, total, len(touched)))
    days = {day: there for day, there in state.days.items() if day not in touched}
    for day in touched:
        if files.exists(spark, states.day_dir(path, day, load)):
            days[day] = load
    keys = states.index_batch(
        spark, table, path, state, batch, known, load, _tasks(spark, size, states.KEY_BUCKETS)
    )
    number = states.next_number(spark, path)
    states.commit(spark, path, states.State(number, days, keys), keep)


def load_fact(
    spark: SparkSession, table: Table, path: str, batch: DataFrame, keep: int = 1
) -> None:
    """Merge a batch on the table key; loading it again changes nothing.

    Rewritten are the days the batch falls on and the days where its keys were
    before, as the key index tells.  All other days are neither read nor
    written.  With `keep=2` those who read the state before are not disturbed;
    its folders go with the load after this one.
    """
    path, keys = path.rstrip("/"), list(table.key)
    with Scratch(spark) as scratch:
        batch, size = scratch.written(batch, f"{table.name}-batch")
        touched = _days_of(batch)
        if not touched:
            return
        state = states.read_state(spark, path)
        known = None
        if state.keys:
            known, _ = scratch.written(
                states.known_keys(spark, table, path, state, batch), f"{table.name}-known"
            )
            touched |= _days_of(known) & set(state.days)
        there = {d: load for d, load in state.days.items() if d in touched}
        rows = batch
        if there:
            rows = upsert(states.read_days(spark, table, path, there), batch, keys, True, known)
        _publish(spark, table, path, state, rows, touched, batch, known, size, keep)


def load_fact_day(
    spark: SparkSession, table: Table, path: str, batch: DataFrame, day: dt.date,
    keep: int = 1,
) -> None:
    """Replace one day by the batch and add the batch's other days as they are.

    This is the plain delete-and-insert load: a repeated run doubles the other
    days, which `load_fact` avoids.
    """
    path = path.rstrip("/")
    with Scratch(spark) as scratch:
        batch, size = scratch.written(batch, f"{table.name}-batch")
        state = states.read_state(spark, path)
        touched = _days_of(batch) | {day}
        old = states.read_days(
            spark, table, path, {d: load for d, load in state.days.items() if d in touched}
        )
        rows = replace_day(old, batch, day)
        known = states.known_keys(spark, table, path, state, batch) if state.keys else None
        _publish(spark, table, path, state, rows, touched, batch, known, size, keep)


def _snapshots(spark: SparkSession, path: str) -> list[str]:
    """Complete snapshots below `path`, oldest first."""
    names = [n for n in files.children(spark, path) if n.startswith("snapshot=")]
    return [n for n in names if files.exists(spark, f"{path}/{n}/_SUCCESS")]


def newest_snapshot(spark: SparkSession, path: str) -> str | None:
    done = _snapshots(spark, path)
    return f"{path}/{done[-1]}" if done else None


def read_dimension(spark: SparkSession, table: Table, path: str) -> DataFrame:
    newest = newest_snapshot(spark, path)
    if newest is None:
        return spark.createDataFrame([], table.schema)
    return spark.read.schema(table.schema).parquet(newest)


def load_dimension(
    spark: SparkSession, table: Table, path: str, batch: DataFrame, keep: int = 2
) -> None:
    """Upsert a batch and publish the result as the next snapshot.

    Rows are laid out by the cluster columns with the key behind them, so one
    frequent value still spreads over many files with tight min/max ranges.
    """
    if keep < 1:
        raise ValueError("at least one snapshot is kept")
    if batch.isEmpty():
        return
    done = _snapshots(spark, path)
    number = int(done[-1].split("=")[1]) + 1 if done else 1
    rows = upsert(read_dimension(spark, table, path), batch, list(table.key))
    order = list(dict.fromkeys([*table.cluster_by, *table.key]))
    (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .parquet(f"{path}/snapshot={number:09d}")
    )
    for old in [*done, ""][: -keep]:
        if old:
            files.remove(spark, f"{path}/{old}")


def read_table(spark: SparkSession, name: str, warehouse: str) -> DataFrame:
    table = TABLES[name]
    path = f"{warehouse.rstrip('/')}/{name}"
    return (read_fact if table.is_fact else read_dimension)(spark, table, path)
