"""Which folders make up a fact table, published in one step.

Every load writes its days into folders of its own, ``sale_date=D/load=ID``,
and then a state: a small Parquet directory that names the folder of each day.
A state counts once its ``_SUCCESS`` mark is there, so readers see a load as a
whole or not at all, and a load that fails leaves the state before it.

Beside the days lies an index of the keys, ``keys/load=ID/bucket=B``: on which
days a key has been.  It tells a load which days to rewrite, without a look at
the days themselves.

A table has one loader at a time; a second one that ends on the same state
number fails instead of overwriting it.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain import files
from shopgrain.schemas import Table

Day = dt.date | None

KEY_BUCKETS = 256
KEY_PARTS = 16  # more parts than this become one

_STATE = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("sale_date", T.DateType()),
    T.StructField("load", T.StringType()),
])


@dataclass(frozen=True)
class State:
    """`days` maps each day to the load that wrote it; `keys` are index parts."""

    number: int = 0
    days: dict[Day, str] = field(default_factory=dict)
    keys: tuple[str, ...] = ()


def new_load() -> str:
    """A name no other load has, also not one that failed."""
    return uuid.uuid4().hex


def _number(name: str) -> int:
    return int(name.split("=")[1])


def _states(spark: SparkSession, path: str) -> list[str]:
    return [n for n in files.children(spark, path) if n.startswith("state=")]


def complete_states(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the states readers may use, oldest first."""
    return [
        _number(n) for n in _states(spark, path) if files.exists(spark, f"{path}/{n}/_SUCCESS")
    ]


def _state_dir(path: str, number: int) -> str:
    return f"{path}/state={number:09d}"


def read_state(spark: SparkSession, path: str, number: int | None = None) -> State:
    """The state of that number, by default the newest; an empty one before the first load."""
    if number is None:
        done = complete_states(spark, path)
        if not done:
            return State()
        number = done[-1]
    rows = spark.read.schema(_STATE).parquet(_state_dir(path, number)).collect()
    days = {r.sale_date: r.load for r in rows if r.kind == "day"}
    return State(number, days, tuple(sorted(r.load for r in rows if r.kind == "keys")))


def day_dir(path: str, day: Day, load: str) -> str:
    value = "__HIVE_DEFAULT_PARTITION__" if day is None else day.isoformat()
    return f"{path}/sale_date={value}/load={load}"


def _keys_dir(path: str, load: str) -> str:
    return f"{path}/keys/load={load}"


def read_days(
    spark: SparkSession, table: Table, path: str, days: dict[Day, str]
) -> DataFrame:
    """Rows of these days; only their folders are listed."""
    if not days:
        return spark.createDataFrame([], table.schema)
    folders = [day_dir(path, day, load) for day, load in days.items()]
    stored = spark.read.schema(table.schema).option("basePath", path).parquet(*folders)
    return stored.select(table.schema.names)


def write_days(df: DataFrame, path: str, load: str, keys: list[str], tasks: int) -> None:
    """Write each day into its folder of this load, in even tasks.

    Ranges over (day, key) keep a day in few files and still cut one that
    holds a large share of the rows; files are sorted by key for skipping.
    """
    order = ["sale_date", *keys]
    (
        df.repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .withColumn("load", F.lit(load))
        .write.partitionBy("sale_date", "load")
        .mode("append")
        .parquet(path)
    )


def commit(spark: SparkSession, path: str, state: State, keep: int = 1) -> None:
    """Publish a state, then drop what none of the newest `keep` states names."""
    if keep < 1:
        raise ValueError("at least one state is kept")
    done = complete_states(spark, path)
    rows = [("day", day, load) for day, load in state.days.items()]
    rows += [("keys", None, load) for load in state.keys]
    target = _state_dir(path, state.number)
    spark.createDataFrame(rows, _STATE).coalesce(1).write.mode("error").parquet(target)
    cut = max(0, len(done) - (keep - 1))
    used = _folders(path, state).union(
        *[_folders(path, read_state(spark, path, number)) for number in done[cut:]]
    )
    for number in done[:cut]:
        for folder in _folders(path, read_state(spark, path, number)) - used:
            files.remove(spark, folder)
            files.remove_if_empty(spark, folder.rsplit("/", 1)[0])
        files.remove(spark, _state_dir(path, number))


def _folders(path: str, state: State) -> set[str]:
    days = {day_dir(path, day, load) for day, load in state.days.items()}
    return days | {_keys_dir(path, load) for load in state.keys}


def next_number(spark: SparkSession, path: str) -> int:
    """One above every state there is, also those left incomplete."""
    return max([_number(n) for n in _states(spark, path)], default=0) + 1


# ----------------------------------------------------------------- key index


def _bucket(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).cast("int").alias("bucket")


def _index_schema(table: Table) -> T.StructType:
    names = [*table.key, "sale_date"]
    return T.StructType([table.schema[n] for n in names] + [T.StructField("bucket", T.IntegerType())])


def read_keys(spark: SparkSession, table: Table, path: str, state: State) -> DataFrame:
    """(key, day, bucket) rows; a key that moved has a row for each day."""
    schema = _index_schema(table)
    if not state.keys:
        return spark.createDataFrame([], schema)
    parts = [_keys_dir(path, load) for load in state.keys]
    stored = spark.read.schema(schema).option("basePath", f"{path}/keys").parquet(*parts)
    return stored.select(schema.names)


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[n])
    return cond


def known_keys(
    spark: SparkSession, table: Table, path: str, state: State, batch: DataFrame
) -> DataFrame:
    """Index rows of the batch's keys, NULL being a key like any other.

    Only the buckets the batch falls into are read: few for a small batch.
    """
    keys = list(table.key)
    wanted = batch.select(*keys, _bucket(keys))
    buckets = [r.bucket for r in wanted.select("bucket").distinct().collect()]
    index = read_keys(spark, table, path, state).where(F.col("bucket").isin(buckets))
    return index.join(wanted, _same(index, wanted, [*keys, "bucket"]), "left_semi")


def index_batch(
    spark: SparkSession, table: Table, path: str, state: State, batch: DataFrame,
    known: DataFrame | None, load: str, tasks: int,
) -> tuple[str, ...]:
    """Write the (key, day) rows the index lacks; the parts it then consists of.

    A batch that is loaded again adds nothing, and many small parts are merged.
    """
    names = [*table.key, "sale_date"]
    bucket = _bucket(list(table.key))
    rows = batch.select(*names, bucket)
    parts = state.keys
    if known is not None:
        rows = rows.join(known, _same(rows, known, names), "left_anti")
    if len(parts) >= KEY_PARTS:
        rows = read_keys(spark, table, path, state).select(*names, bucket).unionByName(rows)
        tasks, parts = tasks * len(parts), ()
    (
        # Equal rows are in one bucket, so they meet without another shuffle.
        rows.repartition(min(tasks, KEY_BUCKETS), "bucket")
        .distinct()
        .sortWithinPartitions("bucket", *names)
        .write.partitionBy("bucket")
        .parquet(_keys_dir(path, load))
    )
    wrote = any(n.startswith("bucket=") for n in files.children(spark, _keys_dir(path, load)))
    return (*parts, load) if wrote else parts
