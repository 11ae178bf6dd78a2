"""Parquet between cleaning and loading: one directory per table and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopgrain.schemas import TABLES


def day_path(zone: str, table: str, day: str) -> str:
    return f"{zone.rstrip('/')}/{table}/partition={day}"


def write_day(df: DataFrame, path: str) -> None:
    """Replace one day's cleaned output."""
    df.write.mode("overwrite").parquet(path)


def read_staging(
    spark: SparkSession, zone: str, table: str, day: str
) -> DataFrame:
    """One day's cleaned rows in table types.

    Reading the directory anew is what truncate-and-load means here.
    """
    path = day_path(zone, table, day)
    found = spark.read.parquet(path)
    schema = TABLES[table].schema
    return found.select(
        [found[c].cast(schema[c].dataType) for c in TABLES[table].cleaned_columns]
    )
