"""Whether all sources are there and hold rows, before anything is written."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain import files
from shopgrain.sources.delimited import read_delimited


class MissingSource(RuntimeError):
    """A run lacks inputs it was told to read."""


def absent_sources(
    spark: SparkSession, sources: Mapping[str, str], wanted: Iterable[str]
) -> list[str]:
    return [n for n in wanted if n not in sources or not files.found(spark, sources[n])]


def require_sources(
    spark: SparkSession, sources: Mapping[str, str], wanted: Iterable[str] | None = None
) -> None:
    """Fail with the names of all absent sources; looks at paths only."""
    absent = absent_sources(spark, sources, sources if wanted is None else wanted)
    if absent:
        raise MissingSource("no input for " + ", ".join(sorted(absent)))


def source_check(
    spark: SparkSession, sources: Mapping[str, str], wanted: Iterable[str]
) -> DataFrame:
    """One row per wanted table: `ready`, `empty` or `absent`, and its rows.

    Rows of an absent source are NULL.
    """
    wanted = list(wanted)
    absent = set(absent_sources(spark, sources, wanted))
    out = None
    for name in wanted:
        if name in absent:
            counted = spark.range(1).select(F.lit(None).cast("long").alias("row_count"))
        else:
            counted = read_delimited(spark, sources[name]).agg(F.count(F.lit(1)).alias("row_count"))
        n = F.col("row_count")
        outcome = F.when(n.isNull(), "absent").when(n == 0, "empty").otherwise("ready")
        row = counted.select(F.lit(name).alias("table_name"), outcome.alias("outcome"), "row_count")
        out = row if out is None else out.unionByName(row)
    return out
