"""Cleaning shared by all tables, and the optional data-quality steps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.operators.joins import own_shuffle

# Trimmed, lower-case spellings of "no value".
NULL_TOKENS = ["", "null", "none", "na", "n/a", "nan"]
NULL_MARK = "NA"
_LONGEST_TOKEN = max(len(t.encode()) for t in NULL_TOKENS)


def _strings(df: DataFrame) -> set[str]:
    return {n for n, kind in df.dtypes if kind == "string"}


def _each_string(df: DataFrame, change) -> DataFrame:
    strings = _strings(df)
    return df.select(
        [change(F.col(c)).alias(c) if c in strings else F.col(c)
         for c in df.columns]
    )


def trim_strings(df: DataFrame) -> DataFrame:
    return _each_string(df, F.trim)


def unify_nulls(df: DataFrame, mark: str | None = NULL_MARK) -> DataFrame:
    """Replace every spelling of "no value" by `mark`.

    A real NULL stays NULL.  With ``mark=None`` the spellings become NULL too.
    """
    return _each_string(df, lambda c: _unified(c, mark))


def _unified(c: Column, mark: str | None) -> Column:
    # Longer text is not lowered: no letter of a token is the lower case of one of more bytes.
    is_token = (F.octet_length(c) <= _LONGEST_TOKEN) & F.lower(c).isin(NULL_TOKENS)
    return F.when(is_token, F.lit(mark).cast("string")).otherwise(c)


def stamp(df: DataFrame, at: datetime | None = None) -> DataFrame:
    """Add the load stamp: now, or a fixed instant for repeatable runs."""
    now = F.current_timestamp() if at is None else F.lit(at)
    return df.withColumn("etl_timestamp", now.cast("timestamp"))


def clean(
    df: DataFrame,
    at: datetime | None = None,
    mark: str | None = NULL_MARK,
) -> DataFrame:
    """Trim, unify nulls and stamp, in one projection over the scan."""
    return stamp(_each_string(df, lambda c: _unified(F.trim(c), mark)), at)


def scrub_strings(df: DataFrame) -> DataFrame:
    """Drop control characters and squeeze runs of blanks to one."""

    def scrub(c: Column) -> Column:
        spaced = F.regexp_replace(c, r"[\t\r\n]+", " ")
        visible = F.regexp_replace(spaced, r"[\x00-\x1F\x7F]", "")
        return F.trim(F.regexp_replace(visible, " {2,}", " "))

    return _each_string(df, scrub)


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of `schema`, absent ones as typed NULLs."""
    have = set(df.columns)
    return df.select(
        [
            (F.col(f.name) if f.name in have else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    return [n for n in schema.names if n not in set(df.columns)]


def parse_any_timestamp(c: Column, formats: list[str]) -> Column:
    """First format that fits, the ISO default before all; else NULL."""
    tries = [F.try_to_timestamp(c, F.lit(f)) for f in formats]
    return F.coalesce(c.try_cast("timestamp"), *tries)


def parse_timestamps(
    df: DataFrame,
    columns: list[str],
    formats: list[str],
    report: Observation | None = None,
) -> DataFrame:
    """Parse several columns; `report` counts the unreadable values of each."""
    parsed = {c: parse_any_timestamp(F.col(c), formats) for c in columns}
    if report is not None:
        bad = [
            F.count_if(F.col(c).isNotNull() & p.isNull()).alias(c)
            for c, p in parsed.items()
        ]
        df = df.observe(report, *bad)
    return df.withColumns(parsed)


def flag_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add `<column>_missing` for each reference column that is NULL."""
    return df.withColumns(
        {f"{c}_missing": F.col(c).isNull() for c in columns}
    )


def flag_orphans(
    df: DataFrame, parent: DataFrame, key: str, name: str = "is_orphan"
) -> DataFrame:
    """Add a flag telling rows whose `key` has no row in `parent`.

    The parent is reduced to distinct keys first, so repeated ones double
    nothing.  A NULL key is an orphan.
    """
    known = own_shuffle(parent.select(key).distinct(), key)
    return (
        df.join(known.withColumn("_known", F.lit(True)), key, "left")
        .withColumn(name, F.col("_known").isNull())
        .select(*df.columns, name)
    )
