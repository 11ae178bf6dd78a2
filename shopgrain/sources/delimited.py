"""Delimited text in: separator sniffing, header names, read report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Separators tried; on equal counts the earlier one wins.
SEPARATORS = [",", ";", "\t", "|"]


def sniff_separator(spark: SparkSession, path: str) -> str:
    """The separator seen most often in the first line of the input."""
    first = spark.read.text(path).first()
    line = first["value"] if first else ""
    return max(SEPARATORS, key=line.count)


def header_name(raw: str) -> str:
    """One column name: no BOM or line break, lower case, underscores."""
    kept = "".join(ch for ch in raw if ch not in "\ufeff\r\n")
    return kept.strip().lower().translate({ord(" "): "_", ord("-"): "_"})


def with_clean_header(df: DataFrame) -> DataFrame:
    return df.toDF(*map(header_name, df.columns))


def read_delimited(
    spark: SparkSession,
    path: str,
    infer_schema: bool = False,
    report: Observation | None = None,
) -> DataFrame:
    """Scan a file or directory of delimited text with a header.

    All columns are strings unless `infer_schema`.  Line ends are left to
    Spark, which takes LF and CRLF alike, so no carriage return sticks to the
    last value.  With `report`, row and column counts arrive with the first
    action on the result, without a scan of their own.
    """
    df = with_clean_header(
        spark.read.csv(
            path,
            header=True,
            sep=sniff_separator(spark, path),
            encoding="UTF-8",
            inferSchema=infer_schema,
        )
    )
    return observed(df, report) if report else df


def observed(df: DataFrame, report: Observation) -> DataFrame:
    return df.observe(
        report,
        F.count(F.lit(1)).alias("rows"),
        F.max(F.lit(len(df.columns))).alias("columns"),
    )
