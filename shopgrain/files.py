"""The few file-system calls Spark's DataFrame API does not cover."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from shopgrain.session import shared_dir


def _at(spark: SparkSession, path: str):
    """The Hadoop file system that serves `path`, and the path for it."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _at(spark, path)
    return fs.exists(jpath)


def found(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or any match of a path with wildcards, is there."""
    fs, jpath = _at(spark, pattern)
    hits = fs.globStatus(jpath)
    return hits is not None and len(hits) > 0


def children(spark: SparkSession, path: str) -> list[str]:
    """Names below a directory, sorted; empty where there is none."""
    fs, jpath = _at(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath))


def size(spark: SparkSession, path: str) -> int:
    fs, jpath = _at(spark, path)
    return fs.getContentSummary(jpath).getLength()


def remove(spark: SparkSession, path: str) -> None:
    fs, jpath = _at(spark, path)
    fs.delete(jpath, True)


def remove_if_empty(spark: SparkSession, path: str) -> None:
    if exists(spark, path) and not children(spark, path):
        remove(spark, path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing else writes there."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


class Scratch:
    """Results written once to the shared folder, gone when the block ends.

    Reading them back cuts the lineage: a lost executor costs a read, not the
    joins that led there.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self._paths:
            remove(self._spark, path)

    def written(self, df: DataFrame, label: str) -> tuple[DataFrame, int]:
        """`df` from disk, and its size there in bytes."""
        path = scratch_path(self._spark, label)
        self._paths.append(path)
        df.write.parquet(path)
        stored = self._spark.read.schema(df.schema).parquet(path)
        return stored, size(self._spark, path)
