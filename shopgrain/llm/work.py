"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from shopgrain.files import remove, scratch_path, size
from shopgrain.session import configure

# A relation of at most this many bytes on disk may be sent to every executor.
BROADCAST_BYTES = 32 << 20
# For rows of some MB each.  By default a hundred rows are gathered before their
# bytes are looked at, and a reader then takes all of them at once.
LARGE_ROWS = {
    "parquet.block.size": str(16 << 20),
    "parquet.block.size.row.check.min": "1",
    "parquet.block.size.row.check.max": "1",
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "1",
}


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the package's settings and small batches for Python.

    Texts may be long; a batch of rows must fit a worker several times over.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return configure(spark)


_works: list[Work] = []


@contextlib.contextmanager
def temporary() -> Iterator[None]:
    """Tables that operators write inside the block go when it ends.

    For results that are written before that; others would lose their input.
    """
    before = len(_works)
    try:
        yield
    finally:
        for work in _works[before:]:
            work.clear()
        del _works[before:]


class Work:
    """Tables that an operator writes and reads again.

    A lost executor then costs a read and not the work before it.  What the
    returned DataFrame still reads stays until the program ends; everything
    else goes with `drop`.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[int, str] = {}
        self._held: dict[int, DataFrame] = {}
        _works.append(self)
        atexit.register(self._end)

    def put(self, df: DataFrame, label: str, large_rows: bool = False) -> DataFrame:
        """`df`, written once and read back; large rows are written and read a few at a time."""
        path = scratch_path(self.spark, f"llm-{label}")
        df.write.options(**(LARGE_ROWS if large_rows else {})).parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(stored)] = path
        # The number identifies the table for as long as it is referenced here.
        self._held[id(stored)] = stored
        return stored

    def bytes(self, stored: DataFrame) -> int:
        return size(self.spark, self._paths[id(stored)])

    def small(self, stored: DataFrame) -> bool:
        return self.bytes(stored) <= BROADCAST_BYTES

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self._paths.pop(id(table), None)
            self._held.pop(id(table), None)
            if path:
                remove(self.spark, path)

    def clear(self) -> None:
        self.drop(*self._held.values())
        atexit.unregister(self._end)

    def _end(self) -> None:
        for path in self._paths.values():
            with contextlib.suppress(Exception):  # the session may be gone
                remove(self.spark, path)
