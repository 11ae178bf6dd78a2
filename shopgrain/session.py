"""Session settings every job here relies on, and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile

from pyspark.sql import SparkSession

# Settings that change results or the handling of hot keys.  The width of a
# shuffle and all memory sizes belong to the cluster and are left alone.
RUNTIME_SETTINGS = {
    # A calendar day means a UTC day in every table.
    "spark.sql.session.timeZone": "UTC",
    # Bad casts are spelled out as try_cast; anything else must fail loudly.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle downstream:
    # most joins here are on order_id and feed an aggregate that would
    # otherwise reuse the join's partitioning and so forbid the split.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # List the day directories of a fact table in some hundred tasks, not in
    # one task per directory.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "shopgrain",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Build a configured session; `settings` win over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only where the session names none (a local run) is a temporary one made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir(spark.sparkContext.applicationId)


@functools.cache
def _local_dir(_application: str) -> str:
    return tempfile.mkdtemp(prefix="shopgrain-")

