"""Loaded tables as catalog tables, for plain SQL in any session.

A catalog table holds no data of its own: the partitions of a fact table point
at the folders of its newest state, a dimension at its newest snapshot.  Days
change one statement after the other, so a reader of the catalog may see some
days of a load before others; `load.read_fact` sees whole loads only.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from shopgrain.operators import load, states
from shopgrain.schemas import TABLES, Table

PARTITIONS_PER_STATEMENT = 200
PUBLISHED = "shopgrain.state"


def _spec(day: states.Day) -> str:
    return "sale_date=null" if day is None else f"sale_date='{day.isoformat()}'"


def _blocks(days: list[states.Day]) -> list[list[states.Day]]:
    step = PARTITIONS_PER_STATEMENT
    return [days[i : i + step] for i in range(0, len(days), step)]


def _published(spark: SparkSession, name: str) -> int:
    """Number of the state the catalog table shows; 0 for none."""
    shown = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return int(shown.get(PUBLISHED, 0))


def _publish_fact(spark: SparkSession, table: Table, name: str, path: str) -> None:
    load.create_table(spark, table, name, path)
    shown = _published(spark, name)
    new = states.read_state(spark, path)
    if new.number == shown:
        return
    if shown in states.complete_states(spark, path):
        old = states.read_state(spark, path, shown).days
        changed = [d for d, there in new.days.items() if old.get(d) != there]
        gone = [d for d in old if d not in new.days]
    else:
        # What the table shows is not known any more: build its days anew.
        changed, gone = list(new.days), []
        for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
            value = row.partition.split("=", 1)[1]
            spec = "null" if value in ("null", "__HIVE_DEFAULT_PARTITION__") else f"'{value}'"
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (sale_date={spec})")
    for block in _blocks(gone + changed):
        specs = ", ".join(f"PARTITION ({_spec(d)})" for d in block)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")
        there = " ".join(
            f"PARTITION ({_spec(d)}) LOCATION '{states.day_dir(path, d, new.days[d])}'"
            for d in block
            if d in new.days
        )
        if there:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {there}")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PUBLISHED}'='{new.number}')")


def _publish_dimension(spark: SparkSession, table: Table, name: str, path: str) -> None:
    # Before the first load the table points at a folder without rows.
    newest = load.newest_snapshot(spark, path) or f"{path}/none"
    load.create_table(spark, table, name, newest)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{newest}'")


def publish_table(spark: SparkSession, table: Table, name: str, path: str) -> None:
    """Make `name` show what was last loaded at `path`; created where absent.

    Run it after every load: a fact folder that is replaced stays for as many
    loads as `load_fact` was told to keep states.
    """
    path = path.rstrip("/")
    (_publish_fact if table.is_fact else _publish_dimension)(spark, table, name, path)
    spark.catalog.refreshTable(name)


def publish_all(spark: SparkSession, warehouse: str, database: str) -> list[str]:
    """All eight tables of a warehouse folder in a database of the catalog."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for name, table in TABLES.items():
        publish_table(spark, table, f"{database}.{name}", f"{warehouse.rstrip('/')}/{name}")
        names.append(f"{database}.{name}")
    return names
