"""Jobs for spark-submit: ``python -m shopgrain.cli <command> ...``."""

from __future__ import annotations

import argparse
import datetime as dt

from shopgrain import pipeline
from shopgrain.operators import control
from shopgrain.schemas import TABLES
from shopgrain.session import build_session


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="shopgrain")
    commands = parser.add_subparsers(dest="command", required=True)

    clean = commands.add_parser("clean", help="clean one table's files")
    clean.add_argument("table", choices=sorted(TABLES))
    clean.add_argument("source")
    clean.add_argument("output")

    load = commands.add_parser("load", help="load all tables cleaned for a day")
    load.add_argument("zone")
    load.add_argument("warehouse")
    load.add_argument("day")

    show = commands.add_parser("publish", help="catalog tables and views of a warehouse")
    show.add_argument("warehouse")
    show.add_argument("database")

    audit = commands.add_parser("audit", help="row counts after a load")
    audit.add_argument("warehouse")
    audit.add_argument("day", type=dt.date.fromisoformat)

    record = commands.add_parser("record", help="note a finished source load")
    record.add_argument("path")
    record.add_argument("dag_id")
    record.add_argument("run_id")
    record.add_argument("day", type=dt.date.fromisoformat)

    fresh = commands.add_parser("freshness", help="fail unless the source is fresh")
    fresh.add_argument("path")
    fresh.add_argument("--max-hours", type=float, default=control.MAX_AGE_HOURS)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"shopgrain-{args.command}")
    if args.command == "clean":
        pipeline.clean_to(spark, args.table, args.source, args.output)
    elif args.command == "load":
        pipeline.load_day(spark, args.zone, args.warehouse, args.day)
    elif args.command == "publish":
        print("\n".join(pipeline.publish(spark, args.warehouse, args.database)))
    elif args.command == "audit":
        tables = pipeline.open_tables(spark, args.warehouse)
        control.load_audit(tables, args.day).show(truncate=False)
    elif args.command == "record":
        control.ensure_audit(spark, args.path)
        control.record_load(spark, args.path, args.dag_id, args.run_id, args.day)
    else:
        print(control.check_freshness(spark, args.path, max_age_hours=args.max_hours))


if __name__ == "__main__":
    main()
