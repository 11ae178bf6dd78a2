"""The daily chain: gate, side-by-side cleaning, record, load, publish, counts."""

import datetime as dt
import threading

import pytest

from shopgrain import files, pipeline
from shopgrain.operators import control, load
from shopgrain.schemas import TABLES
from shopgrain.sources.gate import MissingSource, source_check
from tests.test_pipeline import AT, FILES, _sources


def test_chain_records_loads_and_publishes(spark, tmp_path):
    zone, house, audit = (str(tmp_path / n) for n in ("z", "house", "audit"))
    sources = _sources(tmp_path, FILES)
    database = "chain_test"
    try:
        for day, run in (("2024-01-01", "r1"), ("2024-01-02", "r2")):
            at = AT.replace(tzinfo=dt.timezone.utc)
            counts = pipeline.run_chain(spark, sources, zone, house, day, audit, run, at, database=database)
            total = counts.where("table_name = 'TOTAL'").first()
            assert total.total_rows == 12
        assert spark.newSession().table(f"{database}.vw_customer_profile").first().lifetime_value == 17.0
        rows = {r.run_id: r for r in control.read_audit(spark, audit).collect()}
        assert {k: (r.status, r.files_loaded) for k, r in rows.items()} == {"r1": ("success", 8), "r2": ("success", 8)}
        assert rows["r2"].prev_load_timestamp == rows["r1"].load_timestamp
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_absent_source_stops_the_chain_before_any_write(spark, tmp_path):
    zone, house, audit = (str(tmp_path / n) for n in ("z", "house", "audit"))
    sources = _sources(tmp_path, FILES)
    sources["sellers"] = str(tmp_path / "nothing.csv")
    del sources["products"]
    with pytest.raises(MissingSource, match="products, sellers"):
        pipeline.run_chain(spark, sources, zone, house, "2024-01-01", audit, "r1", AT)
    assert not files.exists(spark, zone) and not files.exists(spark, house)
    assert [r.status for r in control.read_audit(spark, audit).collect()] == ["failed"]
    with pytest.raises(MissingSource, match="sellers"):
        pipeline.run_day(spark, sources, zone, house, "2024-01-01", AT)
    assert not files.exists(spark, zone)


def test_input_that_became_empty_is_not_loaded_from_earlier_output(spark, tmp_path):
    zone, house = str(tmp_path / "z"), str(tmp_path / "house")
    full = _sources(tmp_path, {"orders": FILES["orders"], "sellers": FILES["sellers"]})
    pipeline.clean_day(spark, full, zone, "2024-01-01", AT)
    empty = _sources(tmp_path, {"sellers": "seller_id\n"})
    pipeline.run_day(spark, {**full, **empty}, zone, house, "2024-01-01", AT)
    assert load.read_table(spark, "sellers", house).count() == 0
    assert load.read_table(spark, "orders", house).count() == 2


def test_source_check(spark, tmp_path):
    sources = _sources(tmp_path, {"orders": FILES["orders"], "sellers": "seller_id\n", "products": ""})
    got = {r.table_name: (r.outcome, r.row_count) for r in source_check(spark, sources, TABLES).collect()}
    assert got["orders"] == ("ready", 3) and got["sellers"] == got["products"] == ("empty", 0)
    assert got["customers"] == ("absent", None) and len(got) == 8


def test_read_report_and_strict_cleaning(spark, tmp_path):
    lines = [
        FILES["orders"].split("\r\n")[0],
        "o1;c1;shipped;06/01/2020 09:30;20200107;week 2;;",
        "none;n/a;\x07 Shipped\t;Jan 6, 2020;;;;2020-01-08",
    ]
    sources = _sources(tmp_path, {"orders": "\r\n".join(lines) + "\r\n", "sellers": "seller_id,seller_name\ns1,x\n"})
    reports = pipeline.clean_reports(spark, sources, str(tmp_path / "z"), "d", AT, pipeline.STRICT)
    rows = {r.table_name: r for r in pipeline.read_report(spark, reports).collect()}
    assert tuple(rows["orders"])[1:] == (2, 8, 1, 1) and tuple(rows["sellers"])[1:] == (1, 2, 0, 0)
    got = {r.order_id: r for r in spark.read.parquet(f"{tmp_path}/z/orders/partition=d").collect()}
    assert got["o1"].order_purchase_timestamp == dt.datetime(2020, 1, 6, 9, 30)
    assert got["o1"].order_approved_at == dt.datetime(2020, 1, 7) and got["o1"].order_delivered_carrier_date is None
    assert got[None].customer_trx_id is None and got[None].order_status == "shipped"
    usual = pipeline.clean_reports(spark, sources, str(tmp_path / "u"), "d", AT)
    assert usual["orders"]["bad_dates"] == 4


def test_tables_are_cleaned_side_by_side(spark, tmp_path, monkeypatch):
    """Two tables must be under way at once, or the barrier breaks."""
    sources = _sources(tmp_path, FILES)
    alone = pipeline.clean_reports(spark, sources, str(tmp_path / "a"), "d", AT, side_by_side=1)
    meet, real = threading.Barrier(2, timeout=60), pipeline.write_day

    def write(df, path):
        meet.wait()
        real(df, path)

    monkeypatch.setattr(pipeline, "write_day", write)
    together = pipeline.clean_reports(spark, sources, str(tmp_path / "b"), "d", AT, side_by_side=2)
    assert together == alone and list(together) == list(sources)
    for name in sources:
        a, b = (spark.read.parquet(f"{tmp_path}/{z}/{name}/partition=d").collect() for z in "ab")
        assert sorted(map(repr, a)) == sorted(map(repr, b))
