import datetime as dt

import pytest

from shopgrain.operators import control

UTC = dt.timezone.utc
NOW = dt.datetime(2024, 1, 3, 12, tzinfo=UTC)
DAY = dt.date(2024, 1, 3)


def _record(spark, path, hours_ago, status="success"):
    control.record_load(
        spark, path, "staging", f"run-{hours_ago}", DAY, status=status,
        now=NOW - dt.timedelta(hours=hours_ago),
    )


def test_no_table_and_empty_table_are_a_first_load(spark, tmp_path):
    path = str(tmp_path / "audit")
    assert control.check_freshness(spark, path, NOW) == "first_load"
    for _ in range(2):
        control.ensure_audit(spark, path)
    assert control.check_freshness(spark, path, NOW) == "first_load"


def test_recent_load_is_fresh(spark, tmp_path):
    path = str(tmp_path / "audit")
    _record(spark, path, 30, "failed")
    _record(spark, path, 25)
    assert control.check_freshness(spark, path, NOW) == "fresh"


@pytest.mark.parametrize("hours, status", [(26, "success"), (2, "failed")])
def test_old_or_failed_load_stops(spark, tmp_path, hours, status):
    path = str(tmp_path / "audit")
    _record(spark, path, 50)
    _record(spark, path, hours, status)
    with pytest.raises(control.StaleSource):
        control.check_freshness(spark, path, NOW)


def test_row_points_back_at_the_last_good_load(spark, tmp_path):
    path = str(tmp_path / "audit")
    control.ensure_audit(spark, path)
    _record(spark, path, 9)
    _record(spark, path, 6, "failed")
    _record(spark, path, 3)
    rows = control.read_audit(spark, path).orderBy("load_timestamp").collect()
    at = [(NOW - dt.timedelta(hours=h)).replace(tzinfo=None) for h in (9, 6, 3)]
    assert [r.load_timestamp for r in rows] == at
    assert [r.prev_load_timestamp for r in rows] == [None, at[0], at[0]]
    assert rows[0].files_loaded == 8 and "8 files" in rows[0].notes
    assert (tmp_path / "audit" / "load_day=2024-01-03").exists()


def test_counts(star):
    tables = star(
        orders=[{"order_id": "a", "sale_date": DAY}, {"order_id": "b"}],
        customers=[{"customer_trx_id": "c"}],
    )
    got = {r.table_name: (r.total_rows, r.day_rows) for r in control.load_audit(tables, DAY).collect()}
    assert got["orders"] == (2, 1) and got["customers"] == (1, None)
    assert got["order_items"] == (0, 0) and got["TOTAL"] == (3, 1)
    counts = {r.table_name: r.row_count for r in control.row_counts(tables).collect()}
    assert len(counts) == 8 and counts["orders"] == 2 and counts["sellers"] == 0
