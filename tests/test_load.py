import datetime as dt

import pytest

from shopgrain.operators import load
from shopgrain.operators.dedup import keep_latest
from shopgrain.schemas import TABLES

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
D1, D2, D3 = dt.date(2020, 1, 1), dt.date(2020, 1, 2), dt.date(2020, 1, 3)
ORDERS, ITEMS = TABLES["orders"], TABLES["order_items"]
CUSTOMERS = TABLES["customers"]


def _order(key, day=D1, status="shipped", at=T1):
    when = dt.datetime.combine(day, dt.time(10)) if day else None
    return {
        "order_id": key, "order_status": status, "order_purchase_timestamp": when,
        "sale_date": day, "etl_timestamp": at,
    }


def _stored(spark, path, table=ORDERS):
    rows = load.read_fact(spark, table, path).collect()
    return sorted((r.order_id, r.order_status, r.sale_date) for r in rows)


# ---------------------------------------------------------------- DataFrames


def test_latest_wins(make):
    df = make("orders", _order("a", status="old", at=T1), _order("a", status="new", at=T2))
    assert [r.order_status for r in keep_latest(df, ["order_id"]).collect()] == ["new"]


def test_equal_stamps_are_decided_by_the_other_columns(make):
    rows = [_order("a", status=s) for s in "dbca"]
    for turn in (rows, rows[::-1]):
        kept = keep_latest(make("orders", *turn).repartition(3), ["order_id"]).collect()
        assert [r.order_status for r in kept] == ["a"]


def test_missing_stamp_loses_and_null_keys_are_one_key(make):
    df = make(
        "orders", _order("a", status="x", at=None), _order("a", status="y", at=T1),
        _order(None, status="p"), _order(None, status="q"),
    )
    kept = keep_latest(df, ["order_id"]).collect()
    assert sorted(r.order_status for r in kept) == ["p", "y"]


def test_sale_date_is_the_utc_day(make):
    late = {**_order("a"), "order_purchase_timestamp": dt.datetime(2020, 1, 1, 23, 59)}
    df = load.fact_batch(ORDERS, make("orders", late).drop("sale_date"))
    assert df.columns == ORDERS.schema.names
    assert df.first().sale_date == D1


def test_sale_date_comes_from_the_order(make):
    orders = make("orders", _order("a", D1), _order("b", D2))
    items = make(
        "order_items",
        *[{"order_id": k, "order_item_id": 1, "etl_timestamp": T1} for k in ("a", "b", "lost", None)],
    )
    got = load.fact_batch(ITEMS, items.drop("sale_date"), orders).collect()
    assert {r.order_id: r.sale_date for r in got} == {"a": D1, "b": D2, "lost": None, None: None}
    assert len(got) == 4


def test_upsert(make):
    target = make("orders", _order("keep"), _order("change"), _order(None))
    batch = make("orders", _order("change", status="done"), _order("new"), _order(None))
    got = load.upsert(target, batch, ["order_id"]).collect()
    assert sorted((str(r.order_id), r.order_status) for r in got) == [
        ("None", "shipped"), ("None", "shipped"), ("change", "done"),
        ("keep", "shipped"), ("new", "shipped"),
    ]
    safe = load.upsert(target, batch, ["order_id"], null_safe=True)
    assert safe.where("order_id IS NULL").count() == 1


def test_replace_day(make):
    existing = make("orders", _order("a", D1), _order("b", D2), _order("c", None))
    batch = make("orders", _order("d", D1), _order("b", D2))
    got = load.replace_day(existing, batch, D1).collect()
    assert sorted(r.order_id for r in got) == ["b", "b", "c", "d"]


# ------------------------------------------------------------------- Parquet


def test_fact_load_is_repeatable(spark, make, tmp_path):
    path = str(tmp_path / "orders")
    batch = make("orders", _order("a", D1), _order("b", D2), _order("c", None), _order(None, D1))
    for _ in range(2):
        load.load_fact(spark, ORDERS, path, batch)
    assert load.read_fact(spark, ORDERS, path).count() == 4


def test_only_touched_days_are_rewritten(spark, make, tmp_path):
    path = tmp_path / "orders"
    load.load_fact(spark, ORDERS, str(path), make("orders", _order("a", D1), _order("b", D2)))
    before = sorted(p.name for p in (path / "sale_date=2020-01-02").iterdir())
    load.load_fact(spark, ORDERS, str(path), make("orders", _order("a", D1, "late"), _order("n", D3)))
    assert sorted(p.name for p in (path / "sale_date=2020-01-02").iterdir()) == before
    assert _stored(spark, str(path)) == [("a", "late", D1), ("b", "shipped", D2), ("n", "shipped", D3)]


def test_row_that_changes_its_day_leaves_the_old_one(spark, make, tmp_path):
    path = tmp_path / "orders"
    load.load_fact(spark, ORDERS, str(path), make("orders", _order("a", D1), _order("b", D2), _order("c", D2)))
    load.load_fact(spark, ORDERS, str(path), make("orders", _order("a", D3), _order("b", D3)))
    assert _stored(spark, str(path)) == [("a", "shipped", D3), ("b", "shipped", D3), ("c", "shipped", D2)]
    assert not (path / "sale_date=2020-01-01").exists()


def test_plain_day_load(spark, make, tmp_path):
    path = str(tmp_path / "orders")
    load.load_fact_day(spark, ORDERS, path, make("orders", _order("a", D1), _order("b", D2)), D1)
    load.load_fact_day(spark, ORDERS, path, make("orders", _order("x", D1), _order("b", D2)), D1)
    assert [r[0] for r in _stored(spark, path)] == ["b", "b", "x"]
    load.load_fact_day(spark, ORDERS, path, make("orders", _order("y", D3)), D1)
    assert [r[0] for r in _stored(spark, path)] == ["b", "b", "y"]


def _customer(key, city, at=T1):
    return {"customer_trx_id": key, "customer_city": city, "etl_timestamp": at}


def test_dimension_snapshots(spark, make, tmp_path):
    path = tmp_path / "customers"
    batches = [
        [_customer("keep", "A"), _customer("change", "A"), _customer(None, "A")],
        [_customer("change", "B", T1), _customer("change", "C", T2), _customer("new", "B"), _customer(None, "A")],
        [_customer("new", "D")],
    ]
    for rows in batches:
        batch = load.dimension_batch(CUSTOMERS, make("customers", *rows))
        load.load_dimension(spark, CUSTOMERS, str(path), batch)
    got = load.read_dimension(spark, CUSTOMERS, str(path)).collect()
    assert sorted((str(r.customer_trx_id), r.customer_city) for r in got) == [
        ("None", "A"), ("None", "A"), ("change", "C"), ("keep", "A"), ("new", "D"),
    ]
    assert sorted(p.name for p in path.iterdir()) == ["snapshot=000000002", "snapshot=000000003"]


def test_unfinished_snapshot_is_not_read(spark, make, tmp_path):
    path = tmp_path / "customers"
    load.load_dimension(spark, CUSTOMERS, str(path), make("customers", _customer("a", "A")))
    (path / "snapshot=000000002").mkdir()
    assert load.read_dimension(spark, CUSTOMERS, str(path)).count() == 1
    load.load_dimension(spark, CUSTOMERS, str(path), make("customers", _customer("b", "B")))
    assert load.read_dimension(spark, CUSTOMERS, str(path)).count() == 2


def test_tables_read_empty_before_the_first_load(spark, tmp_path):
    for name, table in TABLES.items():
        df = load.read_table(spark, name, str(tmp_path))
        assert df.schema == table.schema and df.count() == 0


@pytest.mark.parametrize("name", ["orders", "customers"])
def test_create_and_drop_table(spark, tmp_path, name):
    table, view = TABLES[name], f"made_{name}"
    try:
        for _ in range(2):
            load.create_table(spark, table, view, str(tmp_path / name))
        made = spark.table(view)
        assert sorted(made.columns) == sorted(table.schema.names)
        parts = [c.name for c in spark.catalog.listColumns(view) if c.isPartition]
        assert parts == (["sale_date"] if table.is_fact else [])
    finally:
        for _ in range(2):
            load.drop_staging(spark, view)
    assert not spark.catalog.tableExists(view)


def test_dedup_is_cut_before_the_shuffle(make):
    plan = keep_latest(make("orders", _order("a")), ["order_id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    below = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below
