"""What readers see while fact tables are loaded, and what a load reads."""

import datetime as dt

import pytest

from shopgrain.operators import load, states
from shopgrain.schemas import TABLES

ORDERS = TABLES["orders"]
D1, D2, D3 = dt.date(2020, 1, 1), dt.date(2020, 1, 2), dt.date(2020, 1, 3)


def _order(key, day, status="x"):
    return {"order_id": key, "sale_date": day, "order_status": status}


def _rows(df):
    return sorted((str(r.order_id), r.order_status, r.sale_date) for r in df.collect())


def test_reader_keeps_the_state_it_began_with(spark, make, tmp_path):
    path = str(tmp_path / "orders")
    load.load_fact(spark, ORDERS, path, make("orders", _order("a", D1), _order("b", D2)), keep=2)
    before = load.read_fact(spark, ORDERS, path)
    load.load_fact(spark, ORDERS, path, make("orders", _order("a", D3, "y")), keep=2)
    assert _rows(before) == [("a", "x", D1), ("b", "x", D2)]
    assert _rows(load.read_fact(spark, ORDERS, path)) == [("a", "y", D3), ("b", "x", D2)]
    load.load_fact(spark, ORDERS, path, make("orders", _order("c", D3)), keep=2)
    assert not (tmp_path / "orders" / "sale_date=2020-01-01").exists()


def test_key_index_is_written_by_many_tasks(spark, make, tmp_path):
    path = tmp_path / "orders"
    rows = [_order(str(k), D1) for k in range(400)]
    load.load_fact(spark, ORDERS, str(path), make("orders", *rows))
    parts = list((path / "keys").glob("load=*/bucket=*/part-*.parquet"))
    assert len({p.name.split("-")[1] for p in parts}) > 1  # one task for a batch of any size, before
    assert len(parts) == len({p.parent for p in parts})  # a bucket is still one file
    assert load.read_fact(spark, ORDERS, str(path)).count() == 400


@pytest.mark.parametrize("broken", ["write_days", "index_batch", "commit"])
@pytest.mark.parametrize("by_day", [False, True])
def test_failed_load_leaves_the_old_state(spark, make, tmp_path, monkeypatch, broken, by_day):
    path = str(tmp_path / "orders")
    load.load_fact(spark, ORDERS, path, make("orders", _order("a", D1), _order("b", D2)))
    batch = make("orders", _order("a", D2, "y"), _order("n", D1))
    run = (lambda: load.load_fact_day(spark, ORDERS, path, batch, D1)) if by_day else (
        lambda: load.load_fact(spark, ORDERS, path, batch)
    )
    real = getattr(states, broken)

    def fail(*args):
        if broken != "commit":
            real(*args)  # what it wrote stays behind
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(states, broken, fail)
        with pytest.raises(OSError):
            run()
    assert _rows(load.read_fact(spark, ORDERS, path)) == [("a", "x", D1), ("b", "x", D2)]
    run()
    want = [("a", "y", D2), ("b", "x", D2), ("n", "x", D1)]
    assert _rows(load.read_fact(spark, ORDERS, path)) == want


def test_state_without_its_mark_does_not_count(spark, make, tmp_path):
    path = tmp_path / "orders"
    load.load_fact(spark, ORDERS, str(path), make("orders", _order("a", D1)))
    (path / "state=000000002").mkdir()
    assert _rows(load.read_fact(spark, ORDERS, str(path))) == [("a", "x", D1)]
    load.load_fact(spark, ORDERS, str(path), make("orders", _order("b", D1)))
    assert len(_rows(load.read_fact(spark, ORDERS, str(path)))) == 2
    assert states.read_state(spark, str(path)).number == 3


def test_old_days_are_not_read_by_a_load(spark, make, tmp_path):
    """Days no key of the batch was on may even be unreadable."""
    path = tmp_path / "orders"
    load.load_fact(spark, ORDERS, str(path), make("orders", _order("a", D1), _order("b", D2)))
    for part in (path / "sale_date=2020-01-02").rglob("*.parquet"):
        part.write_bytes(b"no parquet")
    for crc in (path / "sale_date=2020-01-02").rglob(".*.crc"):
        crc.unlink()
    load.load_fact(spark, ORDERS, str(path), make("orders", _order("a", D3), _order("c", D3)))
    left = load.read_fact(spark, ORDERS, str(path)).where("sale_date <> DATE'2020-01-02'")
    assert _rows(left) == [("a", "x", D3), ("c", "x", D3)]
    with pytest.raises(Exception):
        load.load_fact(spark, ORDERS, str(path), make("orders", _order("b", D3)))


def test_lookup_reads_the_buckets_of_the_batch(spark, make, tmp_path):
    path = str(tmp_path / "orders")
    rows = [_order(str(i), D1) for i in range(300)] + [_order(None, D2)]
    load.load_fact(spark, ORDERS, path, make("orders", *rows))
    state = states.read_state(spark, path)
    batch = make("orders", _order("7", D3), _order(None, D3), _order("new", D3))
    known = states.known_keys(spark, ORDERS, path, state, batch)
    assert _rows(known.selectExpr("order_id", "'x' AS order_status", "sale_date")) == [("7", "x", D1), ("None", "x", D2)]
    plan = known._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PartitionFilters"):]
    assert "bucket" in scan[: scan.index("PushedFilters")] and "sale_date=" not in plan


def test_index_grows_with_new_keys_only_and_parts_are_merged(spark, make, tmp_path, monkeypatch):
    monkeypatch.setattr(states, "KEY_PARTS", 3)
    path = str(tmp_path / "orders")
    batch = make("orders", _order("a", D1), _order("b", D1))
    for _ in range(3):
        load.load_fact(spark, ORDERS, path, batch)
    assert len(states.read_state(spark, path).keys) == 1
    for i, day in enumerate([D2, D3, D1, D2]):
        load.load_fact(spark, ORDERS, path, make("orders", _order("a", day), _order(f"n{i}", day)))
        assert len(states.read_state(spark, path).keys) <= 3
    state = states.read_state(spark, path)
    index = states.read_keys(spark, ORDERS, path, state).select("order_id", "sale_date")
    assert index.count() == index.distinct().count()
    stored = load.read_fact(spark, ORDERS, path).select("order_id", "sale_date")
    assert stored.subtract(index).count() == 0 and stored.count() == 6


def test_repeated_rows_empty_batches_and_bad_keep(spark, make, tmp_path):
    path = str(tmp_path / "orders")
    load.load_fact(spark, ORDERS, path, make("orders"))
    assert states.read_state(spark, path) == states.State()
    load.load_fact(spark, ORDERS, path, make("orders", _order("a", D1), _order("a", D1)))
    assert load.read_fact(spark, ORDERS, path).count() == 2
    load.load_fact(spark, ORDERS, path, make("orders", _order("a", D2)))
    assert _rows(load.read_fact(spark, ORDERS, path)) == [("a", "x", D2)]
    with pytest.raises(ValueError):
        load.load_fact(spark, ORDERS, path, make("orders", _order("a", D2)), keep=0)


def test_old_rows_meet_only_the_known_keys_of_a_batch(spark, make, tmp_path, monkeypatch):
    """A large batch is not shuffled against the days it touches."""
    path = str(tmp_path / "orders")
    load.load_fact(spark, ORDERS, path, make("orders", _order("a", D1), _order("b", D1), _order(None, D2)))
    met, upsert = [], load.upsert

    def seen(target, batch, keys, null_safe=False, known=None):
        met.append(_rows(known.selectExpr("order_id", "'x' AS order_status", "sale_date")))
        return upsert(target, batch, keys, null_safe, known)

    monkeypatch.setattr(load, "upsert", seen)
    new = [_order(f"n{k}", D1) for k in range(20)]
    load.load_fact(spark, ORDERS, path, make("orders", _order("a", D3), _order(None, D1), *new, new[0]))
    assert met == [[("None", "x", D2), ("a", "x", D1)]] or met == [[("a", "x", D1), ("None", "x", D2)]]
    got = _rows(load.read_fact(spark, ORDERS, path))
    assert sorted(got, key=str) == sorted([("a", "x", D3), ("b", "x", D1), ("None", "x", D1), *((f"n{k}", "x", D1) for k in [0, *range(20)])], key=str)
    state = states.read_state(spark, path)
    index = states.read_keys(spark, ORDERS, path, state).select("order_id", "sale_date")
    assert index.count() == index.distinct().count() == 3 + 2 + 20
