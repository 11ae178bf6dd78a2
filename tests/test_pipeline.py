"""Delimited files to views, loaded day after day."""

import datetime as dt

from shopgrain import cli, files, pipeline
from shopgrain.operators import load
from shopgrain.schemas import TABLES
from shopgrain.session import shared_dir

AT = dt.datetime(2024, 1, 1)

FILES = {
    "orders": (
        "﻿Order_ID;customer_trx_id;order_status;order_purchase_timestamp;order_approved_at;"
        "order_delivered_carrier_date;order_delivered_customer_date;order_estimated_delivery_date\r\n"
        "o1; c1 ;DELIVERED;2020-01-06 09:00:00;n/a;2020-01-07 10:00:00;2020-01-09;2020-01-08\r\n"
        "o1; c1 ;DELIVERED;2020-01-06 09:00:00;n/a;2020-01-07 10:00:00;2020-01-09;2020-01-08\r\n"
        "o2;c1;canceled;2020-01-07 23:59:59;;;;NA\r\n"
    ),
    "order_items": (
        "order_id|order_item_id|product_id|seller_id|shipping_limit_date|price|freight_value\n"
        "o1|1|p1|s1|2020-01-08|10.5|1.5\no1|2|p1|s1|bad|NA|2\nlost|1|p1|s1|2020-01-08|3|0\n"
    ),
    "order_payments": (
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
        "o1,1, Credit_Card ,2.0,12.00\no2,1,boleto,1,5\n"
    ),
    "order_reviews": (
        "review_id\torder_id\treview_score\treview_comment_title_en\treview_comment_message_en\t"
        "review_creation_date\treview_answer_timestamp\n"
        "r1\to1\t2\tlate\t none \t2020-01-10\t2020-01-11 05:30:00\n"
    ),
    "customers": (
        "customer_trx_id,subscriber_id,subscribe_date,first_order_date,customer_postal_code,customer_city,"
        "customer_country,customer_country_code,age,gender\n"
        "c1,u1,2019-01-01,2019-02-01,7,porto alegre,brazil,BR,44.0,MALE\n"
    ),
    "sellers": (
        "seller_id,seller_name,seller_postal_code,seller_city,country_code,seller_country\n"
        "s1,Shop,7,rio,br,brazil\n"
    ),
    "products": (
        "product_id,product_category_name,product_weight_gr,product_length_cm,product_height_cm\n"
        "p1,Toys,100,10,2.5\n"
    ),
    "geolocations": (
        "geo_postal_code,geo_lat,geo_lon,geolocation_city,geo_country\n"
        "00007,-30.0,-51.2,porto alegre,brazil\n00007,-30.0,-51.0,porto alegre,brazil\n"
    ),
}


def _sources(folder, files):
    out = {}
    for name, content in files.items():
        path = folder / f"{name}.csv"
        path.write_bytes(content.encode("utf-8"))
        out[name] = str(path)
    return out


def test_two_runs_of_one_day_and_a_second_day(spark, tmp_path):
    zone, house = str(tmp_path / "processed"), str(tmp_path / "house")
    sources = _sources(tmp_path, FILES)
    for _ in range(2):
        views = pipeline.run_day(spark, sources, zone, house, "2024-01-01", AT)
    assert len(views) == 8
    tables = pipeline.open_tables(spark, house)
    counts = {name: df.count() for name, df in tables.items()}
    assert counts == {
        "orders": 2, "order_items": 3, "order_payments": 2, "order_reviews": 1,
        "customers": 1, "sellers": 1, "products": 1, "geolocations": 1,
    }
    for name, df in tables.items():
        assert df.schema == TABLES[name].schema
    row = spark.table("vw_daily_sales_performance").where("sale_date = '2020-01-06'").first()
    assert (row.total_orders, row.daily_revenue, row.daily_gmv, row.avg_delivery_delay_days) == (1, 12.0, 12.0, 1.0)
    row = spark.table("vw_customer_profile").first()
    assert (row.customer_postal_code, row.customer_city, row.age, row.gender) == ("00007", "Porto Alegre", 44, "Male")
    assert (row.geo_lat, row.lifetime_value) == (-30.0, 17.0)
    row = tables["products"].first()
    assert row.product_width_cm is None and row.product_volume_cm3 is None
    row = tables["order_reviews"].first()
    assert row.review_comment_message_en == "NA" and row.sale_date == dt.date(2020, 1, 6)
    lost = tables["order_items"].where("order_id = 'lost'").first()
    assert lost.sale_date is None

    next_day = {
        "orders": FILES["orders"].split("\r\n")[0] + "\r\no2;c1;delivered;2020-01-07 23:59:59;;;;NA\r\n"
        "lost;c1;shipped;2020-01-09 01:00:00;;;;NA\r\n",
        "order_items": FILES["order_items"].split("\n")[0] + "\nlost|1|p1|s1|2020-01-08|4|0\n",
        "customers": FILES["customers"].split("\n")[0] + "\n",
    }
    fresh = _sources(tmp_path, next_day)
    pipeline.run_day(spark, fresh, zone, house, "2024-01-02", AT + dt.timedelta(1))
    got = {r.order_id: r.order_status for r in load.read_table(spark, "orders", house).collect()}
    assert got == {"o1": "delivered", "o2": "delivered", "lost": "shipped"}
    items = load.read_table(spark, "order_items", house)
    moved = items.where("order_id = 'lost'").collect()
    assert [(r.price, r.sale_date) for r in moved] == [(4.0, dt.date(2020, 1, 9))]
    assert load.read_table(spark, "customers", house).count() == 1


def test_cleaning_reads_the_input_once(spark, tmp_path):
    sources = _sources(tmp_path, {"orders": FILES["orders"], "sellers": "seller_id\n"})
    counts = pipeline.clean_day(spark, sources, str(tmp_path / "z"), "d", AT)
    assert counts == {"orders": 3, "sellers": 0}
    df = pipeline.clean_table(spark, "orders", sources["orders"], AT)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Exchange" not in plan


def test_jobs_from_the_command_line(spark, tmp_path, capsys):
    """The session of the tests is reused by each command."""
    sources = _sources(tmp_path, FILES)
    zone, house, audit = (str(tmp_path / n) for n in ("z", "house", "audit"))
    for name in ("orders", "sellers"):
        cli.main(["clean", name, sources[name], f"{zone}/{name}/partition=2024-01-01"])
    cli.main(["load", zone, house, "2024-01-01"])
    cli.main(["record", audit, "staging", "run-1", "2024-01-01"])
    cli.main(["freshness", audit])
    assert capsys.readouterr().out.strip().endswith("fresh")
    assert load.read_table(spark, "orders", house).count() == 2
    assert load.read_table(spark, "sellers", house).count() == 1


def test_loads_leave_no_scratch_behind(spark, make, tmp_path):
    before = files.children(spark, shared_dir(spark))
    batch = make("orders", {"order_id": "a", "sale_date": dt.date(2020, 1, 1)})
    for _ in range(2):
        load.load_fact(spark, TABLES["orders"], str(tmp_path / "t"), batch)
    load.load_fact(spark, TABLES["orders"], str(tmp_path / "t"), batch.limit(0))
    assert files.children(spark, shared_dir(spark)) == before
    assert load.read_fact(spark, TABLES["orders"], str(tmp_path / "t")).count() == 1
