import pytest
from pyspark.sql import Observation

from shopgrain.schemas import TABLES
from shopgrain.sources.delimited import (
    header_name,
    read_delimited,
    sniff_separator,
)
from shopgrain.sources.parquet import day_path, read_staging, write_day


def _file(tmp_path, content, name="in.csv"):
    path = tmp_path / name
    path.write_bytes(content.encode("utf-8"))
    return str(path)


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
def test_separator_of_first_line(spark, tmp_path, sep):
    assert sniff_separator(spark, _file(tmp_path, f"a{sep}b{sep}c\n1;1,1|1\t1\n")) == sep


def test_separator_tie_goes_to_comma(spark, tmp_path):
    assert sniff_separator(spark, _file(tmp_path, "a,b;c\n")) == ","


def test_separator_of_empty_file(spark, tmp_path):
    assert sniff_separator(spark, _file(tmp_path, "")) == ","


@pytest.mark.parametrize(
    "raw, name",
    [("﻿Order-ID", "order_id"), (" Name X ", "name_x"), ("Price\r", "price")],
)
def test_header_name(raw, name):
    assert header_name(raw) == name


def test_bom_crlf_semicolons(spark, tmp_path):
    path = _file(tmp_path, "﻿Order-ID;Item No;Price\r\n1; x ;NA\r\n2;;5\r\n")
    df = read_delimited(spark, path)
    assert df.columns == ["order_id", "item_no", "price"]
    assert set(dict(df.dtypes).values()) == {"string"}
    assert [tuple(r) for r in df.orderBy("order_id").collect()] == [
        ("1", " x ", "NA"),
        ("2", None, "5"),
    ]


def test_inferred_types_on_request(spark, tmp_path):
    df = read_delimited(spark, _file(tmp_path, "a|b\n1|2.5\n"), infer_schema=True)
    assert dict(df.dtypes) == {"a": "int", "b": "double"}


def test_report_comes_with_the_first_action(spark, tmp_path):
    seen = Observation("read")
    df = read_delimited(spark, _file(tmp_path, "a,b\n1,2\n3,4\n"), report=seen)
    df.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"rows": 2, "columns": 2}


def test_day_is_overwritten_and_read_in_table_types(spark, make, tmp_path):
    zone = str(tmp_path)
    path = day_path(zone, "order_payments", "2024-01-01")
    rows = make("order_payments", {"order_id": "a", "payment_sequential": 1})
    for _ in range(2):
        narrow = rows.drop("sale_date").withColumn(
            "payment_sequential", rows.payment_sequential.cast("int")
        )
        write_day(narrow, path)
    back = read_staging(spark, zone, "order_payments", "2024-01-01")
    assert back.columns == TABLES["order_payments"].cleaned_columns
    assert dict(back.dtypes)["payment_sequential"] == "bigint"
    assert back.count() == 1
