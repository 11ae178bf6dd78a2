import datetime as dt

from pyspark.sql import Observation

from shopgrain.operators import clean
from shopgrain.schemas import TABLES

AT = dt.datetime(2024, 1, 1)
CELLS = [" x ", "  ", None, " NULL ", "n/a", "NaN", "none", "nano", "", "na"]


def _cells(spark):
    rows = list(enumerate(CELLS))
    return spark.createDataFrame(rows, "n int, c string")


def _values(df):
    return [r.c for r in df.orderBy("n").collect()]


def test_blanks_and_null_tokens(spark):
    want = ["x", "NA", None, "NA", "NA", "NA", "NA", "nano", "NA", "NA"]
    assert _values(clean.clean(_cells(spark), AT)) == want


def test_single_steps_give_the_same(spark):
    steps = clean.unify_nulls(clean.trim_strings(_cells(spark)))
    assert _values(steps) == _values(clean.clean(_cells(spark), AT))


def test_null_tokens_as_nulls(spark):
    want = ["x", None, None, None, None, None, None, "nano", None, None]
    assert _values(clean.clean(_cells(spark), AT, mark=None)) == want


def test_other_types_are_left_alone(spark):
    assert dict(clean.clean(_cells(spark)).dtypes) == {
        "n": "int", "c": "string", "etl_timestamp": "timestamp",
    }


def test_stamp_is_one_value(spark):
    stamped = clean.stamp(spark.range(100).repartition(4))
    assert stamped.select("etl_timestamp").distinct().count() == 1
    fixed = clean.stamp(spark.range(1), AT).first()
    assert fixed.etl_timestamp == AT


def test_absent_columns_become_typed_nulls(spark, text):
    schema = TABLES["products"].schema
    df = clean.align_to_schema(text(["product_id", "extra"], ("p", "q")), schema)
    assert df.schema == schema or df.dtypes == [
        (f.name, f.dataType.simpleString()) for f in schema
    ]
    assert df.first().product_weight_gr is None
    assert "product_weight_gr" in clean.missing_columns(
        text(["product_id"], ("p",)), schema
    )


def test_missing_and_orphan_flags(spark, text):
    child = text(["id", "k"], ("1", "a"), ("2", "z"), ("3", None))
    parent = text(["k"], ("a",), ("a",), ("b",))
    flagged = clean.flag_orphans(clean.flag_missing(child, ["k"]), parent, "k")
    got = {r.id: (r.k_missing, r.is_orphan) for r in flagged.collect()}
    assert got == {"1": (False, False), "2": (False, True), "3": (True, True)}


def test_dates_in_several_formats(spark, text):
    seen = Observation("dates")
    df = clean.parse_timestamps(
        text(
            ["t"], ("2017-10-02 10:56:33",), ("02/10/2017 10:56",), ("20171002",),
            ("soon",), (None,),
        ),
        ["t"],
        ["dd/MM/yyyy HH:mm", "yyyyMMdd"],
        seen,
    )
    assert [r.t for r in df.collect()] == [
        dt.datetime(2017, 10, 2, 10, 56, 33),
        dt.datetime(2017, 10, 2, 10, 56),
        dt.datetime(2017, 10, 2),
        None,
        None,
    ]
    assert seen.get == {"t": 1}


def test_control_characters_and_blanks(spark, text):
    df = clean.scrub_strings(text(["t"], (" a\u0000b\u0007  c\t\r\nd \u007f",), (None,)))
    assert [r.t for r in df.collect()] == ["ab c d", None]


def test_clean_is_one_projection(spark):
    plan = clean.clean(_cells(spark), AT)._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("Project") <= 1
