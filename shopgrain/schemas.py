"""The eight sales tables and the load-audit table: columns, keys, layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


@dataclass(frozen=True)
class Table:
    """One table: `kind` decides how a batch is loaded into it."""

    name: str
    kind: str  # "fact" or "dimension"
    key: tuple[str, ...]
    columns: str  # "name type, name type, ..."
    cluster_by: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        fields = (c.split() for c in self.columns.split(","))
        return T.StructType([T.StructField(n, _TYPES[t]) for n, t in fields])

    @property
    def is_fact(self) -> bool:
        return self.kind == "fact"

    @property
    def cleaned_columns(self) -> list[str]:
        """Columns present before the load adds `sale_date`."""
        return [n for n in self.schema.names if n != "sale_date"]

    @property
    def source_columns(self) -> list[str]:
        """Columns expected in the delimited file."""
        return [n for n in self.cleaned_columns if n not in DERIVED_COLUMNS]


# Columns that cleaning adds to what the file holds.
DERIVED_COLUMNS = {
    "etl_timestamp",
    "total_item_value",
    "review_sentiment",
    "product_volume_cm3",
}

_ALL = (
    Table(
        "orders", "fact", ("order_id",),
        "order_id string, customer_trx_id string, order_status string,"
        "order_purchase_timestamp timestamp, order_approved_at timestamp,"
        "order_delivered_carrier_date timestamp,"
        "order_delivered_customer_date timestamp,"
        "order_estimated_delivery_date timestamp,"
        "sale_date date, etl_timestamp timestamp",
    ),
    Table(
        "order_items", "fact", ("order_id", "order_item_id"),
        "order_id string, order_item_id long, product_id string,"
        "seller_id string, shipping_limit_date timestamp, price double,"
        "freight_value double, total_item_value double,"
        "sale_date date, etl_timestamp timestamp",
    ),
    Table(
        "order_payments", "fact", ("order_id", "payment_sequential"),
        "order_id string, payment_sequential long, payment_type string,"
        "payment_installments long, payment_value double,"
        "sale_date date, etl_timestamp timestamp",
    ),
    Table(
        "order_reviews", "fact", ("review_id",),
        "review_id string, order_id string, review_score long,"
        "review_comment_title_en string, review_comment_message_en string,"
        "review_creation_date timestamp, review_answer_timestamp timestamp,"
        "review_sentiment string, sale_date date, etl_timestamp timestamp",
    ),
    Table(
        "customers", "dimension", ("customer_trx_id",),
        "customer_trx_id string, subscriber_id string, subscribe_date date,"
        "first_order_date date, customer_postal_code string,"
        "customer_city string, customer_country string,"
        "customer_country_code string, age long, gender string,"
        "etl_timestamp timestamp",
        ("customer_country", "gender"),
    ),
    Table(
        "sellers", "dimension", ("seller_id",),
        "seller_id string, seller_name string, seller_postal_code string,"
        "seller_city string, country_code string, seller_country string,"
        "etl_timestamp timestamp",
        ("seller_country", "country_code"),
    ),
    Table(
        "products", "dimension", ("product_id",),
        "product_id string, product_category_name string,"
        "product_weight_gr double, product_length_cm double,"
        "product_height_cm double, product_width_cm double,"
        "product_volume_cm3 double, etl_timestamp timestamp",
        ("product_category_name",),
    ),
    Table(
        "geolocations", "dimension", ("geo_postal_code",),
        "geo_postal_code string, geo_lat double, geo_lon double,"
        "geolocation_city string, geo_country string,"
        "etl_timestamp timestamp",
        ("geo_country", "geo_postal_code"),
    ),
)

TABLES: dict[str, Table] = {t.name: t for t in _ALL}
FACTS = [t.name for t in _ALL if t.is_fact]
DIMENSIONS = [t.name for t in _ALL if not t.is_fact]

# One row per completed load; `load_day` is the partition column on disk.
LOAD_AUDIT_SCHEMA = T.StructType([
    T.StructField("dag_id", T.StringType(), False),
    T.StructField("run_id", T.StringType(), False),
    T.StructField("logical_date", T.DateType(), False),
    T.StructField("load_timestamp", T.TimestampType(), False),
    T.StructField("prev_load_timestamp", T.TimestampType(), True),
    T.StructField("files_loaded", T.LongType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("notes", T.StringType(), True),
])
