"""The eight sales tables seen in a TPC-H-like set of Parquet files.

Every source row becomes a row: nothing is filtered.  Rows that must not find
a partner (items of an unknown order, products never sold, ...) get a key that
does not exist on the other side.  Amounts are a thousandth of the source's so
that they spread over the report tiers.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.functions.labels import review_sentiment
from shopgrain.functions.numbers import round2
from shopgrain.schemas import TABLES

STAMP = dt.datetime(2024, 1, 1)


def _text(c: Column) -> Column:
    return c.cast("string")


def _key(c: Column, unknown: Column) -> Column:
    """`c` as text, marked so that it matches nothing where `unknown`."""
    return F.when(unknown, F.concat(F.lit("X"), _text(c))).otherwise(_text(c))


def _plus(unit: str, n: Column, ts: Column) -> Column:
    return F.timestamp_add(unit, n.cast("int"), ts)


def _stamp() -> Column:
    return F.lit(STAMP).cast("timestamp").alias("etl_timestamp")


def _postal(nation: Column) -> Column:
    return F.lpad(_text(nation), 5, "0")


class SalesTables(dict):
    """Tables by name, each built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self._spark = spark
        self._folder = folder.rstrip("/")

    def __missing__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(name)
        df = getattr(self, f"_{name}")()
        self[name] = df.select(TABLES[name].schema.names)
        return self[name]

    def everything(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in TABLES}

    def source(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{name}.parquet")

    def _orders(self) -> DataFrame:
        k, cust, letter = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
        ordered = F.col("o_orderdate").cast("timestamp")
        purchase = _plus("MINUTE", k % 1440, ordered)
        status = (
            F.when(letter == "F", "delivered")
            .when(letter == "O", "shipped")
            .when(k % 3 == 0, "canceled")
            .otherwise("processing")
        )
        sent = letter.isin("F", "O")
        return self.source("orders").select(
            _text(k).alias("order_id"),
            F.when(cust % 23 == 0, "NA").otherwise(_text(cust)).alias("customer_trx_id"),
            status.alias("order_status"),
            purchase.alias("order_purchase_timestamp"),
            F.when(k % 50 != 0, purchase).alias("order_approved_at"),
            F.when(sent, _plus("DAY", 1 + k % 5, purchase)).alias(
                "order_delivered_carrier_date"
            ),
            F.when(letter == "F", _plus("DAY", 3 + k % 40, purchase)).alias(
                "order_delivered_customer_date"
            ),
            _plus("DAY", F.lit(20), ordered).alias("order_estimated_delivery_date"),
            F.to_date(purchase).alias("sale_date"),
            _stamp(),
        )

    def _line_order(self) -> Column:
        k = F.col("l_orderkey")
        return _key(k, k % 37 == 0).alias("order_id")

    def item_lines(self) -> DataFrame:
        """Items as loaded day by day: the load stamp is the ship date."""
        part, supplier = F.col("l_partkey"), F.col("l_suppkey")
        shipped = F.col("l_shipdate").cast("timestamp")
        price = F.floor(F.col("l_extendedprice") / 10.0 + 0.5) / 100.0
        lines = self.source("lineitem").select(
            self._line_order(),
            F.col("l_linenumber").cast("long").alias("order_item_id"),
            _key(part, part % 29 == 0).alias("product_id"),
            _key(supplier, supplier % 19 == 0).alias("seller_id"),
            shipped.alias("shipping_limit_date"),
            price.alias("price"),
            (F.floor(price * F.col("l_discount") * 100.0 + 0.5) / 100.0).alias(
                "freight_value"
            ),
            F.to_date(shipped).alias("sale_date"),
            shipped.alias("etl_timestamp"),
        )
        return lines.withColumn(
            "total_item_value", round2(F.col("price") + F.col("freight_value"))
        )

    def _order_items(self) -> DataFrame:
        return self.item_lines().withColumn("etl_timestamp", _stamp())

    def _order_payments(self) -> DataFrame:
        returned = F.col("l_returnflag")
        kind = (
            F.when(returned == "R", "credit_card")
            .when(returned == "A", "boleto")
            .otherwise("voucher")
        )
        net = F.col("l_extendedprice") * (1.0 - F.col("l_discount"))
        return self.source("lineitem").select(
            self._line_order(),
            F.col("l_linenumber").cast("long").alias("payment_sequential"),
            kind.alias("payment_type"),
            (1 + F.col("l_quantity").cast("long") % 10).alias("payment_installments"),
            (F.floor(net / 10.0 + 0.5) / 100.0).alias("payment_value"),
            F.to_date(F.col("l_shipdate")).alias("sale_date"),
            _stamp(),
        )

    def _order_reviews(self) -> DataFrame:
        """Two reviews in a row share an order, every third order has some."""
        n = F.col("event_id")
        created = F.col("ts").cast("timestamp")
        order = F.floor(n / 2) * 3
        score = F.when(n % 11 != 0, 1 + n % 5)
        return self.source("events").select(
            _text(n).alias("review_id"),
            _key(order, n % 13 == 0).alias("order_id"),
            score.alias("review_score"),
            F.col("event_type").alias("review_comment_title_en"),
            F.col("props").alias("review_comment_message_en"),
            created.alias("review_creation_date"),
            _plus("MINUTE", F.col("user_id") * 37, created).alias(
                "review_answer_timestamp"
            ),
            review_sentiment(score).alias("review_sentiment"),
            F.to_date(created).alias("sale_date"),
            _stamp(),
        )

    def _nations(self) -> DataFrame:
        return self.source("nation").join(
            self.source("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )

    def _customers(self) -> DataFrame:
        k = F.col("c_custkey")
        joined_on = F.date_add(F.lit(dt.date(1995, 1, 1)), (k % 400).cast("int"))
        return (
            self.source("customer")
            .join(self._nations(), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                _text(k).alias("customer_trx_id"),
                F.col("c_name").alias("subscriber_id"),
                joined_on.alias("subscribe_date"),
                joined_on.alias("first_order_date"),
                _postal(F.col("c_nationkey")).alias("customer_postal_code"),
                F.col("n_name").alias("customer_city"),
                F.upper("r_name").alias("customer_country"),
                F.substring("r_name", 1, 2).alias("customer_country_code"),
                F.when(k % 31 != 0, 18 + k % 50).alias("age"),
                F.when(k % 2 == 0, "Male").otherwise("Female").alias("gender"),
                _stamp(),
            )
        )

    def _sellers(self) -> DataFrame:
        return (
            self.source("supplier")
            .join(self._nations(), F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .select(
                _text(F.col("s_suppkey")).alias("seller_id"),
                F.col("s_name").alias("seller_name"),
                _postal(F.col("s_nationkey")).alias("seller_postal_code"),
                F.col("n_name").alias("seller_city"),
                F.substring("r_name", 1, 2).alias("country_code"),
                F.upper("r_name").alias("seller_country"),
                _stamp(),
            )
        )

    def _products(self) -> DataFrame:
        k, size = F.col("p_partkey"), F.col("p_size")
        return self.source("part").select(
            _text(k).alias("product_id"),
            F.lower("p_type").alias("product_category_name"),
            F.when(k % 13 != 0, size * 150.0).alias("product_weight_gr"),
            (size * 1.0).alias("product_length_cm"),
            (size * 0.5).alias("product_height_cm"),
            F.lit(12.0).alias("product_width_cm"),
            round2(size * 1.0 * (size * 0.5) * 12.0).alias("product_volume_cm3"),
            _stamp(),
        )

    def _geolocations(self) -> DataFrame:
        n = F.col("n_nationkey")
        return self._nations().select(
            F.when(n % 8 == 7, F.concat(F.lit("X"), _text(n)))
            .otherwise(_postal(n))
            .alias("geo_postal_code"),
            (n * 6.5 - 75.0).alias("geo_lat"),
            (n * 13.25 - 160.0).alias("geo_lon"),
            F.col("n_name").alias("geolocation_city"),
            F.col("r_name").alias("geo_country"),
            _stamp(),
        )

    def geo_points(self) -> DataFrame:
        """One located point per customer: many rows per postal code."""
        k, n = F.col("c_custkey"), F.col("c_nationkey")
        return (
            self.source("customer")
            .join(self._nations(), n == F.col("n_nationkey"), "left")
            .select(
                _text(n).alias("geo_postal_code"),
                (n * 6.5 - 75.0 + (k % 16) * 0.25).alias("geo_lat"),
                (n * 13.25 - 160.0 + (k % 32) * 0.125).alias("geo_lon"),
                F.concat(F.lit("port of "), F.lower("n_name")).alias("geolocation_city"),
                F.lower("r_name").alias("geo_country"),
            )
        )


def as_raw_text(df: DataFrame, name: str) -> DataFrame:
    """A table as its delimited file might hold it: all text, with noise.

    Which cell gets which noise follows from the end of the key and the
    position of the column.  Key columns only get blanks around them.
    """
    table = TABLES[name]
    row = F.lit(0)
    for k in table.key:
        end = F.substring(_text(F.col(k)), -2, 2)
        row = row * 3 + F.ascii(end) + F.ascii(F.substring(end, -1, 1))
    cells = []
    for i, c in enumerate(table.source_columns):
        value, turn = _text(F.col(c)), (row + i) % 11
        cell = F.when(turn == 2, F.concat(F.lit("  "), value, F.lit(" ")))
        if c not in table.key:
            cell = (
                cell.when(turn == 0, "N/A")
                .when(turn == 1, "   ")
                .when(turn == 3, F.upper(value))
                .when(turn == 4, "None")
                .when(turn == 5, F.lit(None).cast("string"))
            )
            if table.schema[c].dataType.typeName() == "long":
                cell = cell.when(turn == 6, F.concat(value, F.lit(".0")))
        cells.append(cell.otherwise(value).alias(c))
    return df.select(cells)
