"""The sales tables as CTEs for DuckDB, over the same Parquet views.

Only the CTEs a query names are put in front of it.
"""

from __future__ import annotations

import re

STAMP = "TIMESTAMP '2024-01-01 00:00:00'"


def cells(x: str) -> str:
    """Half up on the decimal digits that the number is written with."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,17)), 2) AS DOUBLE)"


def r2(x: str) -> str:
    return f"(sign({x}) * floor(abs({x}) * 100e0 + 0.5e0) / 100e0 + 0e0)"


def cents(x: str) -> str:
    """Exact sum of an amount with two decimals, as a double."""
    return f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def mean(x: str) -> str:
    return f"({cents(x)} / count({x}))"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def pct(part: str, whole: str) -> str:
    return r2(f"(CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100e0)")


def unknown(key: str, cond: str) -> str:
    return f"CASE WHEN {cond} THEN 'X' ELSE '' END || {key}"


LINE_ORDER = unknown("l_orderkey", "l_orderkey % 37 = 0")
PRICE = "(floor(l_extendedprice / 10e0 + 0.5e0) / 100e0)"
FREIGHT = f"(floor({PRICE} * l_discount * 100e0 + 0.5e0) / 100e0)"
NET = "(l_extendedprice * (1e0 - l_discount))"

CTES = {
    "s_orders": f"""
      SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
             CASE o_custkey % 23 WHEN 0 THEN 'NA' ELSE CAST(o_custkey AS VARCHAR) END AS customer_trx_id,
             CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'
                  WHEN o_orderkey % 3 = 0 THEN 'canceled' ELSE 'processing' END AS order_status,
             bought AS order_purchase_timestamp,
             CASE WHEN o_orderkey % 50 <> 0 THEN bought END AS order_approved_at,
             CASE WHEN o_orderstatus IN ('F', 'O') THEN bought + to_days(CAST(1 + o_orderkey % 5 AS INTEGER)) END
               AS order_delivered_carrier_date,
             CASE WHEN o_orderstatus = 'F' THEN bought + to_days(CAST(3 + o_orderkey % 40 AS INTEGER)) END
               AS order_delivered_customer_date,
             o_orderdate + to_days(20) AS order_estimated_delivery_date,
             CAST(bought AS DATE) AS sale_date, {STAMP} AS etl_timestamp
      FROM (SELECT *, o_orderdate + to_minutes(o_orderkey % 1440) AS bought FROM orders)""",
    "s_lines": f"""
      SELECT {LINE_ORDER} AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id,
             {unknown('l_partkey', 'l_partkey % 29 = 0')} AS product_id,
             {unknown('l_suppkey', 'l_suppkey % 19 = 0')} AS seller_id,
             l_shipdate AS shipping_limit_date, {PRICE} AS price, {FREIGHT} AS freight_value,
             {r2(f'({PRICE} + {FREIGHT})')} AS total_item_value,
             CAST(l_shipdate AS DATE) AS sale_date, l_shipdate AS etl_timestamp
      FROM lineitem""",
    "s_items": f"SELECT * REPLACE ({STAMP} AS etl_timestamp) FROM s_lines",
    "s_payments": f"""
      SELECT {LINE_ORDER} AS order_id, CAST(l_linenumber AS BIGINT) AS payment_sequential,
             CASE l_returnflag WHEN 'R' THEN 'credit_card' WHEN 'A' THEN 'boleto' ELSE 'voucher' END AS payment_type,
             1 + CAST(l_quantity AS BIGINT) % 10 AS payment_installments,
             floor({NET} / 10e0 + 0.5e0) / 100e0 AS payment_value,
             CAST(l_shipdate AS DATE) AS sale_date, {STAMP} AS etl_timestamp
      FROM lineitem""",
    "s_reviews": f"""
      SELECT CAST(event_id AS VARCHAR) AS review_id,
             {unknown('((event_id // 2) * 3)', 'event_id % 13 = 0')} AS order_id,
             score AS review_score, event_type AS review_comment_title_en, props AS review_comment_message_en,
             ts AS review_creation_date, ts + to_minutes(user_id * 37) AS review_answer_timestamp,
             CASE WHEN score > 3 THEN 'positive' WHEN score > 2 THEN 'neutral' ELSE 'negative' END AS review_sentiment,
             CAST(ts AS DATE) AS sale_date, {STAMP} AS etl_timestamp
      FROM (SELECT *, CASE WHEN event_id % 11 <> 0 THEN 1 + event_id % 5 END AS score FROM events)""",
    "s_nations": "SELECT * FROM nation LEFT JOIN region ON n_regionkey = r_regionkey",
    "s_customers": f"""
      SELECT CAST(c_custkey AS VARCHAR) AS customer_trx_id, c_name AS subscriber_id, joined AS subscribe_date,
             joined AS first_order_date, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_postal_code,
             n_name AS customer_city, upper(r_name) AS customer_country, left(r_name, 2) AS customer_country_code,
             CASE WHEN c_custkey % 31 <> 0 THEN 18 + c_custkey % 50 END AS age,
             CASE c_custkey % 2 WHEN 0 THEN 'Male' ELSE 'Female' END AS gender, {STAMP} AS etl_timestamp
      FROM (SELECT *, DATE '1995-01-01' + CAST(c_custkey % 400 AS INTEGER) AS joined FROM customer)
      LEFT JOIN s_nations ON c_nationkey = n_nationkey""",
    "s_sellers": f"""
      SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, s_name AS seller_name,
             lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_postal_code, n_name AS seller_city,
             left(r_name, 2) AS country_code, upper(r_name) AS seller_country, {STAMP} AS etl_timestamp
      FROM supplier LEFT JOIN s_nations ON s_nationkey = n_nationkey""",
    "s_products": f"""
      SELECT CAST(p_partkey AS VARCHAR) AS product_id, lower(p_type) AS product_category_name,
             CASE WHEN p_partkey % 13 <> 0 THEN p_size * 150e0 END AS product_weight_gr,
             p_size * 1e0 AS product_length_cm, p_size * 0.5e0 AS product_height_cm, 12e0 AS product_width_cm,
             {r2('(p_size * (p_size * 0.5e0) * 12e0)')} AS product_volume_cm3, {STAMP} AS etl_timestamp
      FROM part""",
    "s_geo": f"""
      SELECT CASE n_nationkey % 8 WHEN 7 THEN 'X' || n_nationkey
                  ELSE lpad(CAST(n_nationkey AS VARCHAR), 5, '0') END AS geo_postal_code,
             n_nationkey * 6.5e0 - 75e0 AS geo_lat, n_nationkey * 13.25e0 - 160e0 AS geo_lon,
             n_name AS geolocation_city, r_name AS geo_country, {STAMP} AS etl_timestamp
      FROM s_nations""",
    "s_points": """
      SELECT CAST(c_nationkey AS VARCHAR) AS geo_postal_code,
             c_nationkey * 6.5e0 - 75e0 + (c_custkey % 16) * 0.25e0 AS geo_lat,
             c_nationkey * 13.25e0 - 160e0 + (c_custkey % 32) * 0.125e0 AS geo_lon,
             'port of ' || lower(n_name) AS geolocation_city, lower(r_name) AS geo_country
      FROM customer LEFT JOIN s_nations ON c_nationkey = n_nationkey""",
}
# Table name -> CTE.
STAR = {
    "orders": "s_orders",
    "order_items": "s_items",
    "order_payments": "s_payments",
    "order_reviews": "s_reviews",
    "customers": "s_customers",
    "sellers": "s_sellers",
    "products": "s_products",
    "geolocations": "s_geo",
}


def with_tables(body: str, extra: dict[str, str] | None = None) -> str:
    """`body` preceded by every CTE it needs, directly or through another."""
    known = {**CTES, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b[a-z]+_[a-z_]+\b", text):
            if name in known and name not in needed:
                visit(known[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{n} AS ({known[n]})" for n in needed)
    return f"WITH {ctes}\n{body}"
