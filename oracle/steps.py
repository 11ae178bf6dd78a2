"""SQL for the single steps: cleaning, loading, control and roll-ups."""

from __future__ import annotations

from oracle.reports import CUSTOMER, CYCLE, DELAY, ORDER_SUMMARY, PARTS, SHIPPING, calendar
from oracle.tables import STAMP, STAR, big, cells, cents, mean, r2, with_tables
from shopgrain.schemas import TABLES

DAY = "DATE '1997-06-15'"
NOW = "TIMESTAMP '2024-01-12 00:00:00'"
TOKENS = "('', 'null', 'none', 'na', 'n/a', 'nan')"


def _sql(body: str, **more: str) -> str:
    return with_tables(body, {**PARTS, **more})


def _names(table: str) -> list[str]:
    return TABLES[table].schema.names


# ------------------------------------------------------------------- raw text


def raw_cte(table: str) -> str:
    """The noisy text form of a table; see `as_raw_text` for the rules."""
    t = TABLES[table]
    row = "0"
    for k in t.key:
        text = f"CAST({k} AS VARCHAR)"
        row = f"({row} * 3 + ascii(right({text}, 2)) + ascii(right({text}, 1)))"
    cells = []
    for i, c in enumerate(t.source_columns):
        v = f"CAST({c} AS VARCHAR)"
        noise = f"WHEN 2 THEN '  ' || {v} || ' '"
        if c not in t.key:
            noise += f" WHEN 0 THEN 'N/A' WHEN 1 THEN '   ' WHEN 3 THEN upper({v}) WHEN 4 THEN 'None' WHEN 5 THEN NULL"
            if t.schema[c].dataType.typeName() == "long":
                noise += f" WHEN 6 THEN {v} || '.0'"
        cells.append(f"CASE ({row} + {i}) % 11 {noise} ELSE {v} END AS {c}")
    source = "s_points" if table == "geolocations" else STAR[table]
    return f"SELECT {', '.join(cells)} FROM {source}"


def clean_cte(table: str, mark: str = "'NA'") -> str:
    cells = [
        f"CASE WHEN lower(trim({c})) IN {TOKENS} THEN {mark} ELSE trim({c}) END AS {c}"
        for c in TABLES[table].source_columns
    ]
    return f"SELECT {', '.join(cells)}, {STAMP} AS etl_timestamp FROM r_raw"


def _title(c: str) -> str:
    words = f"string_split(lower(trim({c})), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')"


CASING = {
    "customer_city": _title,
    "gender": _title,
    "seller_city": _title,
    "geolocation_city": _title,
    "customer_country": lambda c: f"upper({c})",
    "seller_country": lambda c: f"upper({c})",
    "country_code": lambda c: f"upper({c})",
    "geo_country": lambda c: f"upper({c})",
    "order_status": lambda c: f"lower({c})",
    "payment_type": lambda c: f"lower({c})",
    "product_category_name": lambda c: f"lower({c})",
    "customer_postal_code": lambda c: f"lpad({c}, 5, '0')",
    "seller_postal_code": lambda c: f"lpad({c}, 5, '0')",
}
DERIVED = {
    "order_items": f", {cells('(price + freight_value)')} AS total_item_value",
    "products": f", {cells('(product_length_cm * product_height_cm * product_width_cm)')} AS product_volume_cm3",
    "order_reviews": ", CASE WHEN review_score > 3 THEN 'positive' WHEN review_score = 3 THEN 'neutral' ELSE 'negative' END"
    " AS review_sentiment",
}


def conform_sql(table: str) -> str:
    t = TABLES[table]
    cells = []
    for c in t.source_columns:
        kind = t.schema[c].dataType.typeName()
        if kind == "long":
            made = f"CAST(TRY_CAST({c} AS DOUBLE) AS BIGINT)"
        elif kind in ("double", "date", "timestamp"):
            made = f"TRY_CAST({c} AS {kind.upper()})"
        else:
            made = CASING.get(c, str)(c)
        cells.append(f"{made} AS {c}")
    body = f"SELECT *{DERIVED.get(table, '')} FROM (SELECT {', '.join(cells)}, etl_timestamp FROM r_clean)"
    if table == "geolocations":
        body = (
            f"SELECT * EXCLUDE (pos) FROM (SELECT *, row_number() OVER (PARTITION BY geo_postal_code ORDER BY geo_lat"
            f" NULLS LAST, geo_lon NULLS LAST, geolocation_city NULLS LAST, geo_country NULLS LAST) AS pos FROM ({body}))"
            f" WHERE pos = 1"
        )
    return _sql(body, r_raw=raw_cte(table), r_clean=clean_cte(table))


CONFORM_SQL = {f"conform_{name}": conform_sql(name) for name in TABLES}

# -------------------------------------------------------------------- loading

FIRST_LINES = """
  SELECT * EXCLUDE (pos) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY etl_timestamp DESC, product_id, seller_id,
      shipping_limit_date, price, freight_value, sale_date, total_item_value) AS pos FROM s_lines) WHERE pos = 1"""
RETURNS = """
  SELECT order_id, CAST(1 AS BIGINT) AS order_item_id, 'NA' AS product_id, 'NA' AS seller_id,
         order_purchase_timestamp AS shipping_limit_date, 0e0 AS price, 0e0 AS freight_value, 0e0 AS total_item_value,
         sale_date, etl_timestamp
  FROM s_orders"""
LINE_COLUMNS = ", ".join(_names("order_items"))
SELLER_CUSTOMERS = """
  SELECT CASE WHEN CAST(seller_id AS BIGINT) % 19 = 0 THEN 'S' || seller_id ELSE seller_id END AS customer_trx_id,
         seller_name AS subscriber_id, CAST(NULL AS DATE) AS subscribe_date, CAST(NULL AS DATE) AS first_order_date,
         seller_postal_code AS customer_postal_code, seller_city AS customer_city, seller_country AS customer_country,
         country_code AS customer_country_code, CAST(NULL AS BIGINT) AS age, 'NA' AS gender, etl_timestamp
  FROM s_sellers"""
FACT_LOADED = _sql(
    f"""SELECT {LINE_COLUMNS} FROM r_first WHERE order_item_id <> 1 OR order_id NOT IN (SELECT order_id FROM s_orders)
    UNION ALL SELECT {LINE_COLUMNS} FROM r_returns""",
    r_first=FIRST_LINES,
    r_returns=RETURNS,
)
UPSERTED = _sql(
    """
SELECT * FROM s_customers c WHERE NOT EXISTS (SELECT 1 FROM r_batch b WHERE b.customer_trx_id = c.customer_trx_id)
UNION ALL SELECT * FROM r_batch""",
    r_batch=SELLER_CUSTOMERS,
)

FILES_TO_DAILY = _sql(
    f"""
SELECT sale_date, {calendar('sale_date', 'sale_year', 'sale_month', 'sale_day_name', 'sale_yearmonth')},
       count(*) AS total_orders, count(*) FILTER (dlv = 1) AS delivered_orders,
       count(*) FILTER (cnc = 1) AS canceled_orders, count(*) FILTER (dlv = 0 AND cnc = 0) AS pending_orders,
       {r2(cents('paid'))} AS daily_revenue, {r2(mean('paid'))} AS avg_order_value, {r2(cents('gmv'))} AS daily_gmv,
       {r2(cents('freight'))} AS daily_freight, CAST(sum(n) AS DOUBLE) AS total_items_sold,
       {r2('avg(delay)')} AS avg_delivery_delay_days, {r2('avg(shipped_in)')} AS avg_shipping_days,
       {r2('(CAST(count(*) FILTER (cnc = 1) AS DOUBLE) / count(*) * 100e0)')} AS cancellation_rate_pct
FROM q_order
LEFT JOIN (SELECT order_id, {r2(cents('payment_value'))} AS paid FROM (
    SELECT DISTINCT ON (order_id, payment_sequential) * FROM s_payments
    ORDER BY order_id, payment_sequential, payment_type, payment_installments, payment_value) GROUP BY 1) USING (order_id)
LEFT JOIN (SELECT order_id, count(*) AS n, {r2(cents('total_item_value'))} AS gmv,
                  {r2(cents('freight_value'))} AS freight FROM (
    SELECT DISTINCT ON (order_id, order_item_id) * FROM s_items
    ORDER BY order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value) GROUP BY 1)
  USING (order_id)
GROUP BY sale_date"""
)

OVER_VIEWS = f"""
SELECT customer_country, customer_segment, count(*) AS customers, max(lifetime_value) AS best_value
FROM ({CUSTOMER}) GROUP BY ALL"""

# Facts of each raw file: columns, and which rows have unreadable dates or blank keys.
RAW_WIDTH = {
    "orders": 8, "order_items": 7, "order_payments": 5, "order_reviews": 7, "customers": 10, "sellers": 6, "products": 6,
    "geolocations": 5,
}


def _read_report() -> str:
    parts = []
    for i, (name, width) in enumerate(RAW_WIDTH.items()):
        bad = f"count(*) FILTER (order_id LIKE '%7%' AND order_purchase_timestamp IS NOT NULL)" if name == "orders" else "0"
        blank = "count(*) FILTER (order_id LIKE '%7%')" if name == "order_payments" else "0"
        parts.append(
            f"SELECT '{name}' AS table_name, count(*) AS rows, {big(width)} AS columns, {big(bad)} AS bad_dates,"
            f" {big(blank)} AS missing_keys FROM ({raw_cte(name)})"
        )
    return _sql(" UNION ALL ".join(parts))


def _source_check() -> str:
    rows = [f"SELECT 'products' AS table_name, 'empty' AS outcome, {big(0)} AS row_count",
            f"SELECT 'sellers', 'absent', {big('NULL')}"]
    for name in RAW_WIDTH:
        if name not in ("products", "sellers"):
            source = "s_points" if name == "geolocations" else STAR[name]
            rows.append(f"SELECT '{name}', 'ready', count(*) FROM {source}")
    return _sql(" UNION ALL ".join(rows))


STRICT = _sql(f"""
SELECT order_id, nullif(customer_trx_id, 'NA') AS customer_trx_id, order_status,
       CASE CAST(order_id AS BIGINT) % 5 WHEN 0 THEN order_purchase_timestamp
         WHEN 1 THEN date_trunc('minute', order_purchase_timestamp) WHEN 4 THEN NULL
         ELSE date_trunc('day', order_purchase_timestamp) END AS order_purchase_timestamp,
       order_approved_at, order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
       {STAMP} AS etl_timestamp
FROM s_orders""")

# -------------------------------------------------------------------- control

AUDIT_ROWS = """
  SELECT 'staging' AS dag_id, strftime(hour, '%Y%m%d%H') AS run_id, CAST(hour AS DATE) AS logical_date, load_timestamp,
         CAST(NULL AS TIMESTAMP) AS prev_load_timestamp, files_loaded,
         CASE WHEN errors * 4 > n THEN 'failed' ELSE 'success' END AS status, CAST(NULL AS VARCHAR) AS notes
  FROM (SELECT date_trunc('hour', ts) AS hour, max(ts) AS load_timestamp, count(DISTINCT event_type) AS files_loaded,
               count(*) FILTER (event_type = 'error') AS errors, count(*) AS n FROM events GROUP BY 1)"""


def _each_table(columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {columns(TABLES[name])} FROM {cte}"
        for name, cte in STAR.items()
    )


def _audit_columns(t) -> str:
    day = f"count(*) FILTER (sale_date = {DAY})" if t.is_fact else "CAST(NULL AS BIGINT)"
    return f"count(*) AS total_rows, {day} AS day_rows"


# ------------------------------------------------------------------- roll-ups


def band(x: str, *cuts: tuple[int, str], top: str) -> str:
    """Label by rising upper bounds, written independently of the Spark side."""
    return "CASE " + " ".join(f"WHEN {x} < {n} THEN '{label}'" for n, label in cuts) + f" ELSE '{top}' END"


P = "(price * 100e0)"
BANDS = f"""
SELECT {band(P, (100, 'Inactive'), (500, 'Low Value'), (1000, 'Mid Value'), top='High Value')} AS customer_segment,
       {band(f'({P} * 2e0)', (100, 'No Sales'), (1000, 'Low Seller'), (10000, 'Good Seller'), top='Top Seller')} AS product_tier,
       {band(f'({P} * 8e0)', (1000, 'Bronze'), (10000, 'Silver'), (50000, 'Gold'), top='Platinum')} AS seller_tier,
       {band(P, (500, 'Light (< 500g)'), (2000, 'Medium (500g-2kg)'), (5000, 'Heavy (2kg-5kg)'), top='Very Heavy (5kg+)')}
         AS weight_bucket,
       {band(f'({P} * 4e0)', (1000, 'Small'), (5000, 'Medium'), (20000, 'Large'), top='Extra Large')} AS size_bucket,
       count(*) AS items
FROM s_items GROUP BY ALL"""
FLAGS = """coalesce(order_status = 'delivered', false) AS is_delivered,
       coalesce(order_status = 'canceled', false) AS is_canceled"""
METRICS = f"{DELAY} AS delivery_delay_days, {SHIPPING} AS shipping_days"

STEP_SQL = {
    "delimited_scan": _sql("SELECT * FROM r_raw", r_raw=raw_cte("orders")),
    "staging_round_trip": _sql("SELECT * EXCLUDE (sale_date) FROM s_payments"),
    "files_to_daily_sales": FILES_TO_DAILY,
    "sql_over_views": OVER_VIEWS,
    "clean_strings": _sql(
        "SELECT " + ", ".join(f"trim({c}) AS {c}" for c in TABLES["customers"].source_columns) + " FROM r_raw",
        r_raw=raw_cte("customers"),
    ),
    "clean_null_tokens": _sql(
        "SELECT * FROM r_clean", r_raw=raw_cte("order_reviews"), r_clean=clean_cte("order_reviews")
    ),
    "null_tokens_to_null": _sql(
        "SELECT * FROM r_clean", r_raw=raw_cte("order_reviews"), r_clean=clean_cte("order_reviews", "NULL")
    ),
    **CONFORM_SQL,
    "schema_align": _sql(
        "SELECT seller_id AS customer_trx_id, "
        + ", ".join(
            f"CAST(NULL AS {'VARCHAR' if f.dataType.typeName() == 'string' else f.dataType.typeName().replace('long', 'bigint')})"
            f" AS {f.name}"
            for f in TABLES["customers"].schema
            if f.name not in ("customer_trx_id", "etl_timestamp")
        )
        + ", etl_timestamp FROM s_sellers"
    ),
    "missing_value_flags": _sql(
        "SELECT review_id, order_id, review_score, order_id IS NULL AS order_id_missing,"
        " review_score IS NULL AS review_score_missing FROM s_reviews"
    ),
    "orphan_flags": _sql(
        "SELECT order_id, payment_sequential, payment_value,"
        " order_id NOT IN (SELECT order_id FROM s_orders) AS is_orphan FROM s_payments"
    ),
    "multi_format_dates": _sql("""
      SELECT order_id, CASE CAST(order_id AS BIGINT) % 5 WHEN 0 THEN order_purchase_timestamp
        WHEN 1 THEN date_trunc('minute', order_purchase_timestamp) WHEN 4 THEN NULL
        ELSE date_trunc('day', order_purchase_timestamp) END AS bought_at FROM s_orders"""),
    "scrub_text": r"""
      SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(text, '[\t\r\n]+', ' ', 'g'),
        '[\x00-\x1F\x7F]', '', 'g'), ' {2,}', ' ', 'g')) AS text FROM documents""",
    "geo_centroid": _sql(
        "SELECT geo_postal_code, avg(geo_lat) AS geo_lat, avg(geo_lon) AS geo_lon FROM s_points GROUP BY 1"
    ),
    "fact_dedup_latest": _sql(FIRST_LINES),
    "fact_batch_orders": _sql("SELECT * FROM s_orders"),
    "fact_sale_date_inherit": _sql(
        "SELECT f.* REPLACE (o.sale_date AS sale_date) FROM r_first f LEFT JOIN s_orders o ON o.order_id = f.order_id",
        r_first=FIRST_LINES,
    ),
    "partition_replace": _sql(
        f"SELECT {LINE_COLUMNS} FROM s_lines WHERE sale_date <> {DAY} UNION ALL SELECT {LINE_COLUMNS} FROM r_returns",
        r_returns=RETURNS,
    ),
    "fact_load": FACT_LOADED,
    "read_report": _read_report(),
    "source_check": _source_check(),
    "strict_cleaning": STRICT,
    "views_after_reload": ORDER_SUMMARY,
    "catalog_dimension": UPSERTED,
    "catalog_fact": FACT_LOADED,
    "read_during_load": _sql(
        f"""SELECT {LINE_COLUMNS}, 'before' AS reader FROM r_first
        UNION ALL SELECT {LINE_COLUMNS}, 'after' AS reader FROM r_first
        WHERE order_item_id <> 1 OR order_id NOT IN (SELECT order_id FROM s_orders)
        UNION ALL SELECT {LINE_COLUMNS}, 'after' AS reader FROM r_returns""",
        r_first=FIRST_LINES,
        r_returns=RETURNS,
    ),
    "fact_day_reload": _sql(
        f"""SELECT {LINE_COLUMNS} FROM r_first WHERE sale_date IS DISTINCT FROM {DAY}
        UNION ALL SELECT {LINE_COLUMNS} FROM r_returns""",
        r_first=FIRST_LINES,
        r_returns=RETURNS,
    ),
    "dimension_upsert": UPSERTED,
    "dimension_load": UPSERTED,
    "latest_success": _sql(
        "SELECT * FROM r_audit WHERE status = 'success' ORDER BY load_timestamp DESC LIMIT 1", r_audit=AUDIT_ROWS
    ),
    "audit_history": _sql(
        """SELECT * REPLACE (load_timestamp + CASE status WHEN 'failed' THEN INTERVAL 10 MINUTE ELSE INTERVAL 0 MINUTE END AS load_timestamp,
        'success' AS status) FROM r_audit""",
        r_audit=AUDIT_ROWS,
    ),
    "freshness_status": _sql(
        f"""SELECT CASE WHEN status <> 'success' THEN 'failed' WHEN age_hours > 25 THEN 'stale' ELSE 'fresh' END AS outcome,
        status, age_hours FROM (SELECT status, (epoch_us({NOW}) - epoch_us(load_timestamp)) / 3.6e9 AS age_hours
        FROM r_audit ORDER BY load_timestamp DESC LIMIT 1)""",
        r_audit=AUDIT_ROWS,
    ),
    "load_audit": _sql(
        f"SELECT * FROM r_counts UNION ALL SELECT 'TOTAL', {big('sum(total_rows)')}, {big('sum(day_rows)')} FROM r_counts",
        r_counts=_each_table(_audit_columns),
    ),
    "row_counts": _sql(_each_table(lambda t: "count(*) AS row_count")),
    "payment_totals": _sql(
        "SELECT order_id, paid AS total_payment_value, max_inst AS max_installments, top_type AS primary_payment_type,"
        " n_parts AS payment_parts_count FROM q_pay"
    ),
    "primary_payment_type": _sql("SELECT order_id, top_type AS primary_payment_type FROM q_pay"),
    "item_totals": _sql(
        "SELECT order_id, n AS total_items, n_prod AS unique_products, n_sell AS unique_sellers,"
        " goods AS items_subtotal, freight AS freight_total, gmv AS order_gmv FROM q_item"
    ),
    "review_totals": _sql(
        "SELECT order_id, stars AS avg_review_score, n AS total_reviews, n_good AS positive_reviews,"
        " n_mid AS neutral_reviews, n_bad AS negative_reviews FROM q_review"
    ),
    "seller_order_totals": _sql(
        f"""SELECT seller_id, order_id, count(order_item_id) AS items_in_order, {r2(cents('price'))} AS order_revenue,
        {r2(cents('freight_value'))} AS order_freight, {r2(mean('price'))} AS avg_item_price FROM s_items GROUP BY ALL"""
    ),
    "delivery_metrics": _sql(f"SELECT order_id, {FLAGS}, {METRICS} FROM s_orders"),
    "order_derived_columns": _sql(
        f"SELECT *, {calendar('sale_date')}, {FLAGS}, {METRICS}, {CYCLE} AS order_cycle_days FROM s_orders"
    ),
    "item_bands": _sql(BANDS),
    "review_labels": _sql("""
      SELECT review_score, CASE WHEN review_score IN (4, 5) THEN 'Positive' WHEN review_score = 3 THEN 'Neutral'
               ELSE 'Negative' END AS sentiment_bucket, any_value(review_sentiment) AS review_sentiment,
             coalesce(repeat('⭐', review_score) || ' ' ||
               ['Very Poor', 'Poor', 'Average', 'Good', 'Excellent'][review_score], 'No Rating') AS star_label,
             count(*) AS reviews
      FROM s_reviews GROUP BY review_score"""),
    "age_groups": _sql("""
      SELECT age, CASE WHEN age >= 55 THEN 'Senior (55+)' WHEN age >= 45 THEN 'Boomer (45-54)'
               WHEN age >= 35 THEN 'Gen X (35-44)' WHEN age >= 25 THEN 'Millennial (25-34)'
               WHEN age >= 0 THEN 'Gen Z (< 25)' ELSE 'Unknown' END AS age_group, count(*) AS customers
      FROM s_customers GROUP BY age"""),
}
