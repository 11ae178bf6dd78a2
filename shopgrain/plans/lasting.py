"""The eight reports as SQL texts, for views that a catalog keeps.

A temporary view holds a plan of one session and of the files it saw.  A
stored view holds text only and is planned anew over the catalog's tables
whenever it is read, so it follows every load and outlives the session.  Each
text has the shape of the DataFrame report of the same name.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from shopgrain.functions import labels

INF = "CAST('Infinity' AS DOUBLE)"


def _r2(x: str) -> str:
    near = f"signum({x}) * floor(abs({x}) * 100D + 0.5D) / 100D + 0D"
    return f"CASE WHEN abs({x}) < 4503599627370496D THEN {near} ELSE {x} END"


def _units(x: str) -> str:
    return f"CASE WHEN abs({x}) < {INF} THEN CAST({x} AS DECIMAL(28,10)) END"


def _odd(x: str) -> str:
    return f"CASE WHEN abs({x}) >= {INF} THEN {x} END"


def _total(x: str) -> str:
    return f"coalesce(sum({_odd(x)}), CAST(sum({_units(x)}) AS DOUBLE))"


def _mean(x: str) -> str:
    return f"({_total(x)} / count({x}))"


def _pct(part: str, whole: str) -> str:
    return _r2(f"(try_divide({part}, {whole}) * 100D)")


def _bands(x: str, sign: str, bands: Iterable[tuple[int, str]], rest: str) -> str:
    arms = " ".join(f"WHEN {x} {sign} {bound} THEN '{label}'" for bound, label in bands)
    return f"CASE {arms} ELSE '{rest}' END"


def _calendar(day: str, *parts: str) -> str:
    made = {
        "sale_year": f"CAST(year({day}) AS BIGINT)",
        "sale_month": f"CAST(month({day}) AS BIGINT)",
        "sale_day": f"CAST(dayofmonth({day}) AS BIGINT)",
        "sale_day_name": f"date_format({day}, 'EEEE')",
        "sale_yearmonth": f"date_format({day}, 'yyyy-MM')",
    }
    return ", ".join(f"{made[p]} AS {p}" for p in (parts or made))


def _gap(later: str, earlier: str) -> str:
    return f"CAST(datediff(to_date({later}), to_date({earlier})) AS BIGINT)"


def _zero(*columns: str, kind: str = "BIGINT") -> str:
    return ", ".join(f"coalesce({c}, CAST(0 AS {kind})) AS {c}" for c in columns)


MONTH = ("sale_year", "sale_month", "sale_yearmonth")
DELIVERED, CANCELED = "order_status = 'delivered'", "order_status = 'canceled'"
DELAY = _gap("order_delivered_customer_date", "order_estimated_delivery_date")
SHIPPING = _gap("order_delivered_customer_date", "order_delivered_carrier_date")
CYCLE = _gap("order_delivered_customer_date", "order_purchase_timestamp")
SENTIMENT = "CASE WHEN review_score >= 4 THEN 'Positive' WHEN review_score = 3 THEN 'Neutral' ELSE 'Negative' END"
STARS = (
    "CASE " + " ".join(f"WHEN review_score = {n} THEN '{s}'" for n, s in labels.STARS.items())
    + f" ELSE '{labels.NO_STARS}' END"
)
LARGEST = "struct(payment_value IS NULL, -payment_value, payment_sequential, payment_type)"
PLACE = "customer_country, customer_country_code, customer_city, customer_postal_code"
STATUS_COUNTS = "count_if(is_delivered) AS delivered_orders, count_if(is_canceled) AS canceled_orders"

# Common parts; `{db}` is the database, each view names the parts it reads.
PARTS = {
    "facts": f"""SELECT order_id, customer_trx_id, order_status, sale_date, {DELIVERED} AS is_delivered,
      {CANCELED} AS is_canceled, {DELAY} AS delivery_delay_days, {SHIPPING} AS shipping_days FROM {{db}}.orders""",
    "paid": f"""SELECT order_id, {_r2(_total('payment_value'))} AS total_payment_value,
      max(payment_installments) AS max_installments, min_by(payment_type, {LARGEST}) AS primary_payment_type,
      count(payment_sequential) AS payment_parts_count FROM {{db}}.order_payments GROUP BY order_id""",
    "sold": f"""SELECT order_id, count(order_item_id) AS total_items, count(DISTINCT product_id) AS unique_products,
      {_r2(_total('price'))} AS items_subtotal, {_r2(_total('freight_value'))} AS freight_total,
      {_r2(_total('total_item_value'))} AS order_gmv
      FROM {{db}}.order_items WHERE order_id IS NOT NULL GROUP BY order_id""",
    "order_sellers": """SELECT order_id, count(DISTINCT seller_id) AS unique_sellers
      FROM {db}.order_items WHERE order_id IS NOT NULL GROUP BY order_id""",
    "reviewed": f"""SELECT order_id, {_r2('avg(review_score)')} AS avg_review_score, count(review_id) AS total_reviews,
      count_if(review_score >= 4) AS positive_reviews, count_if(review_score = 3) AS neutral_reviews,
      count_if(review_score <= 2) AS negative_reviews FROM {{db}}.order_reviews GROUP BY order_id""",
    # A full join has no known partitioning, so that a busy order id can be split.
    "context": """SELECT * FROM (SELECT order_id, is_delivered, is_canceled, delivery_delay_days, shipping_days FROM facts)
      FULL JOIN reviewed USING (order_id)""",
    "points": """SELECT geo_postal_code, geolocation_city, geo_country, try_cast(geo_lat AS DECIMAL(38,18)) AS lat,
      try_cast(geo_lon AS DECIMAL(38,18)) AS lon FROM {db}.geolocations""",
    "centres": """SELECT concat(geo_postal_code) AS postal, CAST(sum(lat) AS DOUBLE) / count(lat) AS geo_lat,
      CAST(sum(lon) AS DOUBLE) / count(lon) AS geo_lon FROM points GROUP BY geo_postal_code""",
}


def _text(body: str, *names: str, **more: str) -> str:
    parts = {**{n: PARTS[n] for n in names}, **more}
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in parts.items()) + "\n" + body


REPORT_TEXTS: dict[str, str] = {
    "order_summary": _text(
        f"""SELECT order_id, customer_trx_id, order_status, order_purchase_timestamp, order_approved_at,
        order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date, sale_date,
        {_calendar('sale_date')}, coalesce({DELIVERED}, false) AS is_delivered, coalesce({CANCELED}, false) AS is_canceled,
        coalesce(order_status IN ('shipped', 'out_for_delivery'), false) AS is_in_transit,
        {DELAY} AS delivery_delay_days, {SHIPPING} AS shipping_days, {CYCLE} AS order_cycle_days,
        total_payment_value, max_installments, primary_payment_type, payment_parts_count, total_items, unique_products,
        unique_sellers, items_subtotal, freight_total, order_gmv,
        {_r2('abs(coalesce(total_payment_value, 0D) - coalesce(order_gmv, 0D))')} AS payment_vs_gmv_diff, etl_timestamp
        FROM {{db}}.orders LEFT JOIN paid USING (order_id)
        LEFT JOIN (SELECT * FROM sold LEFT JOIN order_sellers USING (order_id)) USING (order_id)""",
        "paid", "sold", "order_sellers",
    ),
    "daily_sales_performance": _text(
        f"""SELECT sale_date, {_calendar('sale_date', 'sale_year', 'sale_month', 'sale_day_name', 'sale_yearmonth')},
        total_orders, delivered_orders, canceled_orders,
        total_orders - delivered_orders - canceled_orders AS pending_orders, daily_revenue, avg_order_value, daily_gmv,
        daily_freight, total_items_sold, avg_delivery_delay_days, avg_shipping_days,
        {_pct('canceled_orders', 'total_orders')} AS cancellation_rate_pct FROM days ORDER BY sale_date""",
        "facts", "paid", "sold",
        days=f"""SELECT sale_date, count(DISTINCT order_id) AS total_orders, {STATUS_COUNTS},
        {_r2(_total('total_payment_value'))} AS daily_revenue, {_r2(_mean('total_payment_value'))} AS avg_order_value,
        {_r2(_total('order_gmv'))} AS daily_gmv, {_r2(_total('freight_total'))} AS daily_freight,
        CAST(sum(total_items) AS DOUBLE) AS total_items_sold, {_r2('avg(delivery_delay_days)')} AS avg_delivery_delay_days,
        {_r2('avg(shipping_days)')} AS avg_shipping_days
        FROM facts LEFT JOIN paid USING (order_id) LEFT JOIN sold USING (order_id) GROUP BY sale_date""",
    ),
    "customer_profile": _text(
        f"""SELECT customer_trx_id, subscriber_id, age, gender, CASE WHEN age IS NULL THEN '{labels.AGE_UNKNOWN}' ELSE
        {_bands('age', '<', labels.AGE_GROUPS, labels.AGE_OLDEST)} END AS age_group, subscribe_date, first_order_date,
        customer_postal_code, customer_city, customer_country, customer_country_code, geo_lat, geo_lon,
        {_zero('total_orders')},
        {_zero('lifetime_value', 'avg_order_value', 'max_order_value', 'min_order_value', kind='DOUBLE')},
        first_purchase_date, last_purchase_date,
        coalesce(CAST(datediff(last_purchase_date, first_purchase_date) AS BIGINT), 0L) AS customer_tenure_days,
        {_zero('delivered_orders', 'canceled_orders')}, {_zero('avg_delivery_delay_days', kind='DOUBLE')},
        {_bands('lifetime_value', '>=', labels.CUSTOMER_SEGMENTS, labels.CUSTOMER_REST)} AS customer_segment, etl_timestamp
        FROM {{db}}.customers LEFT JOIN totals USING (customer_trx_id) LEFT JOIN centres ON postal = customer_postal_code""",
        "facts", "paid", "points", "centres",
        totals=f"""SELECT customer_trx_id, count(DISTINCT order_id) AS total_orders,
        {_r2(_total('total_payment_value'))} AS lifetime_value, {_r2(_mean('total_payment_value'))} AS avg_order_value,
        {_r2('max(total_payment_value)')} AS max_order_value, {_r2('min(total_payment_value)')} AS min_order_value,
        min(sale_date) AS first_purchase_date, max(sale_date) AS last_purchase_date, {STATUS_COUNTS},
        {_r2('avg(delivery_delay_days)')} AS avg_delivery_delay_days
        FROM facts LEFT JOIN paid USING (order_id) GROUP BY customer_trx_id""",
    ),
    "seller_performance": _text(
        f"""SELECT seller_id, seller_name, seller_city, seller_country, country_code, seller_postal_code, geo_lat, geo_lon,
        {_zero('total_orders', 'total_items_sold')}, {_zero('total_revenue', 'total_freight', 'avg_item_price', kind='DOUBLE')},
        avg_review_score, {_zero('total_reviews', 'delivered_orders', 'canceled_orders')}, avg_delivery_delay_days,
        avg_shipping_days, {_bands('total_revenue', '>=', labels.SELLER_TIERS, labels.SELLER_REST)} AS seller_tier,
        {_pct('coalesce(canceled_orders, 0L)', 'coalesce(total_orders, 1)')} AS cancellation_rate_pct, etl_timestamp
        FROM {{db}}.sellers LEFT JOIN totals USING (seller_id) LEFT JOIN centres ON postal = seller_postal_code""",
        "facts", "reviewed", "context", "points", "centres",
        pairs=f"""SELECT seller_id, order_id, count(order_item_id) AS items_in_order, {_r2(_total('price'))} AS order_revenue,
        {_r2(_total('freight_value'))} AS order_freight, {_r2(_mean('price'))} AS avg_item_price
        FROM {{db}}.order_items GROUP BY seller_id, order_id""",
        totals=f"""SELECT seller_id, count(DISTINCT order_id) AS total_orders, sum(items_in_order) AS total_items_sold,
        {_r2(_total('order_revenue'))} AS total_revenue, {_r2(_total('order_freight'))} AS total_freight,
        {_r2(_mean('avg_item_price'))} AS avg_item_price, {_r2(_mean('avg_review_score'))} AS avg_review_score,
        sum(total_reviews) AS total_reviews, {STATUS_COUNTS}, {_r2('avg(delivery_delay_days)')} AS avg_delivery_delay_days,
        {_r2('avg(shipping_days)')} AS avg_shipping_days FROM pairs LEFT JOIN context USING (order_id) GROUP BY seller_id""",
    ),
    "product_performance": _text(
        f"""SELECT product_id, product_category_name, product_weight_gr, product_length_cm, product_height_cm,
        product_width_cm, product_volume_cm3,
        {_bands('product_weight_gr', '<', labels.WEIGHT_BUCKETS, labels.WEIGHT_REST)} AS weight_bucket,
        {_bands('product_volume_cm3', '<', labels.SIZE_BUCKETS, labels.SIZE_REST)} AS size_bucket,
        {_zero('total_orders', 'total_units_sold', 'unique_sellers')},
        {_zero('total_revenue', 'avg_price', 'min_price', 'max_price', 'total_freight', 'avg_freight', kind='DOUBLE')},
        {_pct('coalesce(avg_freight, 0D)', 'coalesce(avg_price, 0D)')} AS freight_to_price_pct, avg_review_score,
        {_zero('total_reviews', 'positive_reviews', 'neutral_reviews', 'negative_reviews')},
        {_zero('delivered_orders', 'canceled_orders')},
        {_pct('coalesce(canceled_orders, 0L)', 'coalesce(total_orders, 1)')} AS cancellation_rate_pct,
        {_bands('total_revenue', '>=', labels.PRODUCT_TIERS, labels.PRODUCT_REST)} AS product_tier, etl_timestamp
        FROM {{db}}.products LEFT JOIN (SELECT * FROM sales LEFT JOIN sellers USING (product_id)) USING (product_id)""",
        "facts", "reviewed", "context",
        items="""SELECT product_id, order_id, order_item_id, seller_id, price, freight_value
        FROM {db}.order_items WHERE product_id IS NOT NULL""",
        sellers="SELECT product_id, count(DISTINCT seller_id) AS unique_sellers FROM items GROUP BY product_id",
        sales=f"""SELECT product_id, count(DISTINCT order_id) AS total_orders, count(order_item_id) AS total_units_sold,
        {_r2(_total('price'))} AS total_revenue, {_r2(_mean('price'))} AS avg_price, {_r2('min(price)')} AS min_price,
        {_r2('max(price)')} AS max_price, {_r2(_total('freight_value'))} AS total_freight,
        {_r2(_mean('freight_value'))} AS avg_freight, {_r2(_mean('avg_review_score'))} AS avg_review_score,
        sum(total_reviews) AS total_reviews, sum(positive_reviews) AS positive_reviews,
        sum(neutral_reviews) AS neutral_reviews, sum(negative_reviews) AS negative_reviews, {STATUS_COUNTS}
        FROM items LEFT JOIN context USING (order_id) GROUP BY product_id""",
    ),
    "payment_analysis": _text(
        f"""SELECT payment_type, {_calendar('month', *MONTH)}, total_orders, total_payment_parts,
        {_r2('value')} AS total_payment_value, avg_payment_value, min_payment_value, max_payment_value, avg_installments,
        max_installments, installment_orders, single_payment_orders, delivered_orders, canceled_orders,
        {_pct('value', 'month_total')} AS pct_of_monthly_revenue,
        {_pct('installment_orders', 'total_orders')} AS installment_usage_pct
        FROM shares ORDER BY sale_yearmonth, total_payment_value DESC""",
        "facts",
        types=f"""SELECT payment_type, trunc(o.sale_date, 'month') AS month, count(DISTINCT p.order_id) AS total_orders,
        count(payment_sequential) AS total_payment_parts, sum({_units('payment_value')}) AS value_units,
        sum({_odd('payment_value')}) AS value_odd, {_r2(_mean('payment_value'))} AS avg_payment_value,
        {_r2('min(payment_value)')} AS min_payment_value, {_r2('max(payment_value)')} AS max_payment_value,
        {_r2('avg(payment_installments)')} AS avg_installments, max(payment_installments) AS max_installments,
        count_if(payment_installments > 1) AS installment_orders, count_if(payment_installments = 1) AS single_payment_orders,
        {STATUS_COUNTS} FROM {{db}}.order_payments p LEFT JOIN facts o ON o.order_id = p.order_id GROUP BY 1, 2""",
        sums="""SELECT *, coalesce(value_odd, CAST(value_units AS DOUBLE)) AS value,
        coalesce(sum(value_odd) OVER (PARTITION BY month), CAST(sum(value_units) OVER (PARTITION BY month) AS DOUBLE)) AS whole
        FROM types""",
        shares=f"SELECT *, CASE WHEN month IS NOT NULL THEN {_r2('whole')} END AS month_total FROM sums",
    ),
    "review_sentiment": _text(
        f"""SELECT review_id, r.order_id, review_score, review_comment_title_en, review_comment_message_en,
        review_creation_date, review_answer_timestamp, review_sentiment,
        CAST(timestampdiff(HOUR, review_creation_date, review_answer_timestamp) AS DOUBLE) AS review_response_hours,
        {SENTIMENT} AS sentiment_bucket, {STARS} AS star_label, customer_trx_id, order_status, o.sale_date,
        {_calendar('o.sale_date', *MONTH)}, is_delivered, is_canceled, delivery_delay_days, shipping_days,
        coalesce(coalesce(delivery_delay_days, 0) > 0 AND review_score <= 2, false) AS is_late_and_unhappy,
        coalesce(coalesce(delivery_delay_days, 0) < 0 AND review_score >= 4, false) AS is_early_and_happy,
        total_payment_value, primary_payment_type, r.etl_timestamp
        FROM {{db}}.order_reviews r LEFT JOIN orders_paid o ON o.order_id = r.order_id""",
        "facts", "paid",
        orders_paid="""SELECT concat(order_id) AS order_id, customer_trx_id, order_status, sale_date, is_delivered,
        is_canceled, delivery_delay_days, shipping_days, total_payment_value, primary_payment_type
        FROM facts LEFT JOIN paid USING (order_id)""",
    ),
    "geo_sales_heatmap": _text(
        f"""SELECT {PLACE}, geo_lat, geo_lon, {_calendar('month', *MONTH)}, total_orders, unique_customers, delivered_orders,
        canceled_orders, {_r2('revenue')} AS total_revenue, {_r2('try_divide(revenue, paid_orders)')} AS avg_order_value,
        {_r2('max_order_value')} AS max_order_value, {_r2('try_divide(scores, scored_orders)')} AS avg_review_score,
        {_pct('canceled_orders', 'total_orders')} AS cancellation_rate_pct,
        {_pct('delivered_orders', 'total_orders')} AS delivery_rate_pct,
        {_r2('try_divide(revenue, unique_customers)')} AS revenue_per_customer FROM placed""",
        "facts", "paid", "reviewed", "points",
        months=f"""SELECT customer_trx_id, trunc(sale_date, 'month') AS month, count(DISTINCT order_id) AS total_orders,
        {STATUS_COUNTS}, sum({_units('total_payment_value')}) AS paid_units, sum({_odd('total_payment_value')}) AS paid_odd,
        count(total_payment_value) AS paid_orders, max(total_payment_value) AS max_order_value,
        sum({_units('avg_review_score')}) AS score_units, count(avg_review_score) AS scored_orders
        FROM facts LEFT JOIN paid USING (order_id) LEFT JOIN reviewed USING (order_id) GROUP BY 1, 2""",
        customer_months=f"""SELECT {PLACE}, month, customer_trx_id, max(total_orders) AS total_orders,
        max(max_order_value) AS max_order_value, sum(delivered_orders) AS delivered_orders,
        sum(canceled_orders) AS canceled_orders, sum(paid_units) AS paid_units, sum(paid_odd) AS paid_odd,
        sum(paid_orders) AS paid_orders, sum(score_units) AS score_units, sum(scored_orders) AS scored_orders
        FROM {{db}}.customers LEFT JOIN months USING (customer_trx_id) GROUP BY {PLACE}, month, customer_trx_id""",
        place_months=f"""SELECT {PLACE}, month, count(customer_trx_id) AS unique_customers, sum(total_orders) AS total_orders,
        max(max_order_value) AS max_order_value, sum(delivered_orders) AS delivered_orders,
        sum(canceled_orders) AS canceled_orders, sum(paid_units) AS paid_units, sum(paid_odd) AS paid_odd,
        sum(paid_orders) AS paid_orders, sum(score_units) AS score_units, sum(scored_orders) AS scored_orders
        FROM customer_months GROUP BY {PLACE}, month""",
        city_centres="""SELECT geo_postal_code AS postal, CAST(sum(lat) AS DOUBLE) / count(lat) AS geo_lat,
        CAST(sum(lon) AS DOUBLE) / count(lon) AS geo_lon FROM points GROUP BY geo_postal_code, geolocation_city, geo_country""",
        places="SELECT postal, geo_lat, geo_lon, count(*) AS copies FROM city_centres GROUP BY postal, geo_lat, geo_lon",
        placed=f"""SELECT {PLACE}, geo_lat, geo_lon, month, unique_customers, max_order_value,
        coalesce(total_orders, 0L) AS total_orders, coalesce(delivered_orders * coalesce(copies, 1L), 0L) AS delivered_orders,
        coalesce(canceled_orders * coalesce(copies, 1L), 0L) AS canceled_orders,
        coalesce(paid_odd * coalesce(copies, 1L), CAST(paid_units * coalesce(copies, 1L) AS DOUBLE)) AS revenue,
        paid_orders * coalesce(copies, 1L) AS paid_orders, CAST(score_units * coalesce(copies, 1L) AS DOUBLE) AS scores,
        scored_orders * coalesce(copies, 1L) AS scored_orders
        FROM place_months LEFT JOIN places ON postal = customer_postal_code""",
    ),
}


def create_views(spark: SparkSession, database: str, prefix: str = "vw_") -> list[str]:
    """Store every report as a view over the tables of `database`."""
    names = [f"{database}.{prefix}{name}" for name in REPORT_TEXTS]
    for name, text in zip(names, REPORT_TEXTS.values()):
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text.replace('{db}', database)}")
    return names
