"""The eight reports in SQL, shaped differently from the Spark plans.

Where Spark aggregates first, these join at row level or use windows and
scalar subqueries, so that both agree only if the meaning is the same.
"""

from __future__ import annotations

from oracle.tables import big, cents, mean, pct, r2, with_tables

DELAY = "(CAST(order_delivered_customer_date AS DATE) - CAST(order_estimated_delivery_date AS DATE))"
SHIPPING = "(CAST(order_delivered_customer_date AS DATE) - CAST(order_delivered_carrier_date AS DATE))"
CYCLE = "(CAST(order_delivered_customer_date AS DATE) - CAST(order_purchase_timestamp AS DATE))"


def calendar(day: str, *parts: str) -> str:
    made = {
        "sale_year": f"CAST(year({day}) AS BIGINT)",
        "sale_month": f"CAST(month({day}) AS BIGINT)",
        "sale_day": f"CAST(day({day}) AS BIGINT)",
        "sale_day_name": f"strftime({day}, '%A')",
        "sale_yearmonth": f"strftime({day}, '%Y-%m')",
    }
    return ", ".join(f"{made[p]} AS {p}" for p in (parts or made))


MONTH = ("sale_year", "sale_month", "sale_yearmonth")

PARTS = {
    "q_pay": f"""
      SELECT order_id, {r2(cents('payment_value'))} AS paid, max(payment_installments) AS max_inst,
             max(payment_type) FILTER (pos = 1) AS top_type, count(payment_sequential) AS n_parts
      FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY payment_value DESC NULLS LAST,
                      payment_sequential, payment_type) AS pos FROM s_payments)
      GROUP BY order_id""",
    "q_item": f"""
      SELECT order_id, count(order_item_id) AS n, count(DISTINCT product_id) AS n_prod,
             count(DISTINCT seller_id) AS n_sell, {r2(cents('price'))} AS goods,
             {r2(cents('freight_value'))} AS freight, {r2(cents('total_item_value'))} AS gmv
      FROM s_items GROUP BY order_id""",
    "q_review": f"""
      SELECT order_id, {r2('(CAST(sum(review_score) AS DOUBLE) / count(review_score))')} AS stars, count(review_id) AS n,
             count(*) FILTER (review_score >= 4) AS n_good, count(*) FILTER (review_score = 3) AS n_mid,
             count(*) FILTER (review_score <= 2) AS n_bad
      FROM s_reviews GROUP BY order_id""",
    "q_geo": """
      SELECT geo_postal_code AS postal, avg(geo_lat) AS geo_lat, avg(geo_lon) AS geo_lon FROM s_geo GROUP BY 1""",
    "q_order": f"""
      SELECT s_orders.*, {DELAY} AS delay, {SHIPPING} AS shipped_in, CAST(order_status = 'delivered' AS INTEGER) AS dlv,
             CAST(order_status = 'canceled' AS INTEGER) AS cnc
      FROM s_orders""",
}


def _sql(body: str, **more: str) -> str:
    return with_tables(body, {**PARTS, **more})


ORDER_SUMMARY = _sql(f"""
SELECT order_id, customer_trx_id, order_status, order_purchase_timestamp, order_approved_at,
       order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date, sale_date,
       {calendar('sale_date')},
       coalesce(order_status = 'delivered', false) AS is_delivered,
       coalesce(order_status = 'canceled', false) AS is_canceled,
       coalesce(order_status IN ('shipped', 'out_for_delivery'), false) AS is_in_transit,
       {DELAY} AS delivery_delay_days, {SHIPPING} AS shipping_days, {CYCLE} AS order_cycle_days,
       paid AS total_payment_value, max_inst AS max_installments, top_type AS primary_payment_type,
       n_parts AS payment_parts_count, n AS total_items, n_prod AS unique_products, n_sell AS unique_sellers,
       goods AS items_subtotal, freight AS freight_total, gmv AS order_gmv,
       {r2('abs(coalesce(paid, 0e0) - coalesce(gmv, 0e0))')} AS payment_vs_gmv_diff,
       etl_timestamp
FROM s_orders LEFT JOIN q_pay USING (order_id) LEFT JOIN q_item USING (order_id)""")

DAILY = _sql(f"""
SELECT sale_date, {calendar('sale_date', 'sale_year', 'sale_month', 'sale_day_name', 'sale_yearmonth')},
       count(DISTINCT order_id) AS total_orders, {big('sum(dlv)')} AS delivered_orders,
       {big('sum(cnc)')} AS canceled_orders, {big('count(DISTINCT order_id) - sum(dlv + cnc)')} AS pending_orders,
       {r2(cents('paid'))} AS daily_revenue, {r2(mean('paid'))} AS avg_order_value, {r2(cents('gmv'))} AS daily_gmv,
       {r2(cents('freight'))} AS daily_freight, CAST(sum(n) AS DOUBLE) AS total_items_sold,
       {r2('avg(delay)')} AS avg_delivery_delay_days, {r2('avg(shipped_in)')} AS avg_shipping_days,
       {pct('sum(cnc)', 'count(DISTINCT order_id)')} AS cancellation_rate_pct
FROM q_order LEFT JOIN q_pay USING (order_id) LEFT JOIN q_item USING (order_id)
GROUP BY sale_date""")

CUSTOMER = _sql(f"""
SELECT c.customer_trx_id, subscriber_id, age, gender,
       CASE WHEN age IS NULL THEN 'Unknown' WHEN age >= 55 THEN 'Senior (55+)' WHEN age >= 45 THEN 'Boomer (45-54)'
            WHEN age >= 35 THEN 'Gen X (35-44)' WHEN age >= 25 THEN 'Millennial (25-34)'
            ELSE 'Gen Z (< 25)' END AS age_group,
       subscribe_date, first_order_date, customer_postal_code, customer_city, customer_country, customer_country_code,
       geo_lat, geo_lon, coalesce(n, 0) AS total_orders, coalesce(ltv, 0e0) AS lifetime_value,
       coalesce(aov, 0e0) AS avg_order_value, coalesce(top, 0e0) AS max_order_value,
       coalesce(low, 0e0) AS min_order_value, d1 AS first_purchase_date, d2 AS last_purchase_date,
       {big('coalesce(d2 - d1, 0)')} AS customer_tenure_days, coalesce(ok, 0) AS delivered_orders,
       coalesce(ko, 0) AS canceled_orders, coalesce(late, 0e0) AS avg_delivery_delay_days,
       CASE WHEN ltv IS NULL OR ltv < 100 THEN 'Inactive' WHEN ltv < 500 THEN 'Low Value'
            WHEN ltv < 1000 THEN 'Mid Value' ELSE 'High Value' END AS customer_segment,
       etl_timestamp
FROM s_customers c
LEFT JOIN q_spend u ON u.customer_trx_id = c.customer_trx_id
LEFT JOIN q_geo ON postal = customer_postal_code""",
    q_spend=f"""
      SELECT customer_trx_id, count(DISTINCT order_id) AS n, {r2(cents('paid'))} AS ltv, {r2(mean('paid'))} AS aov,
             max(paid) AS top, min(paid) AS low, min(sale_date) AS d1, max(sale_date) AS d2, {big('sum(dlv)')} AS ok,
             {big('sum(cnc)')} AS ko, {r2('avg(delay)')} AS late
      FROM q_order LEFT JOIN q_pay USING (order_id) GROUP BY customer_trx_id""")

SELLER = _sql(f"""
SELECT s.seller_id, seller_name, seller_city, seller_country, country_code, seller_postal_code, geo_lat, geo_lon,
       coalesce(n_orders, 0) AS total_orders, coalesce(n_items, 0) AS total_items_sold,
       coalesce(revenue, 0e0) AS total_revenue, coalesce(freight, 0e0) AS total_freight,
       coalesce(item_price, 0e0) AS avg_item_price, stars AS avg_review_score, coalesce(n_rev, 0) AS total_reviews,
       coalesce(ok, 0) AS delivered_orders, coalesce(ko, 0) AS canceled_orders, late AS avg_delivery_delay_days,
       transit AS avg_shipping_days,
       CASE WHEN revenue IS NULL OR revenue < 1000 THEN 'Bronze' WHEN revenue < 10000 THEN 'Silver'
            WHEN revenue < 50000 THEN 'Gold' ELSE 'Platinum' END AS seller_tier,
       {pct('coalesce(ko, 0)', 'coalesce(n_orders, 1)')} AS cancellation_rate_pct, etl_timestamp
FROM s_sellers s LEFT JOIN q_sold u ON u.seller_id = s.seller_id LEFT JOIN q_geo ON postal = seller_postal_code""",
    q_pair=f"""
      SELECT seller_id, order_id, count(order_item_id) AS n_items, {r2(cents('price'))} AS rev,
             {r2(cents('freight_value'))} AS frt, {r2(mean('price'))} AS item_price
      FROM s_items GROUP BY ALL""",
    q_sold=f"""
      SELECT seller_id, count(DISTINCT order_id) AS n_orders, {big('sum(n_items)')} AS n_items,
             {r2(cents('rev'))} AS revenue, {r2(cents('frt'))} AS freight, {r2(mean('item_price'))} AS item_price,
             {r2(mean('stars'))} AS stars, {big('sum(n)')} AS n_rev, {big('sum(dlv)')} AS ok, {big('sum(cnc)')} AS ko,
             {r2('avg(delay)')} AS late, {r2('avg(shipped_in)')} AS transit
      FROM q_pair LEFT JOIN q_order USING (order_id) LEFT JOIN q_review USING (order_id) GROUP BY seller_id""")

PRODUCT = _sql(f"""
SELECT p.product_id, product_category_name, product_weight_gr, product_length_cm, product_height_cm, product_width_cm,
       product_volume_cm3,
       CASE WHEN product_weight_gr IS NULL OR product_weight_gr >= 5000 THEN 'Very Heavy (5kg+)'
            WHEN product_weight_gr >= 2000 THEN 'Heavy (2kg-5kg)' WHEN product_weight_gr >= 500 THEN 'Medium (500g-2kg)'
            ELSE 'Light (< 500g)' END AS weight_bucket,
       CASE WHEN product_volume_cm3 IS NULL OR product_volume_cm3 >= 20000 THEN 'Extra Large'
            WHEN product_volume_cm3 >= 5000 THEN 'Large' WHEN product_volume_cm3 >= 1000 THEN 'Medium'
            ELSE 'Small' END AS size_bucket,
       coalesce(n_orders, 0) AS total_orders, coalesce(n_units, 0) AS total_units_sold,
       coalesce(n_sell, 0) AS unique_sellers, coalesce(revenue, 0e0) AS total_revenue,
       coalesce(price_avg, 0e0) AS avg_price, coalesce(price_min, 0e0) AS min_price,
       coalesce(price_max, 0e0) AS max_price, coalesce(freight, 0e0) AS total_freight,
       coalesce(freight_avg, 0e0) AS avg_freight,
       {pct('coalesce(freight_avg, 0e0)', 'coalesce(price_avg, 0e0)')} AS freight_to_price_pct,
       stars AS avg_review_score, coalesce(n_rev, 0) AS total_reviews, coalesce(n_good, 0) AS positive_reviews,
       coalesce(n_mid, 0) AS neutral_reviews, coalesce(n_bad, 0) AS negative_reviews,
       coalesce(ok, 0) AS delivered_orders, coalesce(ko, 0) AS canceled_orders,
       {pct('coalesce(ko, 0)', 'coalesce(n_orders, 1)')} AS cancellation_rate_pct,
       CASE WHEN revenue IS NULL OR revenue < 100 THEN 'No Sales' WHEN revenue < 1000 THEN 'Low Seller'
            WHEN revenue < 10000 THEN 'Good Seller' ELSE 'Top Seller' END AS product_tier,
       etl_timestamp
FROM s_products p LEFT JOIN q_moved u ON u.product_id = p.product_id""",
    q_moved=f"""
      SELECT product_id, count(DISTINCT order_id) AS n_orders, count(order_item_id) AS n_units,
             count(DISTINCT seller_id) AS n_sell, {r2(cents('price'))} AS revenue, {r2(mean('price'))} AS price_avg,
             min(price) AS price_min, max(price) AS price_max, {r2(cents('freight_value'))} AS freight,
             {r2(mean('freight_value'))} AS freight_avg, {r2(mean('stars'))} AS stars, {big('sum(n)')} AS n_rev,
             {big('sum(n_good)')} AS n_good, {big('sum(n_mid)')} AS n_mid, {big('sum(n_bad)')} AS n_bad,
             {big('coalesce(sum(dlv), 0)')} AS ok, {big('coalesce(sum(cnc), 0)')} AS ko
      FROM s_items LEFT JOIN q_order USING (order_id) LEFT JOIN q_review USING (order_id) GROUP BY product_id""")

PAYMENT = _sql(f"""
SELECT payment_type, sale_year, sale_month, sale_yearmonth, count(DISTINCT order_id) AS total_orders,
       count(payment_sequential) AS total_payment_parts, {r2(cents('payment_value'))} AS total_payment_value,
       {r2(mean('payment_value'))} AS avg_payment_value, min(payment_value) AS min_payment_value,
       max(payment_value) AS max_payment_value, {r2('avg(payment_installments)')} AS avg_installments,
       max(payment_installments) AS max_installments, count(*) FILTER (payment_installments > 1) AS installment_orders,
       count(*) FILTER (payment_installments = 1) AS single_payment_orders,
       {big('coalesce(sum(dlv), 0)')} AS delivered_orders, {big('coalesce(sum(cnc), 0)')} AS canceled_orders,
       {pct(cents('payment_value'), 'any_value(total)')} AS pct_of_monthly_revenue,
       {pct('count(*) FILTER (payment_installments > 1)', 'count(DISTINCT order_id)')} AS installment_usage_pct
FROM q_paid LEFT JOIN (SELECT sale_yearmonth AS ym, {r2(cents('payment_value'))} AS total FROM q_paid GROUP BY 1)
  ON ym = sale_yearmonth
GROUP BY payment_type, sale_year, sale_month, sale_yearmonth""",
    q_paid=f"""
      SELECT p.* EXCLUDE (sale_date), dlv, cnc, {calendar('o.sale_date', *MONTH)}
      FROM s_payments p LEFT JOIN q_order o ON o.order_id = p.order_id""")

REVIEW = _sql(f"""
SELECT review_id, r.order_id, review_score, review_comment_title_en, review_comment_message_en, review_creation_date,
       review_answer_timestamp, review_sentiment,
       CAST(date_sub('hour', review_creation_date, review_answer_timestamp) AS DOUBLE) AS review_response_hours,
       CASE WHEN review_score > 3 THEN 'Positive' WHEN review_score > 2 THEN 'Neutral' ELSE 'Negative' END
         AS sentiment_bucket,
       coalesce(repeat('⭐', review_score) || ' ' ||
         ['Very Poor', 'Poor', 'Average', 'Good', 'Excellent'][review_score], 'No Rating') AS star_label,
       customer_trx_id, order_status, o.sale_date, {calendar('o.sale_date', *MONTH)},
       dlv = 1 AS is_delivered, cnc = 1 AS is_canceled, delay AS delivery_delay_days, shipped_in AS shipping_days,
       coalesce(delay > 0 AND review_score < 3, false) AS is_late_and_unhappy,
       coalesce(delay < 0 AND review_score > 3, false) AS is_early_and_happy,
       paid AS total_payment_value, top_type AS primary_payment_type, r.etl_timestamp
FROM s_reviews r LEFT JOIN q_order o ON o.order_id = r.order_id LEFT JOIN q_pay p ON p.order_id = o.order_id""")

GEO = _sql(f"""
SELECT customer_country, customer_country_code, customer_city, customer_postal_code, geo_lat, geo_lon,
       {calendar('month', *MONTH)}, n AS total_orders, n_cust AS unique_customers, ok AS delivered_orders,
       ko AS canceled_orders, {r2('revenue')} AS total_revenue, {r2('aov')} AS avg_order_value, top AS max_order_value,
       {r2('stars')} AS avg_review_score, {pct('ko', 'n')} AS cancellation_rate_pct,
       {pct('ok', 'n')} AS delivery_rate_pct, {r2('(revenue / nullif(n_cust, 0))')} AS revenue_per_customer
FROM (
  SELECT customer_country, customer_country_code, customer_city, customer_postal_code, geo_lat, geo_lon,
         date_trunc('month', o.sale_date) AS month, count(DISTINCT o.order_id) AS n,
         count(DISTINCT c.customer_trx_id) AS n_cust, {big('coalesce(sum(dlv), 0)')} AS ok,
         {big('coalesce(sum(cnc), 0)')} AS ko, {cents('paid')} AS revenue, {mean('paid')} AS aov, max(paid) AS top,
         {mean('stars')} AS stars
  FROM s_customers c LEFT JOIN q_order o ON o.customer_trx_id = c.customer_trx_id
  LEFT JOIN q_pay p ON p.order_id = o.order_id LEFT JOIN q_review v ON v.order_id = o.order_id
  LEFT JOIN q_geo ON postal = customer_postal_code
  GROUP BY ALL)""")

REPORT_SQL = {
    "order_summary": ORDER_SUMMARY,
    "daily_sales_performance": DAILY,
    "customer_profile": CUSTOMER,
    "seller_performance": SELLER,
    "product_performance": PRODUCT,
    "payment_analysis": PAYMENT,
    "review_sentiment": REVIEW,
    "geo_sales_heatmap": GEO,
}
