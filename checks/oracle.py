"""The registered queries as plain SQL over the test tables, written independently of the Spark code.

``TABLES`` are named subqueries; ``build`` puts those a query needs in front of it. Numbers that leave a
query are rounded like the Spark results, times and dates leave as text.
"""

from __future__ import annotations

import re

# Fixed values.
STATES = [
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
    "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
]
STATE_LIST = "[" + ", ".join(f"'{s}'" for s in STATES) + "]"
STATE_SET = "(" + ", ".join(f"'{s}'" for s in STATES) + ")"
NORTH = "('AC', 'AP', 'AM', 'PA', 'RO', 'RR', 'TO')"


def r(expression: str, name: str | None = None) -> str:
    """A rounded double; adding zero turns -0.0 into 0.0."""
    return f"round(CAST({expression} AS DOUBLE), 4) + 0e0 AS {name or expression}"


def ts(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {name or column}"


def big(expression: str, name: str | None = None) -> str:
    return f"CAST({expression} AS BIGINT) AS {name or expression}"


def days(a: str, b: str) -> str:
    return f"CAST(floor(date_diff('microsecond', {a}, {b}) / 864e8) AS BIGINT)"


def km(a: str, b: str, c: str, d: str) -> str:
    chord = (
        f"(pow(sin((radians({c}) - radians({a})) / 2), 2)"
        f" + cos(radians({a})) * cos(radians({c})) * pow(sin((radians({d}) - radians({b})) / 2), 2))"
    )
    return f"(2 * 6371 * asin(sqrt(CASE WHEN {chord} > 1 THEN 1e0 ELSE {chord} END)))"


def hashed(column: str) -> str:
    return f"CAST('0x' || substr(md5('42|' || CAST({column} AS VARCHAR)), 1, 15) AS BIGINT)"


def zfill(column: str) -> str:
    return f"CASE WHEN length({column}) < 5 THEN lpad({column}, 5, '0') ELSE {column} END"


def label(score: str) -> str:
    return f"CASE WHEN {score} >= 4 THEN 'satisfied' ELSE 'unsatisfied' END"


FACTS = (
    "order_id, customer_id, order_purchase_timestamp, order_estimated_delivery_date,"
    " order_delivered_customer_date, delivery_days"
)

TABLES: dict[str, str] = {}

TABLES["t_orders_base"] = """
SELECT *, o_orderdate + to_hours(o_orderkey % 24) AS bought,
  3 + (o_orderkey % 24) // 4 + month(o_orderdate) + (o_orderkey * 13) % 5
    + CASE WHEN month(o_orderdate) >= 11 THEN 8 ELSE 0 END AS travel
FROM orders"""
TABLES["t_orders"] = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
  bought AS order_purchase_timestamp,
  bought + INTERVAL 1 HOUR AS order_approved_at,
  bought + to_days(CAST((o_orderkey * 7) % 10 - 1 AS INTEGER)) AS order_delivered_carrier_date,
  CASE WHEN o_orderkey % 83 <> 0
    THEN bought + to_days(CAST(travel AS INTEGER)) + to_hours(o_orderkey % 7) END AS order_delivered_customer_date,
  o_orderdate + to_days(CAST(10 + o_orderkey % 30 AS INTEGER)) AS order_estimated_delivery_date
FROM t_orders_base"""
TABLES["t_items"] = """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id, l_partkey AS product_id,
  l_suppkey AS seller_id, l_shipdate AS shipping_limit_date, l_extendedprice AS price,
  l_quantity * 5e-1 AS freight_value
FROM lineitem"""
TABLES["t_payments"] = """
SELECT (event_id // 2) * 3 AS order_id, event_id % 2 + 1 AS payment_sequential,
  CASE event_type WHEN 'click' THEN 'credit_card' WHEN 'view' THEN 'boleto' WHEN 'signup' THEN 'voucher'
    WHEN 'purchase' THEN 'debit_card' ELSE 'not_defined' END AS payment_type,
  event_id % 4 AS payment_installments, value AS payment_value
FROM events"""
TABLES["t_reviews"] = """
SELECT l_suppkey AS review_id, l_orderkey AS order_id, CAST(l_quantity AS BIGINT) % 5 + 1 AS review_score
FROM lineitem"""
TABLES["t_customers"] = f"""
SELECT c_custkey AS customer_id, c_custkey // 3 AS customer_unique_id,
  CAST(c_custkey % 1010 AS VARCHAR) AS customer_zip_code_prefix,
  'city_' || CAST(c_custkey % 50 AS VARCHAR) AS customer_city,
  {STATE_LIST}[c_nationkey + 1] AS customer_state
FROM customer"""
TABLES["t_sellers"] = f"""
SELECT s_suppkey AS seller_id, CAST((s_suppkey * 53) % 1010 AS VARCHAR) AS seller_zip_code_prefix,
  {STATE_LIST}[s_nationkey + 1] AS seller_state
FROM supplier"""
TABLES["t_geo_base"] = """
SELECT *, l_partkey % 1000 AS z,
  (((l_partkey % 1000) * 37) % 380) * 100 - 33000 + CAST(l_quantity AS BIGINT) - 25
    + CASE WHEN l_orderkey % 251 = 0 THEN 60000 WHEN l_orderkey % 97 = 0 THEN 5000 ELSE 0 END AS lat,
  (((l_partkey % 1000) * 53) % 380) * 100 - 73000 + (l_linenumber - 4) * 10 AS lng
FROM lineitem"""
TABLES["t_geo"] = f"""
SELECT CAST(z AS VARCHAR) AS geolocation_zip_code_prefix,
  CASE WHEN l_orderkey % 499 <> 0 THEN lat / 1e3 END AS geolocation_lat,
  CASE WHEN l_orderkey % 499 <> 0 THEN lng / 1e3 END AS geolocation_lng,
  CASE WHEN l_linenumber = 7 THEN chr(9) || 'city_' || CAST(l_suppkey % 3 AS VARCHAR) || ' '
    ELSE 'city_' || CAST(l_suppkey % 3 AS VARCHAR) END AS geolocation_city,
  {STATE_LIST}[z % 27 + 1] AS geolocation_state
FROM t_geo_base"""
TABLES["t_products"] = """
SELECT p_partkey AS product_id,
  CASE WHEN p_partkey % 40 <> 0 THEN p_type END AS product_category_name,
  CASE WHEN p_partkey % 40 <> 0 THEN CAST(length(p_name) AS BIGINT) END AS product_name_lenght,
  CASE WHEN p_partkey % 40 <> 0 THEN CAST(p_size * 10 AS BIGINT) END AS product_description_lenght,
  CASE WHEN p_partkey % 40 <> 0 THEN p_partkey % 6 END AS product_photos_qty,
  CASE WHEN p_partkey % 50 <> 0 THEN p_size * 1e2 END AS product_weight_g,
  CASE WHEN p_partkey % 50 <> 0 THEN p_size + 1e1 END AS product_length_cm,
  CASE WHEN p_partkey % 50 <> 0 THEN p_size * 5e-1 + 2e0 END AS product_height_cm,
  CASE WHEN p_partkey % 50 <> 0 THEN p_size + 5e0 END AS product_width_cm
FROM part"""
TABLES["t_log"] = """
SELECT ts, event_id, CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 422 ELSE 200 END AS status,
  value AS latency_ms, CASE WHEN event_id % 3 = 0 THEN '1' ELSE '2' END AS model_version
FROM events"""
TABLES["t_predictions"] = """
SELECT ts, value AS y, CAST(user_id % 21 + 30 AS DOUBLE) AS p FROM events"""

# --- order cleaning ---
TABLES["o_fixed"] = """
SELECT * REPLACE (CASE WHEN order_delivered_carrier_date < order_purchase_timestamp
    OR coalesce(order_delivered_customer_date < order_delivered_carrier_date, FALSE)
    THEN NULL ELSE order_delivered_carrier_date END AS order_delivered_carrier_date)
FROM t_orders"""
TABLES["o_items"] = f"""
SELECT order_id, count(order_item_id) AS n_items, count(DISTINCT product_id) AS n_products,
  count(DISTINCT seller_id) AS n_sellers, sum(price) AS total_price, sum(freight_value) AS total_freight,
  max(CASE WHEN coalesce({days('order_purchase_timestamp', 'shipping_limit_date')} > 60, FALSE)
    THEN NULL ELSE shipping_limit_date END) AS shipping_limit_date,
  sum(freight_value) / nullif(sum(price) + sum(freight_value), 0) AS freight_ratio
FROM t_items LEFT JOIN (SELECT order_id, order_purchase_timestamp FROM t_orders) USING (order_id)
GROUP BY order_id"""
TABLES["o_main_payment"] = """
SELECT order_id, payment_type AS main_payment_type FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id
    ORDER BY payment_value DESC NULLS LAST, payment_sequential, payment_type) AS rn FROM t_payments)
WHERE rn = 1"""
TABLES["o_payments"] = """
SELECT * FROM (
  SELECT order_id, sum(payment_value) AS total_payment, count(payment_sequential) AS n_payments,
    max(CASE WHEN payment_installments = 0 THEN 1 ELSE payment_installments END) AS max_installments,
    max(CASE WHEN payment_type = 'voucher' THEN 1 ELSE 0 END) AS used_voucher
  FROM t_payments GROUP BY order_id) JOIN o_main_payment USING (order_id)"""
TABLES["o_reviews"] = """
SELECT order_id, avg(review_score) AS review_score, count(review_id) AS n_reviews
FROM t_reviews GROUP BY order_id"""
TABLES["o_clean"] = f"""
SELECT *, {days('order_purchase_timestamp', 'order_delivered_customer_date')} AS delivery_days,
  {days('order_estimated_delivery_date', 'order_delivered_customer_date')} AS late_days,
  CASE WHEN {days('order_estimated_delivery_date', 'order_delivered_customer_date')} > 0 THEN 1 ELSE 0 END AS is_late
FROM o_reviews JOIN o_fixed USING (order_id) LEFT JOIN o_items USING (order_id)
LEFT JOIN o_payments USING (order_id)
LEFT JOIN (SELECT customer_id, customer_unique_id FROM t_customers) USING (customer_id)
WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL"""

# --- geolocation ---
TABLES["g_points"] = rf"""
SELECT * REPLACE ({zfill('geolocation_zip_code_prefix')} AS geolocation_zip_code_prefix,
  regexp_replace(geolocation_city, '^\s+|\s+$', '', 'g') AS geolocation_city)
FROM t_geo"""
TABLES["g_middle"] = """
SELECT geolocation_zip_code_prefix, quantile_cont(geolocation_lat, 0.5) AS mlat,
  quantile_cont(geolocation_lng, 0.5) AS mlng
FROM g_points GROUP BY geolocation_zip_code_prefix"""
TABLES["g_flagged"] = f"""
SELECT g_points.*, {km('geolocation_lat', 'geolocation_lng', 'mlat', 'mlng')} AS dist_from_zip_median_km,
  coalesce(geolocation_lat > 6 OR geolocation_lat < -34 OR geolocation_lng > -32 OR geolocation_lng < -74, FALSE)
  OR coalesce({km('geolocation_lat', 'geolocation_lng', 'mlat', 'mlng')} > 100, FALSE) AS is_coord_outlier,
  count(*) OVER (PARTITION BY geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_city,
    geolocation_state) > 1 AS is_duplicate_row
FROM g_points JOIN g_middle USING (geolocation_zip_code_prefix)"""
TABLES["g_kept"] = """
SELECT geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_city, geolocation_state
FROM g_flagged WHERE NOT is_coord_outlier"""
TABLES["g_city"] = """
SELECT geolocation_zip_code_prefix, geolocation_city FROM (
  SELECT geolocation_zip_code_prefix, geolocation_city, row_number() OVER (PARTITION BY geolocation_zip_code_prefix
    ORDER BY count(*) DESC, geolocation_city) AS rn FROM g_kept GROUP BY 1, 2) WHERE rn = 1"""
TABLES["g_state"] = """
SELECT geolocation_zip_code_prefix, geolocation_state FROM (
  SELECT geolocation_zip_code_prefix, geolocation_state, row_number() OVER (PARTITION BY geolocation_zip_code_prefix
    ORDER BY count(*) DESC, geolocation_state) AS rn FROM g_kept GROUP BY 1, 2) WHERE rn = 1"""
TABLES["g_zips"] = """
SELECT * FROM (
  SELECT geolocation_zip_code_prefix, quantile_cont(geolocation_lat, 0.5) AS geolocation_lat,
    quantile_cont(geolocation_lng, 0.5) AS geolocation_lng FROM g_kept GROUP BY 1)
JOIN g_city USING (geolocation_zip_code_prefix) JOIN g_state USING (geolocation_zip_code_prefix)"""

# --- lookups and the order table ---
TABLES["l_products"] = """
SELECT product_id, coalesce(product_category_name, 'unknown') AS product_category_name,
  coalesce(product_name_lenght, 0) AS product_name_length,
  coalesce(product_description_lenght, 0) AS product_description_length,
  coalesce(product_photos_qty, 0) AS product_photos_qty,
  coalesce(product_weight_g, (SELECT quantile_cont(product_weight_g, 0.5) FROM t_products)) AS product_weight_g,
  coalesce(product_length_cm, (SELECT quantile_cont(product_length_cm, 0.5) FROM t_products)) AS product_length_cm,
  coalesce(product_height_cm, (SELECT quantile_cont(product_height_cm, 0.5) FROM t_products)) AS product_height_cm,
  coalesce(product_width_cm, (SELECT quantile_cont(product_width_cm, 0.5) FROM t_products)) AS product_width_cm
FROM t_products"""
TABLES["l_customers"] = f"""
SELECT customer_id, customer_unique_id, {zfill('customer_zip_code_prefix')} AS customer_zip_code_prefix,
  customer_city, customer_state FROM t_customers"""
TABLES["l_sellers"] = f"""
SELECT seller_id, {zfill('seller_zip_code_prefix')} AS seller_zip_code_prefix, seller_state FROM t_sellers"""
TABLES["l_buyers"] = """
SELECT l_customers.*, geolocation_lat AS customer_lat, geolocation_lng AS customer_lng
FROM l_customers LEFT JOIN g_zips ON customer_zip_code_prefix = geolocation_zip_code_prefix"""
TABLES["l_shops"] = """
SELECT seller_id, seller_state, geolocation_lat AS seller_lat, geolocation_lng AS seller_lng
FROM l_sellers LEFT JOIN g_zips ON seller_zip_code_prefix = geolocation_zip_code_prefix"""
TABLES["d_kept"] = f"""
SELECT order_id, customer_id, order_purchase_timestamp, order_estimated_delivery_date,
  order_delivered_customer_date,
  {days('order_purchase_timestamp', 'order_delivered_customer_date')} AS delivery_days
FROM t_orders WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
  AND order_id IN (SELECT order_id FROM t_reviews)"""
TABLES["d_items"] = """
SELECT t_items.order_id, order_item_id, t_items.product_id, t_items.seller_id, price, freight_value,
  d_kept.* EXCLUDE (order_id), customer_zip_code_prefix, customer_state, customer_city, customer_lat, customer_lng,
  product_weight_g, seller_state, seller_lat, seller_lng
FROM t_items JOIN d_kept ON t_items.order_id = d_kept.order_id
LEFT JOIN l_buyers ON d_kept.customer_id = l_buyers.customer_id
LEFT JOIN l_products ON t_items.product_id = l_products.product_id
LEFT JOIN l_shops ON t_items.seller_id = l_shops.seller_id"""
TABLES["d_ranked"] = f"""
SELECT *, {km('customer_lat', 'customer_lng', 'seller_lat', 'seller_lng')} AS distance_km FROM d_items"""
TABLES["d_far"] = """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY distance_km DESC NULLS LAST, seller_id DESC) AS rn
  FROM d_ranked) WHERE rn = 1"""
TABLES["d_totals"] = """
SELECT order_id, count(DISTINCT seller_id) AS n_sellers, count(order_item_id) AS n_items,
  sum(price) AS total_price, sum(freight_value) AS total_freight,
  coalesce(sum(product_weight_g), 0) AS total_weight_g
FROM d_ranked GROUP BY order_id"""
TABLES["d_orders"] = f"""
SELECT d_far.order_id, customer_id, customer_state, customer_city, customer_lat, customer_lng, seller_state,
  seller_lat, seller_lng, distance_km, n_sellers, n_items, total_price, total_freight, total_weight_g,
  order_purchase_timestamp, order_estimated_delivery_date, order_delivered_customer_date, delivery_days,
  CASE WHEN customer_state = seller_state THEN 1 ELSE 0 END AS same_state,
  {days('order_purchase_timestamp', 'order_estimated_delivery_date')} AS estimated_delivery_days
FROM d_far JOIN d_totals ON d_far.order_id = d_totals.order_id"""
TABLES["s_located"] = """
SELECT * FROM d_orders WHERE customer_lat IS NOT NULL AND seller_lat IS NOT NULL"""
TABLES["s_split"] = f"""
SELECT * EXCLUDE (rn, n), CASE WHEN rn < floor(n * 0.7e0) THEN 'train' WHEN rn < floor(n * 0.85e0) THEN 'val'
  ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY order_purchase_timestamp, {hashed('order_id')}) - 1 AS rn,
  count(*) OVER () AS n FROM s_located)"""
TABLES["s_median"] = """
SELECT quantile_cont(delivery_days, 0.5) AS med FROM s_split WHERE split = 'train'"""
WEEK = (
    "order_purchase_timestamp >= TIMESTAMP '1997-11-20' AND order_purchase_timestamp < TIMESTAMP '1997-11-28'"
)

# --- requests ---
TABLES["q_requests"] = """
SELECT order_id,
  CASE WHEN order_id % 19 = 0 THEN 'XX' ELSE customer_state END AS customer_state,
  CASE WHEN order_id % 41 = 0 THEN NULL ELSE seller_state END AS seller_state,
  CASE WHEN order_id % 23 = 0 THEN '40.0' ELSE CAST(CAST(customer_lat AS DECIMAL(9, 4)) AS VARCHAR) END AS customer_lat,
  CAST(CAST(customer_lng AS DECIMAL(9, 4)) AS VARCHAR) AS customer_lng,
  CAST(CAST(seller_lat AS DECIMAL(9, 4)) AS VARCHAR) AS seller_lat,
  CAST(CAST(seller_lng AS DECIMAL(9, 4)) AS VARCHAR) AS seller_lng,
  CASE WHEN order_id % 43 = 0 THEN '21' ELSE CAST(n_sellers AS VARCHAR) END AS n_sellers,
  CASE WHEN order_id % 29 = 0 THEN 'abc' ELSE CAST(n_items AS VARCHAR) END AS n_items,
  CASE WHEN order_id % 37 = 0 THEN NULL ELSE CAST(CAST(total_price AS DECIMAL(18, 2)) AS VARCHAR) END AS total_price,
  CASE WHEN order_id % 47 = 0 THEN '-1' ELSE CAST(CAST(total_freight AS DECIMAL(18, 2)) AS VARCHAR) END AS total_freight,
  CASE WHEN order_id % 17 = 0 THEN '-500.0' ELSE CAST(CAST(total_weight_g AS DECIMAL(18, 2)) AS VARCHAR) END AS total_weight_g,
  CASE WHEN order_id % 53 = 0 THEN '12.5' ELSE CAST(estimated_delivery_days AS VARCHAR) END AS estimated_delivery_days,
  CASE WHEN order_id % 31 = 0 THEN 'not-a-date' WHEN order_id % 2 = 0
    THEN strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S')
    ELSE strftime(order_purchase_timestamp, '%Y-%m-%dT%H:%M:%S') END AS order_purchase_timestamp
FROM d_orders"""

# Column, SQL type (empty: text, a date is matched by its form), condition that holds for a good value v.
RULES = [
    ("customer_state", "", "membership", f"v IN {STATE_SET}"),
    ("seller_state", "", "membership", f"v IN {STATE_SET}"),
    ("customer_lat", "DOUBLE", "range", "x BETWEEN -34 AND 6"),
    ("customer_lng", "DOUBLE", "range", "x BETWEEN -74 AND -34"),
    ("seller_lat", "DOUBLE", "range", "x BETWEEN -34 AND 6"),
    ("seller_lng", "DOUBLE", "range", "x BETWEEN -74 AND -34"),
    ("n_sellers", "BIGINT", "range", "x BETWEEN 1 AND 20"),
    ("n_items", "BIGINT", "range", "x BETWEEN 1 AND 100"),
    ("total_price", "DOUBLE", "range", "x > 0"),
    ("total_freight", "DOUBLE", "range", "x >= 0"),
    ("total_weight_g", "DOUBLE", "range", "x BETWEEN 0 AND 500000"),
    ("estimated_delivery_days", "BIGINT", "range", "x BETWEEN 0 AND 200"),
    ("order_purchase_timestamp", "TIMESTAMP", "", "TRUE"),
]


def violations(table: str, key: str) -> str:
    parts = []
    for i, (column, kind, rule, good) in enumerate(RULES):
        if kind == "BIGINT":
            # Text with a fraction is no whole number, whatever a cast makes of it.
            typed = "CASE WHEN regexp_full_match(v, '-?[0-9]+') THEN TRY_CAST(v AS BIGINT) END"
        elif kind:
            typed = f"TRY_CAST(v AS {kind})"
        else:
            typed = "v"
        parts.append(
            f"SELECT {key}, {i} AS place, '{column}' AS \"column\", CASE WHEN v IS NULL THEN 'required'"
            f" WHEN x IS NULL THEN 'coercion' WHEN NOT ({good}) THEN '{rule}' END AS rule, v AS value"
            f" FROM (SELECT {key}, v, {typed} AS x FROM (SELECT {key}, CAST({column} AS VARCHAR) AS v FROM {table}))"
        )
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE rule IS NOT NULL"


TABLES["q_violations"] = violations("q_requests", "order_id")
TABLES["q_reasons"] = """
SELECT order_id, string_agg("column" || ': ' || rule || ' (' || coalesce(value, 'null') || ')', '; ' ORDER BY place)
  AS reasons FROM q_violations GROUP BY order_id"""

# --- drift ---
DRIFT_COLUMNS = ["total_weight_g", "distance_km", "total_price", "total_freight", "delivery_days"]


def cells(source: str, ref: int) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v, {ref} AS ref, {1 - ref} AS cur FROM ({source})"
        for c in DRIFT_COLUMNS
    )


def drift_cells(current: str) -> str:
    return cells("SELECT * FROM s_split WHERE split = 'train'", 1) + " UNION ALL " + cells(current, 0)


def psi_from(binned: str) -> str:
    return f"""
SELECT "column", sum((q - p) * ln(q / p)) AS psi FROM (
  SELECT "column", CASE WHEN n_ref = 0 THEN NULL WHEN ref = 0 THEN 1e-4 ELSE ref / CAST(n_ref AS DOUBLE) END AS p,
    CASE WHEN n_cur = 0 THEN NULL WHEN cur = 0 THEN 1e-4 ELSE cur / CAST(n_cur AS DOUBLE) END AS q
  FROM (SELECT "column", bin, sum(ref) AS ref, sum(cur) AS cur FROM ({binned}) GROUP BY 1, 2)
  JOIN (SELECT "column", sum(ref) AS n_ref, sum(cur) AS n_cur FROM ({binned}) GROUP BY 1) USING ("column"))
GROUP BY 1"""


def sturges(cell_table: str) -> str:
    return f"""
SELECT "column", ref, cur, CASE WHEN hi > lo THEN least(floor((v - lo) / (hi - lo) * k), k - 1) ELSE 0 END AS bin
FROM {cell_table} JOIN (SELECT "column", min(v) AS lo, max(v) AS hi, ceil(log2(count(*))) + 1 AS k FROM {cell_table}
  GROUP BY 1) USING ("column")"""


TABLES["f_cells"] = drift_cells(f"SELECT * FROM s_located WHERE customer_state IN {NORTH}")
TABLES["f_psi"] = psi_from(sturges("f_cells"))
TABLES["f_ks"] = """
SELECT "column", max(abs(fr / n_ref - fc / n_cur)) AS ks_d, any_value(n_ref) AS n_ref, any_value(n_cur) AS n_cur FROM (
  SELECT "column", CAST(sum(ref) OVER w AS DOUBLE) AS fr, CAST(sum(cur) OVER w AS DOUBLE) AS fc,
    CAST(sum(ref) OVER t AS DOUBLE) AS n_ref, CAST(sum(cur) OVER t AS DOUBLE) AS n_cur
  FROM f_cells WINDOW w AS (PARTITION BY "column" ORDER BY v), t AS (PARTITION BY "column"))
WHERE n_ref > 0 AND n_cur > 0 GROUP BY 1"""
TABLES["f_ks_p"] = """
SELECT "column", ks_d, CASE WHEN lam < 2e-1 THEN 1e0 ELSE greatest(0e0, least(1e0,
    2 * (SELECT sum(CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END * exp(-2e0 * j * j * lam * lam))
         FROM range(1, 101) AS t(j)))) END AS ks_p
FROM (SELECT "column", ks_d, ks_d * sqrt(n_ref * n_cur / (n_ref + n_cur)) AS lam FROM f_ks)"""


def drift_rows(deciding: list[str]) -> str:
    names = ", ".join(f"'{c}'" for c in deciding)
    return f"""SELECT "column", {r('psi')}, {r('ks_d')}, {r('ks_p')}, ks_p < 1e-2 AS ks_rejects,
  CASE WHEN "column" NOT IN ({names}) THEN 'info' WHEN psi > 2e-1 THEN 'DRIFT' ELSE 'ok' END AS result
FROM f_psi LEFT JOIN f_ks_p USING ("column")"""


CURRENTS = {
    "normal": f"SELECT * FROM s_split WHERE split = 'test' ORDER BY {hashed('order_id')}, order_id LIMIT 500",
    "north": f"SELECT * FROM s_split WHERE customer_state IN {NORTH}",
    "sale_week": f"SELECT * FROM s_split WHERE {WEEK}",
    "december": "SELECT * FROM s_split WHERE month(order_purchase_timestamp) = 12",
}
PSI_TEXT = " || ', ' || ".join(
    f"""(SELECT CASE WHEN psi IS NULL THEN '{c} PSI=unknown' ELSE printf('{c} PSI=%.3f', psi) END FROM PSI WHERE "column" = '{c}')"""
    for c in ("total_weight_g", "distance_km")
)


def judged_tables(prefix: str, min_orders: int, margin: str) -> None:
    """The verdict on every current table, with days of so many orders judged and so much margin on the error."""
    for name, source in CURRENTS.items():
        TABLES[f"m_{name}_cells"] = drift_cells(source)
        TABLES[f"m_{name}_psi"] = psi_from(sturges(f"m_{name}_cells"))
        TABLES[f"{prefix}_{name}_daily"] = f"""
SELECT CAST(order_purchase_timestamp AS DATE) AS day, count(*) AS n, avg(abs(med - delivery_days)) AS mae
FROM ({source}), s_median GROUP BY 1 HAVING count(*) >= {min_orders}"""
        TABLES[f"{prefix}_{name}"] = f"""
SELECT '{name}' AS name, mae, test_mae, {margin} AS margin, test_mae + {margin} AS mae_limit,
  coalesce(mae > test_mae + {margin}, FALSE) AS over_limit,
  (SELECT count(*) FROM m_{name}_psi WHERE psi > 2e-1 AND "column" IN ('total_weight_g', 'distance_km')) AS n_drifted,
  {PSI_TEXT.replace('PSI WHERE', f'm_{name}_psi WHERE')} AS psi_text,
  (SELECT count(*) FROM {prefix}_{name}_daily) AS n_days,
  coalesce((SELECT max(length) FROM (SELECT count(*) AS length FROM (
    SELECT day - CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS island FROM {prefix}_{name}_daily
    WHERE mae > test_mae + {margin}) GROUP BY island)), 0) AS streak
FROM (SELECT avg(abs(med - delivery_days)) AS mae FROM ({source}), s_median),
  (SELECT avg(abs(med - delivery_days)) AS test_mae FROM s_split, s_median WHERE split = 'test')"""
    TABLES[f"{prefix}_all"] = f"""
SELECT *, CASE WHEN n_drifted > 0 THEN 2 WHEN over_limit THEN 3 ELSE 0 END AS code,
  CASE WHEN n_drifted > 0 THEN 'Data Drift' WHEN over_limit THEN 'Concept Drift' ELSE 'no drift' END AS verdict,
  n_drifted > 0 OR streak >= 2 AS retrain
FROM ({' UNION ALL '.join(f'SELECT * FROM {prefix}_{n}' for n in CURRENTS)})"""


for _name in CURRENTS:
    TABLES[f"m_{_name}_ks"] = TABLES["f_ks"].replace("f_cells", f"m_{_name}_cells")
    TABLES[f"m_{_name}_ks_p"] = TABLES["f_ks_p"].replace("f_ks)", f"m_{_name}_ks)")
TABLES["m_reports"] = " UNION ALL ".join(
    drift_rows(["total_weight_g", "distance_km"]).replace("SELECT ", f"SELECT '{n}' AS name, ", 1)
    .replace("f_psi", f"m_{n}_psi").replace("f_ks_p", f"m_{n}_ks_p")
    for n in CURRENTS
)

judged_tables("m", 30, "2e0")
judged_tables("k", 2, "5e-1")

# --- evaluation ---
TABLES["e_long"] = """
SELECT order_id, split, delivery_days AS y, 'median' AS model, med AS p FROM s_split, s_median WHERE split IN ('val', 'test')
UNION ALL SELECT order_id, split, delivery_days, 'estimate', CAST(estimated_delivery_days AS DOUBLE) FROM s_split WHERE split IN ('val', 'test')
UNION ALL SELECT order_id, split, delivery_days, 'half_estimate', estimated_delivery_days / 2e0 FROM s_split WHERE split IN ('val', 'test')"""
TABLES["e_errors"] = """
SELECT model, split, count(*) AS n, avg(abs(p - y)) AS mae, sqrt(avg(pow(p - y, 2))) AS rmse FROM e_long GROUP BY 1, 2"""
TABLES["e_wide"] = """
SELECT model, max(mae) FILTER (split = 'val') AS val_mae, max(rmse) FILTER (split = 'val') AS val_rmse,
  max(mae) FILTER (split = 'test') AS test_mae, max(rmse) FILTER (split = 'test') AS test_rmse
FROM e_errors GROUP BY 1"""
TABLES["e_cases"] = """
SELECT *, new_mae < baseline_mae AS beats_baseline,
  champion_mae IS NULL OR new_mae <= champion_mae * 0.95e0 AS improves_enough
FROM (SELECT name AS "case", (SELECT test_mae FROM e_wide WHERE model = new) AS new_mae,
    (SELECT test_mae FROM e_wide WHERE model = 'median') AS baseline_mae,
    (SELECT test_mae FROM e_wide WHERE model = old) AS champion_mae
  FROM (VALUES ('half_estimate after none', 'half_estimate', 'none'),
    ('half_estimate after estimate', 'half_estimate', 'estimate'),
    ('estimate after median', 'estimate', 'median'), ('median after median', 'median', 'median')) AS t(name, new, old))"""

# --- exploration ---
TABLES["x_labels"] = f"""
SELECT *, {label('review_score')} AS actual,
  {label("CASE WHEN 4.5e0 - late_days / 1e1 < 1 THEN 1e0 WHEN 4.5e0 - late_days / 1e1 > 5 THEN 5e0 ELSE 4.5e0 - late_days / 1e1 END")} AS predicted
FROM o_clean"""
TABLES["x_groups"] = f"""
SELECT customer_unique_id, row_number() OVER (ORDER BY {hashed('customer_unique_id')}) AS place, count(*) OVER () AS n
FROM (SELECT DISTINCT customer_unique_id FROM o_clean WHERE customer_unique_id IS NOT NULL)"""
TABLES["x_split"] = """
SELECT order_id, o_clean.customer_unique_id, CASE WHEN place IS NULL THEN 'unplaced' WHEN place <= ceil(n * 0.2e0) THEN 'test'
  ELSE 'train' END AS split
FROM o_clean LEFT JOIN x_groups ON o_clean.customer_unique_id = x_groups.customer_unique_id"""
TABLES["x_days"] = """
SELECT delivery_days AS v FROM d_orders
WHERE delivery_days <= (SELECT quantile_cont(delivery_days, 0.99) FROM d_orders)"""
TABLES["x_ratio"] = """
SELECT freight_ratio AS v FROM o_clean
WHERE freight_ratio <= (SELECT quantile_cont(freight_ratio, 0.99) FROM o_clean)"""
TABLES["x_price"] = "SELECT log10(total_price) AS v FROM d_orders WHERE total_price > 0"


def histogram(table: str, n: int) -> str:
    return f"""
SELECT {big('b.bin', 'bin')}, {big('count(v)', 'n')} FROM range(0, {n}) AS b(bin) LEFT JOIN (
  SELECT v, least(CASE WHEN hi > lo THEN floor((v - lo) / (hi - lo) * {n}) ELSE 0 END, {n - 1}) AS bin
  FROM {table}, (SELECT min(v) AS lo, max(v) AS hi FROM {table})) h ON b.bin = h.bin GROUP BY 1"""


def profile(table: str, columns: list[str], name: str) -> str:
    missing = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in columns)
    return f"""SELECT '{name}' AS table_name, {big('count(*)', 'n_rows')}, {big(str(len(columns)), 'n_columns')},
  {big(f'sum({missing})', 'missing_cells')},
  {big(f'count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {table}))', 'duplicate_rows')} FROM {table}"""


def column_profile(table: str, columns: dict[str, str], name: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{kind}' AS type, {big('count(*)', 'n_rows')},
  {big(f'count(*) - count({c})', 'n_nulls')}, {big(f'count(DISTINCT {c})', 'n_distinct')},
  {r(f'count(DISTINCT {c}) / CAST(count(*) AS DOUBLE)', 'ratio')},
  CASE WHEN count(DISTINCT {c}) = count(*) THEN 'key' WHEN count(DISTINCT {c}) = 1 THEN 'constant' ELSE '' END AS flag,
  '{name}' AS table_name FROM {table}"""
        for c, kind in columns.items()
    )


COLUMNS = {
    "orders": (
        "t_orders",
        {
            "order_id": "bigint", "customer_id": "bigint", "order_status": "string",
            "order_purchase_timestamp": "timestamp", "order_approved_at": "timestamp",
            "order_delivered_carrier_date": "timestamp", "order_delivered_customer_date": "timestamp",
            "order_estimated_delivery_date": "timestamp",
        },
    ),
    "order_items": (
        "t_items",
        {
            "order_id": "bigint", "order_item_id": "bigint", "product_id": "bigint", "seller_id": "bigint",
            "shipping_limit_date": "timestamp", "price": "double", "freight_value": "double",
        },
    ),
    "order_payments": (
        "t_payments",
        {
            "order_id": "bigint", "payment_sequential": "bigint", "payment_type": "string",
            "payment_installments": "bigint", "payment_value": "double",
        },
    ),
    "order_reviews": (
        "t_all_reviews",
        {
            "review_id": "bigint", "order_id": "bigint", "review_score": "bigint",
            "review_creation_date": "timestamp", "review_answer_timestamp": "timestamp",
        },
    ),
    "customers": (
        "t_customers",
        {
            "customer_id": "bigint", "customer_unique_id": "bigint", "customer_zip_code_prefix": "string",
            "customer_city": "string", "customer_state": "string",
        },
    ),
    "sellers": (
        "t_sellers",
        {"seller_id": "bigint", "seller_zip_code_prefix": "string", "seller_state": "string"},
    ),
    "geolocation": (
        "t_geo",
        {
            "geolocation_zip_code_prefix": "string", "geolocation_lat": "double", "geolocation_lng": "double",
            "geolocation_city": "string", "geolocation_state": "string",
        },
    ),
    "products": (
        "t_products",
        {
            "product_id": "bigint", "product_category_name": "string", "product_name_lenght": "bigint",
            "product_description_lenght": "bigint", "product_photos_qty": "bigint", "product_weight_g": "double",
            "product_length_cm": "double", "product_height_cm": "double", "product_width_cm": "double",
        },
    ),
}


def fingerprint_cell(column: str, kind: str) -> str:
    """The length and the text of a value; a null has no length."""
    text = {"double": f"printf('%.4f', {column})", "timestamp": f"strftime({column}, '%Y-%m-%d %H:%M:%S')"}
    value = text.get(kind, f"CAST({column} AS VARCHAR)")
    return f"coalesce(length({value}) || ':' || {value}, '-')"


TABLES["t_all_reviews"] = """
SELECT l_suppkey AS review_id, l_orderkey AS order_id, CAST(l_quantity AS BIGINT) % 5 + 1 AS review_score,
  l_shipdate AS review_creation_date, l_shipdate AS review_answer_timestamp
FROM lineitem"""


def build(body: str) -> str:
    """Put the named subqueries that a query uses, directly or not, in front of it."""
    words = lambda text: set(re.findall(r"\b[a-z]_[a-z_]+\b", text)) & TABLES.keys()
    needed: list[str] = []

    def add(name: str) -> None:
        for other in sorted(words(TABLES[name]) - {name}):
            if other not in needed:
                add(other)
        if name not in needed:
            needed.append(name)

    for name in sorted(words(body)):
        add(name)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({TABLES[n]})" for n in needed) + "\n" + body


def daily_error(n: int) -> str:
    return f"SELECT CAST(ts AS DATE) AS day, count(*) AS n, avg(abs(p - y)) AS mae FROM t_predictions GROUP BY 1 HAVING count(*) >= {n}"


TABLES["y_daily"] = daily_error(30)
TABLES["t_uneven"] = """
SELECT ts, y, CASE WHEN day(ts) = 14 THEN y + 1 ELSE p END AS p FROM t_predictions WHERE day(ts) NOT IN (9, 20)"""
TABLES["y_uneven"] = daily_error(20).replace("t_predictions", "t_uneven")
# Days whose window has closed when the input ends.
TABLES["y_closed"] = "SELECT * FROM y_uneven WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) FROM t_uneven) - INTERVAL 1 HOUR"


def streak_rows(days: str, more: str = "") -> str:
    return f"""SELECT {big(f'(SELECT count(*) FROM {days})', 'n_days')}, {big(f'''coalesce((SELECT max(length) FROM (
  SELECT count(*) AS length FROM (SELECT day - CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS island
    FROM {days} WHERE mae > x) GROUP BY island)), 0)''', 'streak')}, x AS mae_limit{more}
FROM (VALUES (25e0), (27e0), (29e0), (100e0)) AS t(x)"""


# The run that the last closed day belongs to, none if that day is not above the limit.
LAST_RUN = """, CAST(coalesce((SELECT length FROM (SELECT max(day) AS last, count(*) AS length FROM (
    SELECT day, day - CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS island FROM y_closed WHERE mae > x) GROUP BY island)
  WHERE last = (SELECT max(day) FROM y_closed)), 0) AS BIGINT) AS run,
  strftime((SELECT max(day) FROM y_closed), '%Y-%m-%d') AS last_day"""
LOG_TOTALS = """count(*) AS requests_total, count(*) FILTER (status >= 500) AS errors_total,
  count(*) FILTER (status BETWEEN 400 AND 499) AS rejected_total"""
TABLES["y_recent"] = "SELECT * FROM t_log ORDER BY ts DESC, event_id DESC LIMIT 1000"
TABLES["y_status"] = f"""
SELECT *, (SELECT quantile_cont(latency_ms, 0.5) FROM y_recent) AS p50,
  (SELECT quantile_cont(latency_ms, 0.95) FROM y_recent) AS p95, (SELECT count(*) FROM y_recent) AS latency_count,
  (SELECT model_version FROM y_recent ORDER BY ts DESC, event_id DESC LIMIT 1) AS model_version
FROM (SELECT {LOG_TOTALS} FROM t_log)"""


def log_metrics(group: str) -> str:
    return f"""SELECT {group}, {LOG_TOTALS},
  date_diff('microsecond', min(ts), max(ts)) / 1e6 AS elapsed_s,
  count(*) FILTER (status >= 500) / greatest(count(*), 1)::DOUBLE AS error_rate,
  count(*) / nullif(date_diff('microsecond', min(ts), max(ts)) / 1e6, 0) AS throughput,
  quantile_cont(latency_ms, 0.5) AS p50, quantile_cont(latency_ms, 0.95) AS p95"""


LOG_COLUMNS = ", ".join([
    big("requests_total"), big("errors_total"), big("rejected_total"), r("elapsed_s"), r("error_rate"),
    r("throughput"), r("p50"), r("p95"),
])
TABLES["w_days"] = f"""
SELECT CAST(ts AS DATE) AS day, {LOG_TOTALS}, count(*) FILTER (status >= 500) / CAST(count(*) AS DOUBLE) AS error_rate,
  quantile_disc(latency_ms, 0.5) AS p50, quantile_disc(latency_ms, 0.95) AS p95, max(model_version) AS model_version
FROM t_log GROUP BY 1
HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM t_log) - INTERVAL 1 HOUR"""
TABLES["w_labels"] = f"""
SELECT order_purchase_timestamp, {days('order_purchase_timestamp', 'order_estimated_delivery_date')} AS p,
  {days('order_purchase_timestamp', 'order_delivered_customer_date')} AS y
FROM t_orders WHERE order_delivered_customer_date BETWEEN order_purchase_timestamp
  AND order_purchase_timestamp + INTERVAL 60 DAY"""

ORDER_ROW = f"""order_id, customer_id, customer_state, customer_city, {r('customer_lat')}, {r('customer_lng')},
  seller_state, {r('seller_lat')}, {r('seller_lng')}, {r('distance_km')}, {big('n_sellers')}, {big('n_items')},
  {r('total_price')}, {r('total_freight')}, {r('total_weight_g')}, {ts('order_purchase_timestamp')},
  {ts('order_estimated_delivery_date')}, {ts('order_delivered_customer_date')}, {big('delivery_days')},
  {big('same_state')}, {big('estimated_delivery_days')}"""
POINT = f"geolocation_zip_code_prefix, {r('geolocation_lat')}, {r('geolocation_lng')}, geolocation_city, geolocation_state"
FLAGS = f"{POINT}, {r('dist_from_zip_median_km')}, is_coord_outlier, is_duplicate_row"
JUDGED = f"""name, {r('mae')}, {r('test_mae')}, {r('margin')}, {r('mae_limit')}, over_limit, {big('n_drifted')}, psi_text,
  {big('n_days')}, {big('streak')}, {big('code')}, verdict, retrain"""
def sketch_rows(table: str, by: str, columns: dict[str, bool]) -> str:
    """Exact counts of every group and column; estimates have to lie within their bounds."""
    return " UNION ALL ".join(
        f"""SELECT {by}, '{c}' AS "column", {big('count(*)', 'n')}, {big(f'count(DISTINCT {c})', 'n_distinct')},
  TRUE AS distinct_within, {f'CASE WHEN count({c}) > 0 THEN TRUE END' if numeric else 'NULL::BOOLEAN'} AS quantiles_within FROM {table} GROUP BY 1"""
        for c, numeric in columns.items()
    )


DRIFT_ALERTS = """SELECT name || ': ' || lower(verdict) AS title, substr('inputs, drifted above 0.2: ' || psi_text || '; ' ||
  printf('error %.2f days against %.2f in the test; allowed %.2f (%.2f more)', round(mae, 2), round(test_mae, 2), round(mae_limit, 2), margin) ||
  printf('; days above that in a row: %d; ', CAST(streak AS BIGINT)) ||
  CASE WHEN retrain THEN 'train a new model' ELSE 'keep watching' END, 1, 1000) AS detail
FROM m_all WHERE code <> 0"""
SLOW_DETAIL = """printf('95 of 100 answers within %.1f ms, allowed 200; failed %.2f in 100, allowed less than 1; ', round(p95, 1),
    round(100e0 * errors_total / requests_total, 2)) ||
  printf('%d requests, %d of them turned away; model ', requests_total, rejected_total) || model_version"""
LATE_BIN = """CASE WHEN late_days <= -20 THEN 0 WHEN late_days <= -10 THEN 1 WHEN late_days <= -5 THEN 2
  WHEN late_days <= 0 THEN 3 WHEN late_days <= 5 THEN 4 WHEN late_days <= 10 THEN 5 WHEN late_days <= 20 THEN 6
  ELSE 7 END"""
LATE_LABEL = "['< -20', '-20…-10', '-10…-5', '-5…0', '1…5', '6…10', '11…20', '> 20']"
SEGMENT = f"CASE WHEN customer_state IN {NORTH} THEN 'north' WHEN {WEEK} THEN 'sale_week' ELSE 'rest' END"
DESCRIBED = ["distance_km", "total_price", "total_freight", "total_weight_g", "delivery_days"]
ESTIMATE_70 = "estimated_delivery_days * 0.7e0"
TABLES["v_sample"] = f"SELECT * FROM s_located ORDER BY {hashed('order_id')}, order_id LIMIT 50"
TABLES["v_numbered"] = f"SELECT *, row_number() OVER (ORDER BY {hashed('order_id')}, order_id) - 1 AS row_no FROM v_sample"
TABLES["v_faulty"] = """
SELECT row_no,
  CASE row_no WHEN 42 THEN 'XX' ELSE customer_state END AS customer_state,
  CASE row_no WHEN 47 THEN NULL ELSE seller_state END AS seller_state,
  CASE row_no WHEN 20 THEN '40.0' ELSE CAST(customer_lat AS VARCHAR) END AS customer_lat,
  customer_lng, seller_lat, seller_lng, n_sellers,
  CASE row_no WHEN 30 THEN 'abc' ELSE CAST(n_items AS VARCHAR) END AS n_items,
  CASE row_no WHEN 34 THEN NULL ELSE CAST(total_price AS VARCHAR) END AS total_price,
  total_freight,
  CASE row_no WHEN 4 THEN '-500.0' ELSE CAST(total_weight_g AS VARCHAR) END AS total_weight_g,
  estimated_delivery_days,
  CASE row_no WHEN 3 THEN 'not-a-date' ELSE CAST(order_purchase_timestamp AS VARCHAR) END AS order_purchase_timestamp
FROM v_numbered"""
TABLES["v_found"] = violations("v_faulty", "row_no")
TABLES["v_sale"] = f"SELECT * FROM s_located WHERE {WEEK}"
TABLES["v_north"] = f"SELECT * FROM s_located WHERE customer_state IN {NORTH}"


def part_verdict(table: str, name: str) -> str:
    return f"""SELECT '{name}' AS part, {big('count(*)', 'n_rows')},
  {big(f'(SELECT count(DISTINCT order_id) FROM ({violations(table, "order_id")}))', 'n_bad')} FROM {table}"""


HOT = {
    c: f"(SELECT {c}, row_number() OVER (ORDER BY {c}) AS slot, count(*) OVER () AS width FROM"
    f" (SELECT DISTINCT {c} FROM s_located WHERE customer_state NOT IN {NORTH}))"
    for c in ("customer_state", "seller_state")
}


def check_count(name: str, sql: str) -> str:
    return f"SELECT '{name}' AS \"check\", CAST(({sql}) AS BIGINT) AS n"


def repeated(table: str, key: str) -> str:
    return f"SELECT count(*) FROM (SELECT {key} FROM {table} GROUP BY 1 HAVING count(*) > 1)"


CHECKS = {
    "order_id_repeated": repeated("t_orders", "order_id"),
    "customer_id_repeated": repeated("t_customers", "customer_id"),
    "zip_repeated": repeated("g_zips", "geolocation_zip_code_prefix"),
    "customer_zip_length": "SELECT count(*) FROM l_customers WHERE length(customer_zip_code_prefix) <> 5",
    "seller_zip_length": "SELECT count(*) FROM l_sellers WHERE length(seller_zip_code_prefix) <> 5",
    "point_zip_length": "SELECT count(*) FROM g_points WHERE length(geolocation_zip_code_prefix) <> 5",
    "product_nulls": "SELECT count(*) FROM l_products WHERE product_category_name IS NULL OR product_weight_g IS NULL",
    "join_changed_rows": "(SELECT count(*) FROM l_buyers) - (SELECT count(*) FROM l_customers)",
    "join_lost_customers": "SELECT count(*) FROM l_customers WHERE customer_id NOT IN (SELECT customer_id FROM l_buyers)",
    "customers_without_order": "SELECT count(*) FROM t_customers WHERE customer_id NOT IN (SELECT customer_id FROM t_orders)",
    "customers_without_point": "SELECT count(*) FROM l_buyers WHERE customer_lat IS NULL",
}

BODIES: dict[str, str] = {
    "order_level": f"SELECT {ORDER_ROW} FROM d_orders",
    "order_level_csv": f"SELECT {ORDER_ROW} FROM d_orders",
    "item_level": f"""SELECT seller_id, product_id, customer_id, order_id, order_item_id, {r('price')}, {r('freight_value')},
  {ts('order_purchase_timestamp')}, {ts('order_estimated_delivery_date')}, {ts('order_delivered_customer_date')},
  {big('delivery_days')}, customer_zip_code_prefix, customer_state, customer_city, {r('customer_lat')},
  {r('customer_lng')}, {r('product_weight_g')}, seller_state, {r('seller_lat')}, {r('seller_lng')} FROM d_items""",
    "order_clean": f"""SELECT customer_id, order_id, {r('review_score')}, {big('n_reviews')}, order_status,
  {ts('order_purchase_timestamp')}, {ts('order_approved_at')}, {ts('order_delivered_carrier_date')},
  {ts('order_delivered_customer_date')}, {ts('order_estimated_delivery_date')}, {big('n_items')}, {big('n_products')},
  {big('n_sellers')}, {r('total_price')}, {r('total_freight')}, {ts('shipping_limit_date')}, {r('freight_ratio')},
  {r('total_payment')}, {big('n_payments')}, {big('max_installments')}, {big('used_voucher')}, main_payment_type,
  customer_unique_id, {big('delivery_days')}, {big('late_days')}, {big('is_late')} FROM o_clean""",
    "items_agg": f"""SELECT order_id, {big('n_items')}, {big('n_products')}, {big('n_sellers')}, {r('total_price')},
  {r('total_freight')}, {ts('shipping_limit_date')}, {r('freight_ratio')} FROM o_items""",
    "payments_agg": f"""SELECT order_id, {r('total_payment')}, {big('n_payments')}, {big('max_installments')},
  {big('used_voucher')}, main_payment_type FROM o_payments""",
    "review_agg": f"SELECT order_id, {r('review_score')}, {big('n_reviews')} FROM o_reviews",
    "zip_normalize": f"SELECT geolocation_zip_code_prefix, geolocation_city, {big('count(*)', 'n')} FROM g_points GROUP BY 1, 2",
    "geo_clean": f"SELECT {POINT} FROM g_kept",
    "geo_flags": f"SELECT {FLAGS} FROM g_flagged",
    "geo_outliers": f"SELECT {FLAGS} FROM g_flagged WHERE is_coord_outlier",
    "geo_agg": f"SELECT {POINT} FROM g_zips",
    "product_clean": f"""SELECT product_id, product_category_name, product_name_length, product_description_length,
  product_photos_qty, {r('product_weight_g')}, {r('product_length_cm')}, {r('product_height_cm')},
  {r('product_width_cm')} FROM l_products""",
    "customer_order_geo": f"""SELECT l_customers.customer_id, customer_unique_id, customer_zip_code_prefix, customer_city,
  customer_state, order_id, {ts('order_purchase_timestamp')}, {ts('order_estimated_delivery_date')},
  {ts('order_delivered_customer_date')}, {big('delivery_days')}, {POINT}
FROM l_customers LEFT JOIN d_kept ON l_customers.customer_id = d_kept.customer_id
LEFT JOIN g_zips ON customer_zip_code_prefix = geolocation_zip_code_prefix""",
    "customer_order_clash": """SELECT l_customers.customer_id, order_id, customer_city, customer_state,
  'sent ' || order_id AS customer_city_order, CASE WHEN order_id IS NOT NULL THEN 'XX' END AS customer_state_order
FROM l_customers LEFT JOIN d_kept ON l_customers.customer_id = d_kept.customer_id""",
    "rejection_texts": f"""SELECT value, {big('count(*)', 'n')} FROM (
  SELECT trim(regexp_replace('a ' || chr(9) || ' b' || chr(10) || chr(10) || '  c ', '\\s+', ' ', 'g')) || ' ' AS value
  FROM q_requests WHERE n_items = 'abc') GROUP BY value""",
    "data_gaps": f"""SELECT {big('count(*)', 'n_orders')}, {big('sum(a)', 'missing_customer_point')},
  {big('sum(b)', 'missing_seller_point')}, {big('sum(CAST(c > 1 AS BIGINT))', 'several_sellers')}
FROM (SELECT max(CAST(customer_lat IS NULL AS BIGINT)) AS a, max(CAST(seller_lat IS NULL AS BIGINT)) AS b,
  count(DISTINCT seller_id) AS c FROM d_items GROUP BY order_id)""",
    "integrity_checks": "SELECT *, n = 0 AS passes FROM ("
    + " UNION ALL ".join(check_count(n, s) for n, s in CHECKS.items()) + ")",
    "haversine": f"SELECT order_id, {r(km('customer_lat', 'customer_lng', 'seller_lat', 'seller_lng'), 'km')} FROM d_orders",
    "elapsed_days": f"""SELECT order_id,
  {days('order_purchase_timestamp', 'order_delivered_customer_date')} AS delivery_days,
  {days('order_purchase_timestamp', 'order_delivered_carrier_date')} AS carrier_days,
  {days('order_estimated_delivery_date', 'order_delivered_customer_date')} AS late_days FROM t_orders""",
    "time_features": f"""SELECT order_id, {ts('order_purchase_timestamp')},
  {big('isodow(order_purchase_timestamp) - 1', 'purchase_dow')}, {big('month(order_purchase_timestamp)', 'purchase_month')},
  {big('hour(order_purchase_timestamp)', 'purchase_hour')},
  {ts("date_trunc('month', order_purchase_timestamp)", 'month_start')} FROM t_orders""",
    "validate_rules": 'SELECT order_id, "column", rule, value FROM q_violations',
    "validate_summary": f'SELECT "column", rule, {big("count(*)", "n_rows")} FROM q_violations GROUP BY 1, 2',
    "validate_form_input": f'SELECT "column", rule, {big("count(*)", "n_rows")} FROM q_violations GROUP BY 1, 2',
    "validate_verdict": "SELECT *, n_bad = 0 AS passes FROM ("
    + " UNION ALL ".join(
        part_verdict(t, n)
        for t, n in (("s_located", "order_table"), ("v_north", "north"), ("v_sale", "sale_week"), ("q_requests", "requests"))
    ) + ")",
    "quarantine": f"""SELECT q_requests.order_id, {big('CASE WHEN reasons IS NULL THEN 200 ELSE 422 END', 'status')},
  coalesce(reasons, '') AS reasons FROM q_requests LEFT JOIN q_reasons ON q_requests.order_id = q_reasons.order_id""",
    "accepted_rows": f"""SELECT order_id, customer_state, seller_state, {r('customer_lat')}, {r('customer_lng')},
  {r('seller_lat')}, {r('seller_lng')}, {big('n_sellers')}, {big('n_items')}, {r('total_price')}, {r('total_freight')},
  {r('total_weight_g')}, {big('estimated_delivery_days')},
  {ts('CAST(order_purchase_timestamp AS TIMESTAMP)', 'order_purchase_timestamp')}
FROM q_requests WHERE order_id NOT IN (SELECT order_id FROM q_reasons)""",
    "planted_faults": f'SELECT {big("row_no")}, "column", rule, value FROM v_found',
    "profile_tables": " UNION ALL ".join(profile(t, list(c), n) for n, (t, c) in COLUMNS.items()),
    "profile_columns": " UNION ALL ".join(
        column_profile(*COLUMNS[n], n) for n in COLUMNS
    ),
    "describe_numeric": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {big(f'count({c})', 'n')}, {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'std')},
  {r(f'min({c})', '"min"')}, {r(f'quantile_cont({c}, 0.25)', 'q25')}, {r(f'quantile_cont({c}, 0.5)', 'q50')},
  {r(f'quantile_cont({c}, 0.75)', 'q75')}, {r(f'max({c})', '"max"')} FROM d_orders"""
        for c in DESCRIBED
    ),
    "describe_tables": " UNION ALL ".join(
        f"""SELECT '{n}' AS table_name, '{c}' AS "column", {big(f'count({c})', 'n')}, {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'std')},
  {r(f'min({c})', '"min"')}, {r(f'quantile_cont({c}, 0.25)', 'q25')}, {r(f'quantile_cont({c}, 0.5)', 'q50')},
  {r(f'quantile_cont({c}, 0.75)', 'q75')}, {r(f'max({c})', '"max"')} FROM {t}"""
        for n, (t, columns) in COLUMNS.items() for c, kind in columns.items() if kind in ("bigint", "double", "int")
    ),
    "describe_text": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {big(f'count({c})', 'n')}, {big(f'count(DISTINCT {c})', 'n_distinct')},
  (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
  {big(f'(SELECT count(*) FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY 1 DESC LIMIT 1)', 'freq')},
  '{n}' AS table_name FROM {t}"""
        for n, (t, columns) in COLUMNS.items() for c, kind in columns.items() if kind == "string"
    ),
    "value_counts": f"SELECT main_payment_type AS value, {big('count(*)', 'n')} FROM o_clean WHERE main_payment_type IS NOT NULL GROUP BY 1",
    "score_counts": f"SELECT {big('round_even(review_score, 0)', 'score')}, {big('count(*)', 'n')} FROM o_clean GROUP BY 1",
    "status_counts": f"SELECT order_status AS value, {big('count(*)', 'n')} FROM t_orders GROUP BY 1",
    "duplicate_rows": f"SELECT {POINT} FROM g_flagged WHERE is_duplicate_row",
    "repeat_customers": f"""SELECT o_custkey AS customer_unique_id, {big('count(DISTINCT o_orderkey)', 'n_ids')} FROM orders
GROUP BY 1 HAVING count(DISTINCT o_orderkey) > 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "dataset_fingerprint": " UNION ALL ".join(
        f"""SELECT '{n}' AS table_name, {big('count(*)', 'n_rows')},
  {big("sum(CAST('0x' || substr(md5(concat_ws('|', " + ", ".join(fingerprint_cell(c, k) for c, k in columns.items())
       + ")), 1, 8) AS BIGINT))", 'checksum')} FROM {t}"""
        for n, (t, columns) in COLUMNS.items()
    ),
    "order_satisfaction": f"""SELECT order_id, {r('review_score')}, {label('review_score')} AS label, {big('late_days')},
  {big('is_late')}, {LATE_LABEL}[{LATE_BIN} + 1] AS late_bin FROM o_clean""",
    "satisfaction_share": f"""SELECT l AS label, {big('count(*) FILTER (actual = l)', 'n')},
  {r('count(*) FILTER (actual = l) / CAST(count(*) AS DOUBLE)', 'share')}
FROM x_labels, (VALUES ('satisfied'), ('unsatisfied')) AS t(l) GROUP BY 1""",
    "score_by_group": f"""SELECT CAST(is_late AS VARCHAR) AS name, {big('count(*)', 'n')}, {r('avg(review_score)', 'mean_score')},
  'is_late' AS "grouping" FROM o_clean GROUP BY 1
UNION ALL SELECT CASE WHEN n_items >= 4 THEN '4+' ELSE CAST(n_items AS VARCHAR) END, {big('count(*)', 'n')},
  {r('avg(review_score)', 'mean_score')}, 'n_items' FROM o_clean WHERE n_items IS NOT NULL GROUP BY 1""",
    "score_by_late_bin": f"""SELECT {big(LATE_BIN, 'bin')}, {LATE_LABEL}[{LATE_BIN} + 1] AS late_bin, {big('count(*)', 'n')},
  {r('avg(review_score)', 'mean_score')} FROM o_clean GROUP BY 1, 2""",
    "monthly_pivot": "SELECT "
    + ts("month_start", "month") + f", {big('count(*)', 'n')}, "
    + ", ".join(
        big(f"count(*) FILTER (main_payment_type = '{t}')", t)
        for t in ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
    )
    + """ FROM (SELECT *, date_trunc('month', order_purchase_timestamp) AS month_start FROM o_clean
  WHERE main_payment_type IS NOT NULL) GROUP BY month_start HAVING count(*) >= 100""",
    "monthly_orders": f"""SELECT {ts('month_start', 'month')}, {big('count(*)', 'n')},
  {r("100 * avg(CASE WHEN actual = 'unsatisfied' THEN 1e0 ELSE 0e0 END)", 'unsatisfied_pct')}
FROM (SELECT *, date_trunc('month', order_purchase_timestamp) AS month_start FROM x_labels)
GROUP BY month_start HAVING count(*) >= 100""",
    "monthly_pivot_thin": "SELECT "
    + ts("month_start", "month") + f", {big('count(*)', 'n')}, "
    + ", ".join(
        big(f"count(*) FILTER (main_payment_type = '{t}')", t)
        for t in ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
    )
    + """ FROM (SELECT *, date_trunc('month', order_purchase_timestamp) AS month_start FROM o_clean
  WHERE main_payment_type IS NOT NULL) GROUP BY month_start HAVING count(*) >= 10""",
    "monthly_orders_thin": f"""SELECT {ts('month_start', 'month')}, {big('count(*)', 'n')},
  {r("100 * avg(CASE WHEN actual = 'unsatisfied' THEN 1e0 ELSE 0e0 END)", 'unsatisfied_pct')}
FROM (SELECT *, date_trunc('month', order_purchase_timestamp) AS month_start FROM x_labels)
GROUP BY month_start HAVING count(*) >= 50""",
    "histogram_trimmed": f"""SELECT {big('b.bin', 'bin')}, {big('count(v)', 'n')}
FROM range(0, (SELECT max(v) + 1 FROM x_days)) AS b(bin) LEFT JOIN x_days ON v = bin GROUP BY 1""",
    "histogram_equal": histogram("x_ratio", 50),
    "histogram_log": histogram("x_price", 49),
    "segment_summary": f"""SELECT {SEGMENT} AS segment, {big('count(*)', 'n')}, {r('avg(delivery_days)', 'mean_days')},
  {r('avg(estimated_delivery_days)', 'mean_estimate')}, {r('quantile_cont(distance_km, 0.5)', 'median_distance_km')},
  {r('quantile_cont(total_weight_g, 0.5)', 'median_total_weight_g')},
  {r('quantile_cont(delivery_days, 0.5)', 'median_delivery_days')} FROM s_located GROUP BY 1""",
    "satisfaction_confusion": f"SELECT actual, predicted, {big('count(*)', 'n')} FROM x_labels GROUP BY 1, 2",
    "satisfaction_recall": f"""SELECT label, {r('p', 'precision')}, {r('q', 'recall')},
  {r('CASE WHEN p + q > 0 THEN 2 * p * q / (p + q) ELSE 0 END', 'f1')}, {big('support')}
FROM (SELECT l AS label, count(*) FILTER (actual = l) AS support,
    coalesce(count(*) FILTER (actual = l AND predicted = l) / nullif(count(*) FILTER (predicted = l), 0)::DOUBLE, 0) AS p,
    coalesce(count(*) FILTER (actual = l AND predicted = l) / nullif(count(*) FILTER (actual = l), 0)::DOUBLE, 0) AS q
  FROM x_labels, (VALUES ('satisfied'), ('unsatisfied')) AS t(l) GROUP BY 1)""",
    "time_split": f"SELECT order_id, {ts('order_purchase_timestamp')}, split FROM s_split",
    "group_split": "SELECT order_id, customer_unique_id, split FROM x_split",
    "group_split_overlap": """SELECT count(*) AS n_shared FROM (SELECT customer_unique_id FROM x_split WHERE split = 'train'
  INTERSECT SELECT customer_unique_id FROM x_split WHERE split = 'test')""",
    "seeded_sample": f"""SELECT order_id, {r('distance_km')}, {big('delivery_days')} FROM s_split WHERE split = 'test'
ORDER BY {hashed('order_id')}, order_id LIMIT 500""",
    "drift_segments": f"""SELECT order_id, customer_state, {ts('order_purchase_timestamp')}, 'north' AS segment FROM v_north
UNION ALL SELECT order_id, customer_state, {ts('order_purchase_timestamp')}, 'sale_week' FROM v_sale""",
    "features": f"""SELECT order_id, customer_state, seller_state, {r('customer_lat')}, {r('customer_lng')}, {r('seller_lat')},
  {r('seller_lng')}, {big('n_sellers')}, {big('n_items')}, {r('total_price')}, {r('total_freight')}, {r('total_weight_g')},
  {big('estimated_delivery_days')}, {r('distance_km')}, {big('same_state')},
  {big('isodow(order_purchase_timestamp) - 1', 'purchase_dow')}, {big('month(order_purchase_timestamp)', 'purchase_month')},
  {big('hour(order_purchase_timestamp)', 'purchase_hour')} FROM s_located""",
    "one_hot_states": f"""SELECT order_id, coalesce(a.slot, 0) AS customer_state_slot, coalesce(b.slot, 0) AS seller_state_slot,
  {big(f"(SELECT max(width) FROM {HOT['customer_state']})", 'customer_state_width')},
  {big(f"(SELECT max(width) FROM {HOT['seller_state']})", 'seller_state_width')}
FROM s_located LEFT JOIN {HOT['customer_state']} a ON s_located.customer_state = a.customer_state
LEFT JOIN {HOT['seller_state']} b ON s_located.seller_state = b.seller_state""",
    "baseline_estimate_mae": f"SELECT split, {big('count(*)', 'n')}, {r('avg(abs(estimated_delivery_days - delivery_days))', 'mae')} FROM s_split GROUP BY 1",
    "promotion_gate_fitted": f"""SELECT {big('step')}, model, {big('step', 'version')}, {big('champion')}, {big('n')}, {r('baseline_mae')},
  promoted, {big('pointer')}, below_baseline, {big('n_reasons')}
FROM (VALUES (1, 'median', NULL, FALSE, NULL, FALSE, 1), (2, 'linear_regression', NULL, TRUE, 2, TRUE, 0),
    (3, 'linear_regression', 2, FALSE, 2, TRUE, 1), (4, 'median', 2, FALSE, 2, FALSE, 2),
    (5, 'linear_regression', 2, FALSE, 2, TRUE, 2)) t(step, model, champion, promoted, pointer, below_baseline, n_reasons),
  (SELECT count(*) AS n, avg(abs(med - delivery_days)) AS baseline_mae FROM s_split, s_median WHERE split = 'test')""",
    "drift_verdict_fitted": f"""SELECT name, {big('1', 'version')}, {big('n_drifted')}, psi_text, {big('n_days')},
  TRUE AS test_below_median, TRUE AS code_follows, TRUE AS retrain_follows FROM m_all""",
    "run_records": f"""SELECT *, unnest(['run-1', 'run-2']) AS run_id FROM (
SELECT 'rows' AS kind, NULL AS model, split, 'n' AS name, CAST(count(*) AS DOUBLE) AS number, NULL AS text FROM s_split GROUP BY split
UNION ALL SELECT 'table', NULL, NULL, 'n', count(*), NULL FROM s_split
UNION ALL SELECT 'table', NULL, NULL, 'checksum', NULL, CAST(sum(CAST('0x' || substr(md5(concat_ws('|',
  length(CAST(order_id AS VARCHAR)) || ':' || order_id, length(split) || ':' || split,
  length(CAST(delivery_days AS VARCHAR)) || ':' || delivery_days)), 1, 8) AS BIGINT)) AS VARCHAR) FROM s_split
UNION ALL SELECT 'param', unnest(['median', 'linear_regression']), NULL, 'given', NULL, 'true'
UNION ALL SELECT 'metric', 'median', split, unnest(['n', 'mae', 'rmse']),
  unnest([CAST(count(*) AS DOUBLE), round(avg(abs(med - delivery_days)), 4), round(sqrt(avg(pow(med - delivery_days, 2))), 4)]),
  unnest(['false', 'true', 'true']) FROM s_split, s_median WHERE split IN ('val', 'test') GROUP BY split)""",
    "baseline_median_mae": f"""SELECT split, {big('count(*)', 'n')}, {r('max(med)', 'median_days')},
  {r('avg(abs(med - delivery_days))', 'mae')}, {r('sqrt(avg(pow(med - delivery_days, 2)))', 'rmse')}
FROM s_split, s_median WHERE split IN ('val', 'test') GROUP BY 1""",
    "model_errors": f"SELECT model, split, {big('n')}, {r('mae')}, {r('rmse')} FROM e_errors",
    "model_choice": f"""SELECT model, {r('val_mae')}, {r('val_rmse')}, {r('test_mae')}, {r('test_rmse')},
  model = (SELECT model FROM e_wide ORDER BY val_mae, model LIMIT 1) AS is_best FROM e_wide""",
    "promotion_gate": f"""SELECT "case", {r('new_mae')}, {r('baseline_mae')}, {r('champion_mae')}, beats_baseline, improves_enough,
  beats_baseline AND improves_enough AS promoted,
  concat_ws('; ', CASE WHEN NOT beats_baseline THEN printf('error %.3f is not below the baseline''s %.3f', new_mae, baseline_mae) END,
    CASE WHEN NOT improves_enough THEN printf('error %.3f is not 5 in 100 below the current model''s %.3f', new_mae, champion_mae) END)
  AS reasons FROM e_cases""",
    "promotion_gate_latency": f"""SELECT 'version ' || model_version || ' at ' || times || ' x' AS "case", {r('p95_ms')}, {r('new_mae')},
  {r('baseline_mae')}, {r('NULL', 'champion_mae')}, beats_baseline, TRUE AS improves_enough, beats_baseline AND p95_ms < 200 AS promoted,
  concat_ws('; ', CASE WHEN NOT beats_baseline THEN printf('error %.3f is not below the baseline''s %.3f', new_mae, baseline_mae) END,
    CASE WHEN p95_ms >= 200 THEN 'answers take ms, allowed less than 200' END) AS reasons
FROM (SELECT *, new_mae < baseline_mae AS beats_baseline FROM (
  SELECT model_version, times, times * p95 AS p95_ms, (SELECT test_mae FROM e_wide WHERE model = 'half_estimate') AS new_mae,
    (SELECT test_mae FROM e_wide WHERE model = 'estimate') AS baseline_mae
  FROM (SELECT model_version, quantile_cont(latency_ms, 0.95) AS p95 FROM t_log GROUP BY 1), (VALUES (1), (2)) AS t(times)))""",
    "stream_score_check": "SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_different FROM q_requests WHERE order_id NOT IN (SELECT order_id FROM q_reasons)",
    "late_vs_predicted": f"""SELECT split, {big('count(*)', 'n')},
  {r('avg(CASE WHEN delivery_days > med THEN 1e0 ELSE 0e0 END)', 'late_share')} FROM s_split, s_median GROUP BY 1""",
    "arrivals_by_state_day": f"""SELECT customer_state, strftime(CAST(order_purchase_timestamp AS DATE)
  + CAST(ceil(CASE WHEN {ESTIMATE_70} < 0 THEN 0e0 ELSE {ESTIMATE_70} END) AS INTEGER), '%Y-%m-%d') AS arrival_day,
  {big('count(*)', 'n_orders')} FROM s_located GROUP BY 1, 2""",
    "drift_psi": f'SELECT "column", {r("psi")} FROM f_psi',
    "drift_psi_deciles": f'SELECT "column", {r("psi")} FROM (' + psi_from(
        'SELECT "column", ref, cur, len(list_filter(cuts, lambda c: v > c)) AS bin FROM f_cells JOIN (SELECT "column",'
        " quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS cuts FROM f_cells WHERE ref = 1 GROUP BY 1)"
        ' USING ("column")'
    ) + ")",
    "drift_ks": f'SELECT "column", {r("ks_d")}, {r("ks_p")} FROM f_ks_p',
    "drift_report": drift_rows(["total_weight_g", "distance_km"]),
    "drift_report_all_columns": drift_rows(DRIFT_COLUMNS),
    "concept_drift": f"SELECT {r('mae')}, {r('test_mae')}, {r('2', 'margin')}, {r('test_mae + 2', 'mae_limit')}, coalesce(mae > test_mae + 2, FALSE) AS over_limit FROM m_sale_week",
    "drift_verdict": f"SELECT {JUDGED} FROM m_all",
    "drift_verdict_small_days": f"SELECT {JUDGED} FROM k_all",
    "drift_alerts": DRIFT_ALERTS,
    "drift_alerts_kept": f"SELECT *, unnest(['run-1', 'run-2']) AS run_id FROM ({DRIFT_ALERTS})",
    "drift_reports_kept": "SELECT *, 'run-1' AS run_id FROM m_reports UNION ALL SELECT *, 'run-2' FROM m_reports WHERE name = 'north'",
    "daily_mae": f"SELECT strftime(day, '%Y-%m-%d') AS day, {big('n')}, {r('mae')} FROM y_daily",
    "rescued_items": f"""SELECT * FROM (
  SELECT 'price' AS "column", {big("count(*)", "n")}, min('n/a') AS first FROM t_items WHERE order_id % 97 = 0
  UNION ALL SELECT 'shipping_limit_date', count(*), min('day ' || order_id) FROM t_items WHERE order_id % 83 = 0
  UNION ALL SELECT 'order_item_id', count(*), min('1.5') FROM t_items WHERE order_id % 79 = 0) WHERE n > 0
UNION ALL SELECT 'all rows', count(*), CAST(count(*) FILTER (order_id % 97 = 0 OR order_id % 89 = 0) AS VARCHAR) FROM t_items""",
    "mae_streak": streak_rows("y_daily"),
    "mae_streak_uneven": streak_rows("y_uneven"),
    "stream_mae_streak": streak_rows("y_closed", LAST_RUN),
    "request_sketches": sketch_rows("t_log", "model_version", {"latency_ms": True, "event_id": False, "status": False}),
    "order_sketches": sketch_rows("d_orders", "strftime(order_purchase_timestamp, '%Y') AS year", {
        **{c: True for c in ("distance_km", "total_price", "total_freight", "total_weight_g", "delivery_days")},
        "customer_id": False, "customer_state": False, "order_id": False,
    }),
    "request_metrics": f"""SELECT {LOG_COLUMNS}, model_version FROM (
  {log_metrics("'all' AS model_version")} FROM t_log UNION ALL {log_metrics("model_version")} FROM t_log GROUP BY model_version)""",
    "request_last_1000": f"""SELECT {big('requests_total')}, {big('errors_total')}, {big('rejected_total')}, {r('p50')}, {r('p95')},
  {big('latency_count')}, model_version FROM y_status""",
    "slo_check": f"""SELECT strftime(day, '%Y-%m-%d') AS day, {LOG_COLUMNS}, p95 > 200 OR error_rate >= 1e-2 AS broken
FROM ({log_metrics("CAST(ts AS DATE) AS day")} FROM t_log GROUP BY 1)""",
    "alert_rows": f"""SELECT q_requests.order_id, 'Request turned away' AS title,
  substr(substr(reasons, 1, 700) || ' | sent: ' || substr(CAST(to_json(struct_pack(
    {', '.join(f'{c} := {c}' for c, *_ in RULES)})) AS VARCHAR), 1, 280), 1, 1000) AS detail
FROM q_requests JOIN q_reasons ON q_requests.order_id = q_reasons.order_id
UNION ALL SELECT NULL, 'Service outside its limits', {SLOW_DETAIL}
FROM y_status WHERE p95 > 200 OR errors_total / requests_total::DOUBLE >= 1e-2""",
    "stream_quarantine": f"""SELECT 'accepted' AS sink, {big('count(*)', 'n')} FROM q_requests WHERE order_id NOT IN (SELECT order_id FROM q_reasons)
UNION ALL SELECT 'quarantine', count(*) FROM q_reasons UNION ALL SELECT 'alerts', count(*) FROM q_reasons
UNION ALL SELECT "column" || ': ' || rule, count(*) FROM q_violations GROUP BY 1""",
    "stream_request_metrics": f"""SELECT {ts('day', 'window_start')}, {big('requests_total')}, {big('errors_total')},
  {big('rejected_total')}, {r('error_rate')}, {r('p50')}, {r('p95')}, model_version FROM w_days""",
    "stream_alerts": f"""SELECT {ts('day', 'window_start')}, 'Service outside its limits' AS title, {SLOW_DETAIL} AS detail
FROM w_days WHERE p95 > 200 OR error_rate >= 1e-2""",
    "stream_unlabelled": f"""SELECT strftime(order_purchase_timestamp, '%Y-%m') AS month,
  {big('count(*) FILTER (in_time)', 'n_labelled')}, {big('count(*) FILTER (NOT in_time)', 'n_unlabelled')}
FROM (SELECT order_purchase_timestamp, coalesce(order_delivered_customer_date BETWEEN order_purchase_timestamp
    AND order_purchase_timestamp + INTERVAL 60 DAY, FALSE) AS in_time FROM t_orders)
WHERE in_time OR order_purchase_timestamp + INTERVAL 60 DAY < (SELECT least(max(order_purchase_timestamp),
  max(order_delivered_customer_date)) - INTERVAL 1 DAY FROM t_orders) GROUP BY 1""",
    "stream_label_gaps": f"""SELECT {big('count(*)', 'n_labels')},
  {big("count(*) - (SELECT count(*) FROM w_labels)", 'n_unjoined')}
FROM t_orders WHERE order_delivered_customer_date IS NOT NULL""",
    "stream_daily_mae_small_days": f"""SELECT strftime(CAST(order_purchase_timestamp AS DATE), '%Y-%m-%d') AS day,
  {big('count(*)', 'n')}, {r('avg(abs(p - y))', 'mae')} FROM w_labels GROUP BY 1 HAVING count(*) >= 5""",
    "stream_daily_mae": f"""SELECT strftime(CAST(order_purchase_timestamp AS DATE), '%Y-%m-%d') AS day, {big('count(*)', 'n')},
  {r('avg(abs(p - y))', 'mae')} FROM w_labels GROUP BY 1 HAVING count(*) >= 30""",
}

ORACLE_SQL: dict[str, str] = {name: build(body) for name, body in BODIES.items()}
