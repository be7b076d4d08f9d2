"""Independent SQL statements of every checked query, for the DuckDB oracle.

The oracle runs on the raw test tables (pre-registered views ``orders``,
``lineitem``, ``customer``, ...).  ``BINDING`` restates the marketplace binding
as CTEs and ``MASTER`` the master build; each query string is
``WITH <binding>, <master>, ... SELECT ...``.  Written from the semantics, not
from the Spark code: windows and correlated forms are used freely here because
the oracle only ever runs on small data.
"""

from __future__ import annotations

BINDING = """
b_orders AS (
  SELECT o_orderkey AS order_id, o_orderkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                            WHEN 'P' THEN 'processing' END AS order_status,
         o_orderdate + to_seconds(CAST((o_orderkey * 7919) % 86400 AS BIGINT)) AS order_purchase_timestamp,
         o_orderdate + to_seconds(CAST((o_orderkey * 7919) % 86400 AS BIGINT)) + INTERVAL 1 HOUR AS order_approved_at,
         o_orderdate + to_seconds(CAST((o_orderkey * 7919) % 86400 AS BIGINT)) + INTERVAL 1 DAY AS order_delivered_carrier_date,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 97 <> 0
              THEN o_orderdate + to_seconds(CAST((o_orderkey * 7919) % 86400 AS BIGINT))
                   + to_days(CAST((o_orderkey * 37 + o_custkey * 11) % 40 + 1 AS INTEGER)) END
           AS order_delivered_customer_date,
         o_orderdate + to_days(CAST((o_orderkey * 13) % 25 + 20 AS INTEGER)) AS order_estimated_delivery_date
  FROM orders),
b_customers AS (
  SELECT o.o_orderkey AS customer_id, o.o_custkey AS customer_unique_id,
         c.c_nationkey * 10 + c.c_custkey % 10 AS customer_zip_code_prefix,
         'city_' || CAST(c.c_custkey % 50 AS VARCHAR) AS customer_city,
         n.n_name AS customer_state
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
b_lines AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
            l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax,
            l_returnflag, l_linestatus) AS INTEGER) AS order_item_id
  FROM lineitem),
b_items AS (
  SELECT l_orderkey AS order_id, order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
         l_extendedprice AS price,
         CAST(round(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_tax AS DECIMAL(15,2)), 2) AS DOUBLE)
           AS freight_value
  FROM b_lines),
b_payments AS (
  SELECT l_orderkey AS order_id, order_item_id AS payment_sequential,
         CASE l_returnflag WHEN 'R' THEN 'credit_card' WHEN 'A' THEN 'boleto'
                           WHEN 'N' THEN 'voucher' END AS payment_type,
         CAST(floor(l_quantity) AS INTEGER) % 12 + 1 AS payment_installments,
         CAST(round(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2)))
                    * (1 + CAST(l_tax AS DECIMAL(15,2))), 2) AS DOUBLE) AS payment_value
  FROM b_lines WHERE l_orderkey % 50 <> 0),
b_reviews AS (
  SELECT e.event_id AS review_id, e.event_id // 2 AS order_id,
         CAST(1 + (e.event_id * 7 + e.user_id) % 5 AS INTEGER) AS review_score,
         CASE WHEN e.event_type = 'purchase' THEN
           CASE e.event_id % 3
             WHEN 0 THEN (['excelente', 'ótimo', 'perfeito', 'adorei', 'parabéns', 'recomendo', 'rápido'])[1 + (e.event_id // 3) % 7]
             WHEN 1 THEN (['ruim', 'péssimo', 'não', 'atraso', 'defeito', 'problema'])[1 + (e.event_id // 3) % 6]
             ELSE 'title ' || e.event_type END END AS review_comment_title,
         CASE WHEN e.event_type <> 'error' THEN d.text END AS review_comment_message,
         e.ts AS review_creation_date, e.ts AS review_answer_timestamp
  FROM events e LEFT JOIN (
    SELECT min(text) AS text, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents
    WHERE doc_id IS NOT NULL GROUP BY doc_id) d
  ON d.place = e.event_id % (SELECT count(DISTINCT doc_id) FROM documents)),
b_sellers AS (
  SELECT s.s_suppkey AS seller_id, s.s_nationkey * 10 + s.s_suppkey % 10 AS seller_zip_code_prefix,
         'city_' || CAST(s.s_suppkey % 50 AS VARCHAR) AS seller_city, n.n_name AS seller_state
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey),
b_products AS (
  SELECT p_partkey AS product_id,
         CASE WHEN p_partkey % 50 <> 0 THEN lower(p_type) END AS product_category_name,
         CAST(CASE WHEN p_partkey % 40 <> 0 THEN p_size * 100 END AS DOUBLE) AS product_weight_g,
         CAST(p_size % 30 + 10 AS DOUBLE) AS product_length_cm,
         CAST(p_size % 20 + 5 AS DOUBLE) AS product_height_cm,
         CAST(p_size % 25 + 8 AS DOUBLE) AS product_width_cm,
         CAST(p_partkey % 6 + 1 AS DOUBLE) AS product_photos_qty
  FROM part),
b_translation AS (
  SELECT DISTINCT lower(p_type) AS product_category_name,
         'cat_' || lower(p_type) AS product_category_name_english
  FROM part WHERE p_type <> 'PROMO'),
b_geo_src AS (
  SELECT c_custkey AS key, c_nationkey AS nk FROM customer
  UNION ALL SELECT s_suppkey, s_nationkey FROM supplier),
b_geolocation AS (
  SELECT g.nk * 10 + g.key % 10 AS geolocation_zip_code_prefix,
         -30 + g.nk + (g.key % 7) * 0.1 AS geolocation_lat,
         -70 + g.nk * 0.5 + (g.key % 11) * 0.1 AS geolocation_lng,
         'city_' || CAST(g.key % 5 AS VARCHAR) AS geolocation_city,
         n.n_name AS geolocation_state
  FROM b_geo_src g LEFT JOIN nation n ON g.nk = n.n_nationkey
  WHERE g.nk <> 24)
"""


def mode_cte(name: str, table: str, key: str, value: str, out: str) -> str:
    """CTE with the most frequent non-null ``value`` per ``key``; ties -> smallest value."""
    return f"""
{name} AS (
  SELECT {key}, {value} AS {out} FROM (
    SELECT {key}, {value}, row_number() OVER (PARTITION BY {key}
             ORDER BY count(*) DESC, {value} ASC) AS rn
    FROM {table} WHERE {value} IS NOT NULL AND {key} IS NOT NULL GROUP BY {key}, {value}) x
  WHERE rn = 1)"""


MASTER = """
g_mean AS (
  SELECT geolocation_zip_code_prefix, avg(geolocation_lat) AS geolocation_lat,
         avg(geolocation_lng) AS geolocation_lng
  FROM b_geolocation WHERE geolocation_zip_code_prefix IS NOT NULL GROUP BY 1),""" + \
    mode_cte("g_city", "b_geolocation", "geolocation_zip_code_prefix", "geolocation_city",
             "geolocation_city") + "," + \
    mode_cte("g_state", "b_geolocation", "geolocation_zip_code_prefix", "geolocation_state",
             "geolocation_state") + """,
geo_zip AS (
  SELECT m.*, c.geolocation_city, s.geolocation_state
  FROM g_mean m LEFT JOIN g_city c USING (geolocation_zip_code_prefix)
  LEFT JOIN g_state s USING (geolocation_zip_code_prefix)),
customers_geo AS (
  SELECT c.*, g.geolocation_lat AS customer_lat, g.geolocation_lng AS customer_lng,
         g.geolocation_city AS customer_geo_city, g.geolocation_state AS customer_geo_state
  FROM b_customers c LEFT JOIN geo_zip g ON c.customer_zip_code_prefix = g.geolocation_zip_code_prefix),
sellers_geo AS (
  SELECT s.*, g.geolocation_lat AS seller_lat, g.geolocation_lng AS seller_lng,
         g.geolocation_city AS seller_geo_city, g.geolocation_state AS seller_geo_state
  FROM b_sellers s LEFT JOIN geo_zip g ON s.seller_zip_code_prefix = g.geolocation_zip_code_prefix),""" + \
    mode_cte("pay_mode", "b_payments", "order_id", "payment_type", "payment_type_main") + """,
pay_by_order AS (
  SELECT p.order_id, count(payment_sequential) AS payment_count, m.payment_type_main,
         max(payment_installments) AS payment_installments_max,
         coalesce(sum(payment_value), 0.0) AS payment_value_total
  FROM b_payments p LEFT JOIN pay_mode m USING (order_id)
  WHERE p.order_id IS NOT NULL GROUP BY p.order_id, m.payment_type_main),
rev_by_order AS (
  SELECT order_id,
    arg_max(review_score, (review_answer_timestamp, review_id)) FILTER (WHERE review_score IS NOT NULL) AS review_score,
    avg(review_score) AS review_score_mean,
    arg_max(review_comment_title, (review_answer_timestamp, review_id)) FILTER (WHERE review_comment_title IS NOT NULL) AS review_title,
    arg_max(review_comment_message, (review_answer_timestamp, review_id)) FILTER (WHERE review_comment_message IS NOT NULL) AS review_message
  FROM b_reviews WHERE order_id IS NOT NULL GROUP BY order_id),
master_raw AS (
  SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp, o.order_approved_at,
         o.order_delivered_carrier_date, o.order_delivered_customer_date, o.order_estimated_delivery_date,
         c.customer_unique_id, c.customer_zip_code_prefix, c.customer_city, c.customer_state,
         c.customer_lat, c.customer_lng, c.customer_geo_city, c.customer_geo_state,
         i.order_item_id, i.product_id, i.seller_id, i.price, i.freight_value,
         s.seller_zip_code_prefix, s.seller_city, s.seller_state, s.seller_lat, s.seller_lng,
         s.seller_geo_city, s.seller_geo_state,
         p.product_category_name, p.product_weight_g, p.product_length_cm, p.product_height_cm,
         p.product_width_cm, p.product_photos_qty, t.product_category_name_english,
         pb.payment_count, pb.payment_type_main, pb.payment_installments_max, pb.payment_value_total,
         r.review_score, r.review_score_mean, r.review_title, r.review_message
  FROM b_orders o
  LEFT JOIN customers_geo c ON o.customer_id = c.customer_id
  LEFT JOIN b_items i ON o.order_id = i.order_id
  LEFT JOIN sellers_geo s ON i.seller_id = s.seller_id
  LEFT JOIN b_products p ON i.product_id = p.product_id
  LEFT JOIN b_translation t ON p.product_category_name = t.product_category_name
  LEFT JOIN pay_by_order pb ON o.order_id = pb.order_id
  LEFT JOIN rev_by_order r ON o.order_id = r.order_id),
master AS (
  SELECT *,
    CASE WHEN customer_lat IS NOT NULL AND customer_lng IS NOT NULL AND seller_lat IS NOT NULL
              AND seller_lng IS NOT NULL THEN
    2 * 6371.0 * asin(sqrt(least(
      pow(sin((radians(seller_lat) - radians(customer_lat)) / 2), 2)
      + cos(radians(customer_lat)) * cos(radians(seller_lat))
        * pow(sin((radians(seller_lng) - radians(customer_lng)) / 2), 2), 1.0))) END AS distance_customer_seller_km
  FROM master_raw),
master_orders AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_item_id NULLS FIRST) AS _rn
    FROM master) x WHERE _rn = 1)
"""


def with_master(select_sql: str, extra_ctes: str = "") -> str:
    """``WITH binding, master[, extra] <select>``."""
    extra = ("," + extra_ctes) if extra_ctes.strip() else ""
    return "WITH " + BINDING + "," + MASTER + extra + "\n" + select_sql


def rounded(select_sql: str, double_cols: list[str], digits: int = 6) -> str:
    """Round the given double output columns of a query (mirrors ``round_doubles``)."""
    if not double_cols:
        return select_sql
    repl = ", ".join(f"round(round({c}, {digits + 3}), {digits}) AS {c}" for c in double_cols)
    return f"SELECT * REPLACE ({repl}) FROM ({select_sql}) _q"
