"""Independent DuckDB SQL for every registered query (the correctness oracle).

``PRELUDE`` rebuilds, from the driver's raw views, the same chain the Spark
side builds: binding → staging → fact → dimensions → order grain.  Each query
is ``PRELUDE`` + its own CTEs + a final SELECT.  Only CTEs a query references
are evaluated by DuckDB.
"""
from __future__ import annotations

AS_OF = "TIMESTAMP '2001-08-01 00:00:00'"
HIGH_VALUE = "100000"

PRELUDE = r"""
WITH
b_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(o_orderkey AS VARCHAR) AS customer_id,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL
              WHEN o_orderstatus = 'F' THEN 'Delivered'
              WHEN o_orderstatus = 'O' THEN 'shipped'
              WHEN o_orderstatus = 'P' THEN 'processing' END AS order_status,
         o_orderdate AS order_purchase_timestamp,
         o_orderdate + to_hours(CAST(o_orderkey % 72 AS BIGINT)) AS order_approved_at,
         o_orderdate + to_days(CAST(o_orderkey % 5 AS INTEGER)) AS order_delivered_carrier_date,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 53 <> 0 THEN
              CASE WHEN o_orderkey % 211 = 0 THEN o_orderdate - to_days(2)
                   ELSE o_orderdate + to_days(CAST((o_orderkey * 7) % 40 AS INTEGER)) END
         END AS order_delivered_customer_date,
         o_orderdate + to_days(CAST(o_custkey % 5 + 20 AS INTEGER)) AS order_estimated_delivery_date
  FROM orders
),
b_customers AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS customer_id,
         CASE WHEN o.o_orderkey % 10 < 8 THEN 'O' || CAST(o.o_orderkey AS VARCHAR)
              ELSE 'C' || CAST(o.o_custkey AS VARCHAR) END AS customer_unique_id,
         CAST(c.c_nationkey AS VARCHAR) AS customer_zip_code_prefix,
         c.c_mktsegment AS customer_city,
         n.n_name AS customer_state
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
b_items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_linenumber AS BIGINT) AS order_item_id,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_suppkey AS VARCHAR) AS seller_id,
         l_shipdate AS shipping_limit_date,
         CASE WHEN l_quantity = 1 THEN 0.0 ELSE l_extendedprice END AS price,
         CASE WHEN l_linenumber = 7 THEN -1.0 ELSE l_quantity END AS freight_value
  FROM lineitem
),
b_payments AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(s.seq AS BIGINT) AS payment_sequential,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'credit_card' WHEN '2' THEN 'boleto'
              WHEN '3' THEN 'debit_card' WHEN '5' THEN 'voucher' END AS payment_type,
         CAST(o_custkey % 10 + 1 AS BIGINT) AS payment_installments,
         o_totalprice AS payment_value
  FROM orders, (VALUES (1), (2)) s(seq)
  WHERE (s.seq = 1 AND o_orderkey % 29 <> 0) OR (s.seq = 2 AND o_orderkey % 10 = 0)
),
b_reviews AS (
  SELECT CAST(event_id // 2 AS VARCHAR) AS review_id,
         CAST(CASE WHEN (event_id // 2) % 10 = 9 THEN ((event_id // 2) - 1) * 3
                   ELSE (event_id // 2) * 3 END AS VARCHAR) AS order_id,
         CAST(floor(value) AS BIGINT) % 5 + 1 AS review_score,
         event_type AS review_comment_title,
         CASE WHEN event_id % 3 = 0 THEN '' ELSE props END AS review_comment_message,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) AS review_creation_date,
         ts AS review_answer_timestamp
  FROM events
),
b_products_v1 AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, lower(p_type) AS product_category_name,
         CAST(length(p_name) AS BIGINT) AS product_name_length,
         CAST(length(p_brand) AS BIGINT) AS product_description_length,
         CAST(p_size % 5 AS BIGINT) AS product_photos_qty,
         CAST(p_size AS BIGINT) * 100 AS product_weight_g,
         CAST(p_size AS BIGINT) AS product_length_cm,
         CAST(p_size // 2 + 1 AS BIGINT) AS product_height_cm,
         CAST(p_size % 7 + 1 AS BIGINT) AS product_width_cm,
         p_partkey AS _pk
  FROM part
),
b_products_v2 AS (
  SELECT * EXCLUDE (_pk) REPLACE (
           CASE WHEN _pk % 5 = 0 THEN product_weight_g + 100 ELSE product_weight_g END
             AS product_weight_g)
  FROM b_products_v1
),
b_sellers AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, CAST(s_nationkey AS VARCHAR) AS seller_zip_code_prefix,
         s_name AS seller_city, n_name AS seller_state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
b_geolocation AS (
  SELECT CAST(s_nationkey AS VARCHAR) AS geolocation_zip_code_prefix,
         s_acctbal AS geolocation_lat, -s_acctbal AS geolocation_lng,
         s_name AS geolocation_city, n_name AS geolocation_state,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(s_suppkey % 7 AS INTEGER)) AS updated_at,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(s_suppkey AS BIGINT)) AS batched_at
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
b_category_translation AS (
  SELECT * FROM (VALUES ('economy', 'budget'), ('standard', 'standard_line'),
                        ('medium', 'mid_range'), ('large', 'large_goods'),
                        ('small', 'small_goods'))
         t(product_category_name, product_category_name_english)
  WHERE product_category_name IN (SELECT lower(split_part(p_type, ' ', 1)) FROM part)
),
b_review_texts AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS review_id,
         CAST(CASE WHEN l.quality = 1 THEN 5 WHEN l.quality = 0 THEN 1
                   ELSE d.doc_id % 5 + 1 END AS BIGINT) AS review_score,
         d.source AS title,
         d.text AS message
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
),
-- staging: one row per key; ties broken by the remaining columns -------------
s_customers AS (
  SELECT * FROM b_customers QUALIFY row_number() OVER (PARTITION BY customer_id
    ORDER BY customer_unique_id NULLS FIRST, customer_zip_code_prefix NULLS FIRST,
             customer_city NULLS FIRST, customer_state NULLS FIRST) = 1
),
s_orders AS (
  SELECT * FROM b_orders QUALIFY row_number() OVER (PARTITION BY order_id
    ORDER BY order_purchase_timestamp DESC NULLS LAST, customer_id DESC NULLS LAST,
             order_status DESC NULLS LAST, order_approved_at DESC NULLS LAST,
             order_delivered_carrier_date DESC NULLS LAST,
             order_delivered_customer_date DESC NULLS LAST,
             order_estimated_delivery_date DESC NULLS LAST) = 1
),
s_items AS (
  SELECT * FROM b_items QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id
    ORDER BY product_id NULLS FIRST, seller_id NULLS FIRST, shipping_limit_date NULLS FIRST,
             price NULLS FIRST, freight_value NULLS FIRST) = 1
),
s_payments AS (
  SELECT * FROM b_payments QUALIFY row_number() OVER (PARTITION BY order_id, payment_sequential
    ORDER BY payment_type NULLS FIRST, payment_installments NULLS FIRST,
             payment_value NULLS FIRST) = 1
),
s_reviews AS (
  SELECT * FROM b_reviews QUALIFY row_number() OVER (PARTITION BY review_id
    ORDER BY review_answer_timestamp DESC NULLS LAST, order_id DESC NULLS LAST,
             review_score DESC NULLS LAST, review_comment_title DESC NULLS LAST,
             review_comment_message DESC NULLS LAST, review_creation_date DESC NULLS LAST) = 1
),
s_sellers AS (
  SELECT * FROM b_sellers QUALIFY row_number() OVER (PARTITION BY seller_id
    ORDER BY seller_zip_code_prefix NULLS FIRST, seller_city NULLS FIRST,
             seller_state NULLS FIRST) = 1
),
s_geolocation AS (
  SELECT * FROM b_geolocation QUALIFY row_number() OVER (PARTITION BY geolocation_zip_code_prefix
    ORDER BY updated_at DESC NULLS LAST, batched_at DESC NULLS LAST,
             geolocation_lat DESC NULLS LAST, geolocation_lng DESC NULLS LAST,
             geolocation_city DESC NULLS LAST, geolocation_state DESC NULLS LAST) = 1
),
s_products AS (
  SELECT * FROM b_products_v2 QUALIFY row_number() OVER (PARTITION BY product_id
    ORDER BY product_category_name NULLS FIRST, product_name_length NULLS FIRST,
             product_description_length NULLS FIRST, product_photos_qty NULLS FIRST,
             product_length_cm NULLS FIRST, product_height_cm NULLS FIRST,
             product_width_cm NULLS FIRST, product_weight_g NULLS FIRST) = 1
),
-- fact_orders ----------------------------------------------------------------
f_o AS (
  SELECT trim(CAST(order_id AS VARCHAR)) AS order_id, trim(CAST(customer_id AS VARCHAR)) AS customer_id,
         lower(coalesce(order_status, 'unavailable')) AS order_status,
         order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
         order_delivered_customer_date, order_estimated_delivery_date
  FROM s_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL
),
f_i AS (
  SELECT trim(CAST(order_id AS VARCHAR)) AS order_id, order_item_id,
         trim(CAST(product_id AS VARCHAR)) AS product_id, trim(CAST(seller_id AS VARCHAR)) AS seller_id,
         shipping_limit_date, price, freight_value
  FROM s_items WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL
    AND seller_id IS NOT NULL AND product_id IS NOT NULL
),
f_pay AS (
  SELECT * FROM (SELECT trim(CAST(order_id AS VARCHAR)) AS order_id, payment_sequential,
                        payment_type, payment_installments, payment_value
                 FROM s_payments WHERE order_id IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY order_id
    ORDER BY (payment_sequential IS NULL), payment_sequential NULLS FIRST,
             payment_type NULLS FIRST, payment_installments NULLS FIRST,
             payment_value NULLS FIRST) = 1
),
f_lines AS (
  SELECT o.*, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date, i.price,
         i.freight_value
  FROM f_o o LEFT JOIN f_i i ON o.order_id = i.order_id
),
f_joined AS (
  SELECT l.order_id AS id, l.customer_id, l.order_status, l.order_purchase_timestamp,
         l.order_approved_at, l.order_delivered_carrier_date, l.order_delivered_customer_date,
         l.order_estimated_delivery_date, l.order_item_id, l.product_id, l.seller_id,
         l.shipping_limit_date,
         CASE WHEN l.price <= 0 THEN NULL ELSE l.price END AS price,
         CASE WHEN l.freight_value < 0 THEN NULL ELSE l.freight_value END AS freight_value,
         p.payment_sequential, lower(coalesce(p.payment_type, 'not_defined')) AS payment_type,
         p.payment_installments, p.payment_value
  FROM f_lines l LEFT JOIN f_pay p ON l.order_id = p.order_id
),
fact_orders AS (
  SELECT *,
    coalesce(order_delivered_customer_date < order_purchase_timestamp, false) AS has_invalid_delivery_date,
    (order_estimated_delivery_date IS NOT NULL
      AND coalesce(__AS_OF__ > order_estimated_delivery_date, false)
      AND order_delivered_customer_date IS NULL) AS is_overdue_delivery,
    coalesce(price > __HIGH_VALUE__, false) AS is_high_value_product,
    (order_delivered_customer_date IS NULL AND coalesce(order_status = 'delivered', false))
      AS has_missing_delivery_date,
    coalesce(CAST(trunc((epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp))
                        / 86400000000.0) AS BIGINT) > 30, false) AS is_long_delivery,
    (payment_type = 'not_defined' OR payment_value IS NULL) AS has_missing_payment_info,
    order_item_id IS NULL AS has_no_items
  FROM f_joined
),
-- dimensions -----------------------------------------------------------------
dim_customers AS (
  SELECT customer_id AS id, customer_unique_id, customer_zip_code_prefix, customer_city,
         customer_state
  FROM s_customers
),
dim_sellers AS (
  SELECT s.seller_id AS id, s.seller_zip_code_prefix, s.seller_city, s.seller_state,
         g.geolocation_lat, g.geolocation_lng, g.geolocation_city, g.geolocation_state
  FROM s_sellers s LEFT JOIN s_geolocation g
    ON s.seller_zip_code_prefix = g.geolocation_zip_code_prefix
),
rv_marked AS (
  SELECT *,
    (lag(1) OVER w) IS NULL AS _first,
    (order_id IS NOT DISTINCT FROM lag(order_id) OVER w
     AND review_score IS NOT DISTINCT FROM lag(review_score) OVER w
     AND review_comment_title IS NOT DISTINCT FROM lag(review_comment_title) OVER w
     AND review_comment_message IS NOT DISTINCT FROM lag(review_comment_message) OVER w
     AND review_creation_date IS NOT DISTINCT FROM lag(review_creation_date) OVER w
     AND review_answer_timestamp IS NOT DISTINCT FROM lag(review_answer_timestamp) OVER w) AS _same
  FROM b_reviews
  WINDOW w AS (PARTITION BY review_id ORDER BY review_answer_timestamp NULLS FIRST,
               order_id NULLS FIRST, review_score NULLS FIRST, review_comment_title NULLS FIRST,
               review_comment_message NULLS FIRST, review_creation_date NULLS FIRST)
),
reviews_history AS (
  SELECT * EXCLUDE (_first, _same), review_answer_timestamp AS valid_from,
    lead(review_answer_timestamp) OVER (PARTITION BY review_id
      ORDER BY review_answer_timestamp NULLS FIRST, order_id NULLS FIRST,
               review_score NULLS FIRST, review_comment_title NULLS FIRST,
               review_comment_message NULLS FIRST, review_creation_date NULLS FIRST) AS valid_to
  FROM rv_marked WHERE _first OR NOT _same
),
dim_reviews AS (
  SELECT md5(concat_ws('␟', coalesce(review_id, ''), coalesce(CAST(epoch_us(valid_from) AS VARCHAR), ''))) AS id,
         review_id, order_id, review_score, review_comment_title, review_comment_message,
         review_answer_timestamp, valid_from, valid_to, valid_to IS NULL AS is_current
  FROM reviews_history WHERE order_id IS NOT NULL
),
products_history AS (
  SELECT v1.* EXCLUDE (_pk), TIMESTAMP '2024-01-01 00:00:00' AS valid_from,
         CASE WHEN v1._pk % 5 = 0 THEN TIMESTAMP '2024-01-15 00:00:00' END AS valid_to
  FROM b_products_v1 v1
  UNION ALL
  SELECT v2.*, TIMESTAMP '2024-01-15 00:00:00' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to
  FROM b_products_v2 v2 WHERE CAST(product_id AS BIGINT) % 5 = 0
),
dim_products AS (
  SELECT md5(concat_ws('␟', product_id, CAST(epoch_us(valid_from) AS VARCHAR))) AS surrogate_key,
         p.product_id, t.product_category_name_english AS product_category,
         p.product_name_length, p.product_description_length, p.product_photos_qty,
         p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm,
         p.valid_from, p.valid_to, p.valid_to IS NULL AS is_current
  FROM products_history p LEFT JOIN b_category_translation t
    ON p.product_category_name = t.product_category_name
),
cur_review AS (
  SELECT order_id, max(review_score) AS review_score
  FROM dim_reviews WHERE is_current AND order_id IS NOT NULL GROUP BY order_id
),
-- order grain ----------------------------------------------------------------
ord AS (
  SELECT id AS order_id, max(customer_id) AS customer_id, max(order_status) AS order_status,
         max(order_purchase_timestamp) AS purchase_ts, max(order_approved_at) AS approved_ts,
         max(order_delivered_customer_date) AS delivered_ts,
         max(order_estimated_delivery_date) AS estimated_ts,
         CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS gmv,
         CAST(sum(CAST(freight_value AS DECIMAL(18,2))) AS DOUBLE) AS freight,
         count(*) AS n_items, max(payment_type) AS payment_type,
         max(payment_installments) AS payment_installments, max(payment_value) AS payment_value
  FROM fact_orders WHERE order_purchase_timestamp IS NOT NULL GROUP BY id
),
orders_o AS (
  SELECT o.order_id, o.order_status, o.purchase_ts,
         CAST(date_trunc('month', CAST(o.purchase_ts AS DATE)) AS DATE) AS order_month,
         o.approved_ts, o.delivered_ts, o.estimated_ts, o.gmv, o.freight, o.n_items,
         o.payment_type, o.payment_installments, o.payment_value,
         c.customer_unique_id, c.customer_state, r.review_score,
         CASE WHEN o.delivered_ts IS NOT NULL
              THEN CAST(date_diff('day', CAST(o.purchase_ts AS DATE), CAST(o.delivered_ts AS DATE)) AS BIGINT) END AS delivery_days,
         CASE WHEN o.delivered_ts IS NOT NULL AND o.estimated_ts IS NOT NULL
              THEN CAST(date_diff('day', CAST(o.estimated_ts AS DATE), CAST(o.delivered_ts AS DATE)) AS BIGINT) END AS days_vs_estimate
  FROM ord o LEFT JOIN dim_customers c ON o.customer_id = c.id
  LEFT JOIN cur_review r ON o.order_id = r.order_id
),
orders_e AS (
  SELECT *,
    coalesce(order_seq > 1, false) AS is_repeat_order,
    coalesce(order_seq < cust_total_orders, false) AS has_subsequent_order,
    coalesce(order_status = 'delivered', false) AS is_delivered,
    days_vs_estimate > 0 AS is_late,
    CASE WHEN days_vs_estimate IS NULL THEN NULL WHEN days_vs_estimate <= 0 THEN 'Early / on-time'
         WHEN days_vs_estimate <= 3 THEN '1-3 days late' WHEN days_vs_estimate <= 7 THEN '4-7 days late'
         ELSE '8+ days late' END AS delivery_bucket,
    CASE WHEN review_score IS NULL THEN NULL WHEN review_score <= 2 THEN '1-2 ★ (detractor)'
         WHEN review_score = 3 THEN '3 ★ (passive)' ELSE '4-5 ★ (promoter)' END AS review_bucket
  FROM (
    SELECT o.*,
      CASE WHEN customer_unique_id IS NOT NULL THEN CAST(row_number() OVER (
        PARTITION BY customer_unique_id ORDER BY purchase_ts NULLS FIRST, order_id NULLS FIRST) AS BIGINT) END AS order_seq,
      CASE WHEN customer_unique_id IS NOT NULL THEN CAST(count(*) OVER (PARTITION BY customer_unique_id) AS BIGINT) END AS cust_total_orders,
      CASE WHEN customer_unique_id IS NOT NULL THEN min(order_month) OVER (PARTITION BY customer_unique_id) END AS cohort_month
    FROM orders_o o)
),
category AS (
  SELECT CAST(date_trunc('month', CAST(f.order_purchase_timestamp AS DATE)) AS DATE) AS order_month,
         c.customer_state, coalesce(p.product_category, 'unknown') AS product_category,
         CAST(sum(CAST(f.price AS DECIMAL(18,2))) AS DOUBLE) AS gmv, count(*) AS n_items
  FROM fact_orders f
  LEFT JOIN (SELECT * FROM dim_products WHERE is_current) p ON f.product_id = p.product_id
  LEFT JOIN dim_customers c ON f.customer_id = c.id
  WHERE f.order_purchase_timestamp IS NOT NULL
  GROUP BY 1, 2, 3
),
_end_of_prelude AS (SELECT 1 AS x)
""".replace("__AS_OF__", AS_OF).replace("__HIGH_VALUE__", HIGH_VALUE)


def q(body: str) -> str:
    """Prelude + the query's own CTEs/SELECT (``body`` may start with ``, name AS (...)``)."""
    body = body.strip()
    if body.startswith(","):
        return PRELUDE.rstrip() + "\n" + body
    return PRELUDE.rstrip() + "\n" + body


ORACLE: dict[str, str] = {}


def register(name: str, body: str) -> None:
    ORACLE[name] = q(body)
