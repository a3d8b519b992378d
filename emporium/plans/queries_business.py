"""Registered queries: business SQL, notebook analyses, scalar expressions."""
from __future__ import annotations

from pyspark.sql import functions as F

from emporium.functions import expr as X
from emporium.operators import business as B
from emporium.operators import gold as G
from emporium.plans.catalog import query


def _wd(a: str, b: str) -> str:
    """DuckDB: whole 24 h days from a to b, truncated toward zero."""
    return f"CAST(trunc((epoch_us({b}) - epoch_us({a})) / 86400000000.0) AS BIGINT)"


def _money(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


def _avg_money(c: str) -> str:
    return f"({_money(c)} / nullif(count({c}), 0))"


CUR_PROD = "(SELECT product_id, product_category FROM dim_products WHERE is_current)"
DELIV = "(SELECT * FROM fact_orders WHERE order_status = 'delivered')"

query("a21_biz_monthly_revenue", f"""
SELECT CAST(date_trunc('month', CAST(order_purchase_timestamp AS DATE)) AS DATE) AS month,
  count(DISTINCT id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
  {_money('price')} AS gross_revenue, {_money('freight_value')} AS total_freight,
  {_money('price + freight_value')} AS total_revenue, {_avg_money('price')} AS avg_order_value
FROM {DELIV} f WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1
""")(lambda c: B.biz_monthly_revenue(c.fact))

query("a22_biz_sellers", f"""
SELECT f.seller_id, s.seller_state, s.seller_city, count(DISTINCT f.id) AS total_orders,
  {_money('f.price')} AS total_revenue, {_avg_money('f.price')} AS avg_order_value,
  avg(r.review_score) AS avg_review_score,
  count(*) FILTER (WHERE f.is_long_delivery) AS long_delivery_count,
  count(*) FILTER (WHERE f.has_invalid_delivery_date) AS invalid_delivery_count
FROM {DELIV} f LEFT JOIN dim_sellers s ON f.seller_id = s.id
LEFT JOIN cur_review r ON f.id = r.order_id
GROUP BY 1, 2, 3
""")(lambda c: B.biz_sellers(c.fact, c.gold.dim_sellers, c.gold.dim_reviews_current))

query("a23_biz_categories", f"""
SELECT p.product_category, count(DISTINCT f.id) AS total_orders,
  {_money('f.price')} AS total_revenue, {_avg_money('f.price')} AS avg_price,
  {_avg_money('f.freight_value')} AS avg_freight, avg(r.review_score) AS avg_review_score,
  count(*) FILTER (WHERE f.is_long_delivery) AS long_deliveries,
  round(avg(f.freight_value / nullif(f.price, 0)) * 100, 9) AS freight_pct_of_price
FROM {DELIV} f LEFT JOIN {CUR_PROD} p ON f.product_id = p.product_id
LEFT JOIN cur_review r ON f.id = r.order_id
GROUP BY 1
""")(lambda c: B.biz_categories(c.fact, c.gold.dim_products, c.gold.dim_reviews_current))

query("a24_biz_payments", f"""
SELECT payment_type, payment_installments, count(DISTINCT id) AS total_orders,
  {_money('price')} AS total_revenue, {_avg_money('price')} AS avg_order_value,
  {_avg_money('payment_value')} AS avg_payment_value
FROM {DELIV} f WHERE payment_type <> 'not_defined' GROUP BY 1, 2
""")(lambda c: B.biz_payments(c.fact))

query("a25_biz_sla", f"""
SELECT s.seller_state, count(DISTINCT f.id) AS total_orders,
  avg({_wd('f.order_purchase_timestamp', 'f.order_delivered_customer_date')}) AS avg_delivery_days,
  avg({_wd('f.order_delivered_customer_date', 'f.order_estimated_delivery_date')}) AS avg_days_vs_estimate,
  count(*) FILTER (WHERE f.is_long_delivery) AS long_deliveries,
  count(*) FILTER (WHERE f.is_overdue_delivery) AS overdue_deliveries,
  count(*) FILTER (WHERE f.is_overdue_delivery) / count(*) * 100 AS overdue_rate_pct
FROM {DELIV} f LEFT JOIN dim_sellers s ON f.seller_id = s.id
WHERE f.order_delivered_customer_date IS NOT NULL GROUP BY 1
""")(lambda c: B.biz_sla(c.fact, c.gold.dim_sellers))

_GEO = f"""
SELECT c.customer_state, count(DISTINCT {{who}}) AS unique_customers,
  count(DISTINCT f.id) AS total_orders, {_money('f.price')} AS total_revenue,
  {_avg_money('f.price')} AS avg_order_value, avg(r.review_score) AS avg_satisfaction,
  count(DISTINCT f.id) / nullif(count(DISTINCT {{who}}), 0) AS orders_per_customer
FROM {DELIV} f LEFT JOIN dim_customers c ON f.customer_id = c.id
LEFT JOIN cur_review r ON f.id = r.order_id GROUP BY 1
"""
query("a26_biz_geo", _GEO.format(who="c.customer_unique_id"))(
    lambda c: B.biz_geo(c.fact, c.gold.dim_customers, c.gold.dim_reviews_current))
query("a26_biz_geo_parity", _GEO.format(who="c.id"))(
    lambda c: B.biz_geo(c.fact, c.gold.dim_customers, c.gold.dim_reviews_current, "customer_id"))

query("a27_biz_reviews_by_category", f"""
SELECT p.product_category, r.review_score, count(DISTINCT f.id) AS total_orders,
  {_avg_money('f.price')} AS avg_price,
  avg({_wd('f.order_purchase_timestamp', 'f.order_delivered_customer_date')}) AS avg_delivery_days,
  {_avg_money('f.freight_value')} AS avg_freight
FROM fact_orders f LEFT JOIN {CUR_PROD} p ON f.product_id = p.product_id
JOIN cur_review r ON f.id = r.order_id GROUP BY 1, 2
""")(lambda c: B.biz_reviews_by_category(c.fact, c.gold.dim_products, c.gold.dim_reviews_current))

query("a28_repeat_customer_rate", """
, per AS (SELECT c.customer_unique_id, count(DISTINCT f.id) AS n
          FROM fact_orders f JOIN dim_customers c ON f.customer_id = c.id
          WHERE c.customer_unique_id IS NOT NULL GROUP BY 1)
SELECT count(*) AS customers, count(*) FILTER (WHERE n > 1) AS repeat_customers,
       count(*) FILTER (WHERE n > 1) / nullif(count(*), 0) AS repeat_customer_rate FROM per
""")(lambda c: B.repeat_customer_rate(c.fact, c.gold.dim_customers))

_OUT = """
, per AS (SELECT id, max(order_delivered_customer_date) AS dl, max(order_estimated_delivery_date) AS es
          FROM fact_orders GROUP BY 1),
g AS (SELECT CASE WHEN dl IS NULL THEN 'not delivered' {unknown}
                  WHEN dl <= es THEN 'on time' ELSE 'late' END AS delivery_outcome, count(*) AS orders
      FROM per GROUP BY 1)
SELECT delivery_outcome, orders,
  (SELECT sum(orders) FILTER (WHERE delivery_outcome = 'late')
          / nullif(sum(orders) FILTER (WHERE delivery_outcome IN ('late', 'on time')), 0) FROM g) AS late_rate
FROM g"""
query("a29_delivery_outcomes", _OUT.format(unknown="WHEN es IS NULL THEN 'unknown'"))(
    lambda c: B.delivery_outcomes(c.fact))
query("a29_delivery_outcomes_legacy", _OUT.format(unknown=""))(
    lambda c: B.delivery_outcomes(c.fact, legacy=True))

query("a30_review_scores", """
, g AS (SELECT review_score, count(*) AS reviews FROM dim_reviews
        WHERE is_current AND review_score IS NOT NULL GROUP BY 1)
SELECT review_score, reviews, reviews / sum(reviews) OVER () AS share,
  sum(review_score * reviews) OVER () / sum(reviews) OVER () AS avg_score,
  sum(reviews) FILTER (WHERE review_score <= 2) OVER () / sum(reviews) OVER () AS low_share
FROM g
""")(lambda c: B.review_scores(c.gold.dim_reviews_current))

query("a31_revenue_by_purchase_type", f"""
, ranked AS (
  SELECT r.*, CASE WHEN customer_unique_id IS NOT NULL THEN row_number() OVER (
           PARTITION BY customer_unique_id ORDER BY purchase_ts NULLS FIRST, id NULLS FIRST) END AS order_seq
  FROM (SELECT id, max(customer_id) AS customer_id, max(order_purchase_timestamp) AS purchase_ts,
               max(payment_value) AS order_payment FROM {DELIV} d GROUP BY 1) r
  LEFT JOIN (SELECT id AS cid, customer_unique_id FROM dim_customers) c ON r.customer_id = c.cid),
lines AS (
  SELECT CAST(date_trunc('month', CAST(f.order_purchase_timestamp AS DATE)) AS DATE) AS order_month,
    {_money('f.price')} AS total_gmv, {_money('f.payment_value')} AS total_revenue,
    CAST(coalesce(sum(CASE WHEN k.order_seq = 1 THEN CAST(f.price AS DECIMAL(18,2)) ELSE 0 END), 0) AS DOUBLE) AS gmv_first_purchase,
    CAST(coalesce(sum(CASE WHEN k.order_seq > 1 THEN CAST(f.price AS DECIMAL(18,2)) ELSE 0 END), 0) AS DOUBLE) AS gmv_repeat_purchase
  FROM {DELIV} f LEFT JOIN ranked k ON f.id = k.id GROUP BY 1),
once AS (SELECT CAST(date_trunc('month', CAST(purchase_ts AS DATE)) AS DATE) AS order_month,
                {_money('order_payment')} AS order_revenue FROM ranked GROUP BY 1)
SELECT l.*, o.order_revenue FROM lines l LEFT JOIN once o ON l.order_month = o.order_month
""")(lambda c: B.revenue_by_purchase_type(c.fact, c.gold.dim_customers))

query("a32_payment_mix", f"""
, g AS (SELECT payment_type, {_money('price')} AS total_gmv, count(DISTINCT id) AS order_count
        FROM fact_orders GROUP BY 1 HAVING payment_type <> 'not_defined')
SELECT *, total_gmv / sum(total_gmv) OVER () AS gmv_share FROM g
""")(lambda c: B.payment_mix(c.fact))

_CATREV = f"""
, catrev AS (SELECT coalesce(p.product_category, 'unknown') AS product_category,
       {_money('f.price')} AS total_revenue, count(DISTINCT f.id) AS total_orders
FROM fact_orders f LEFT JOIN {CUR_PROD} p ON f.product_id = p.product_id GROUP BY 1)
"""
query("a33_category_revenue", _CATREV + """
SELECT *, total_revenue / nullif(total_orders, 0) AS avg_order_value FROM catrev
""")(lambda c: B.category_revenue(c.fact, c.gold.dim_products))

query("a34_top_n_others", _CATREV + """
, top AS (SELECT product_category, total_revenue FROM catrev
          ORDER BY total_revenue DESC NULLS LAST, product_category LIMIT 3),
rest AS (SELECT 'Others' AS product_category, sum(total_revenue) AS total_revenue FROM catrev
         WHERE product_category NOT IN (SELECT product_category FROM top)),
u AS (SELECT * FROM top UNION ALL SELECT * FROM rest WHERE total_revenue IS NOT NULL)
SELECT product_category, total_revenue, total_revenue / sum(total_revenue) OVER () AS share,
  array_to_string(list_transform(string_split(replace(product_category, '_', ' '), ' '),
      lambda w: upper(w[1]) || lower(w[2:])), ' ') AS pretty_label
FROM u
""")(lambda c: B.top_n_others(B.category_revenue(c.fact, c.gold.dim_products)
                              .select("product_category", "total_revenue"),
                              "product_category", "total_revenue", 3))

query("a35_customer_mix", """
, per AS (SELECT c.customer_unique_id, count(DISTINCT f.id) AS total_orders
          FROM fact_orders f LEFT JOIN dim_customers c ON f.customer_id = c.id
          WHERE f.order_status = 'delivered' AND c.customer_unique_id IS NOT NULL GROUP BY 1),
g AS (SELECT CASE WHEN total_orders = 1 THEN 'First-Time Customer' ELSE 'Repeat Customer' END AS customer_type,
             count(*) AS total_customers FROM per GROUP BY 1)
SELECT *, total_customers / sum(total_customers) OVER () AS share,
       total_customers / sum(total_customers) OVER () * 100 AS percentage FROM g
""")(lambda c: B.customer_mix(c.fact, c.gold.dim_customers))

query("a36_state_profile", f"""
SELECT customer_state, {_money('gmv')} AS revenue, count(*) AS order_volume,
  avg(delivery_days) AS avg_delivery_days,
  count(*) FILTER (WHERE is_late) / nullif(count(is_late), 0) * 100 AS late_pct,
  {_money('freight')} / nullif({_money('gmv')}, 0) * 100 AS freight_pct
FROM orders_e GROUP BY 1
""")(lambda c: B.state_profile(c.enriched))

query("a37_ops_summary", f"""
, r AS (SELECT CAST(count(*) AS DOUBLE) AS total_orders,
          CAST(count(*) FILTER (WHERE is_delivered) AS DOUBLE) AS delivered_orders,
          avg(delivery_days) AS avg_delivery_days,
          count(*) FILTER (WHERE days_vs_estimate <= 0) / nullif(count(days_vs_estimate), 0) AS on_time_rate,
          count(*) FILTER (WHERE is_late) / nullif(count(is_late), 0) AS late_rate,
          round(avg((epoch_us(approved_ts) - epoch_us(purchase_ts)) / 3600000000.0), 9) AS avg_approval_hours,
          {_money('freight')} / nullif({_money('gmv')}, 0) * 100 AS freight_pct
        FROM orders_e)
SELECT metric, value FROM r UNPIVOT INCLUDE NULLS (value FOR metric IN (total_orders,
  delivered_orders, avg_delivery_days, on_time_rate, late_rate, avg_approval_hours, freight_pct))
""")(lambda c: B.ops_summary(c.enriched))

query("a38_status_counts", "SELECT order_status, count(*) AS orders FROM orders_e GROUP BY 1")(
    lambda c: B.status_counts(c.enriched))

CORR_COLS = ["gmv", "freight", "n_items", "payment_installments", "review_score",
             "delivery_days", "days_vs_estimate", "payment_value"]
def _corr_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
        f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 9) AS corr FROM orders_e"
        for a in CORR_COLS for b in CORR_COLS)


query("a39_corr_matrix", _corr_sql())(lambda c: B.corr_matrix(c.enriched, CORR_COLS))

query("a40_histogram", """
SELECT bin, count(*) AS count, CAST(0.0 + bin * 3.0 AS DOUBLE) AS bin_lo,
       CAST(0.0 + (bin + 1) * 3.0 AS DOUBLE) AS bin_hi
FROM (SELECT CAST(least(floor((greatest(least(CAST(delivery_days AS DOUBLE), 60.0), 0.0) - 0.0)
                              * 20.0 / 60.0), 19) AS BIGINT) AS bin
      FROM orders_e WHERE delivery_days IS NOT NULL) GROUP BY 1
""")(lambda c: B.histogram(c.enriched, "delivery_days", 20, 0.0, 60.0))

_SQRT2PI = repr((2 * 3.141592653589793) ** 0.5)
query("a41_kde", f"""
, h AS (SELECT bin, count(*) AS cnt FROM (
          SELECT CAST(least(floor((greatest(least(CAST(delivery_days AS DOUBLE), 60.0), 0.0) - 0.0)
                                  * 60.0 / 60.0), 59) AS BIGINT) AS bin
          FROM orders_e WHERE delivery_days IS NOT NULL) GROUP BY 1),
hc AS (SELECT cnt, CAST(((0.0 + bin * 1.0) + (0.0 + (bin + 1) * 1.0)) / 2 AS DOUBLE) AS center FROM h),
n AS (SELECT sum(cnt) AS n FROM h),
g AS (SELECT range AS gi, CAST(0.0 + range * 1.0 AS DOUBLE) AS x FROM range(0, 61)),
s AS (SELECT g.gi, g.x, sum(hc.cnt * exp(-0.5 * ((g.x - hc.center) / 2.0) * ((g.x - hc.center) / 2.0))
                            / {_SQRT2PI}) AS s
      FROM g, hc GROUP BY 1, 2)
SELECT s.x, round(s.s / (n.n * 2.0), 9) AS density FROM s, n
""")(lambda c: B.kde(c.enriched, "delivery_days", 2.0, 0.0, 60.0, 61, 60))

query("a42_box_stats", """
, q AS (SELECT customer_state, quantile_cont(CAST(delivery_days AS DOUBLE), 0.25) AS q1,
               quantile_cont(CAST(delivery_days AS DOUBLE), 0.5) AS median,
               quantile_cont(CAST(delivery_days AS DOUBLE), 0.75) AS q3, count(*) AS n
        FROM orders_e WHERE delivery_days IS NOT NULL GROUP BY 1)
SELECT q.*, q3 - q1 AS iqr,
  min(delivery_days) FILTER (WHERE delivery_days >= q1 - 1.5 * (q3 - q1)) AS whisker_lo,
  max(delivery_days) FILTER (WHERE delivery_days <= q3 + 1.5 * (q3 - q1)) AS whisker_hi,
  count(*) FILTER (WHERE delivery_days < q1 - 1.5 * (q3 - q1) OR delivery_days > q3 + 1.5 * (q3 - q1)) AS outliers
FROM q JOIN orders_e o ON o.customer_state = q.customer_state AND o.delivery_days IS NOT NULL
GROUP BY ALL
""".replace("min(delivery_days) FILTER", "CAST(min(delivery_days) FILTER").replace(
    "AS whisker_lo", "AS DOUBLE) AS whisker_lo").replace(
    "max(delivery_days) FILTER", "CAST(max(delivery_days) FILTER").replace(
    "AS whisker_hi", "AS DOUBLE) AS whisker_hi"))(
    lambda c: B.box_stats(c.enriched, "customer_state", "delivery_days"))

query("a43_review_delay_curve", """
, pts AS (SELECT days_vs_estimate AS day, avg(review_score) AS avg_review, count(*) AS orders
          FROM orders_e WHERE review_score IS NOT NULL AND days_vs_estimate BETWEEN -30 AND 30
          GROUP BY 1),
s AS (SELECT CAST(count(*) AS DOUBLE) AS s0, sum(CAST(day AS DOUBLE)) AS s1,
             sum(CAST(day AS DOUBLE) * day) AS s2, sum(CAST(day AS DOUBLE) * day * day) AS s3,
             sum(CAST(day AS DOUBLE) * day * day * day) AS s4, sum(avg_review) AS t0,
             sum(CAST(day AS DOUBLE) * avg_review) AS t1,
             sum(CAST(day AS DOUBLE) * day * avg_review) AS t2 FROM pts),
co AS (SELECT CASE WHEN ((s0)*((s2)*(s4)-(s3)*(s3)) - (s1)*((s1)*(s4)-(s3)*(s2)) + (s2)*((s1)*(s3)-(s2)*(s2))) <> 0 THEN ((t0)*((s2)*(s4)-(s3)*(s3)) - (s1)*((t1)*(s4)-(s3)*(t2)) + (s2)*((t1)*(s3)-(s2)*(t2))) / ((s0)*((s2)*(s4)-(s3)*(s3)) - (s1)*((s1)*(s4)-(s3)*(s2)) + (s2)*((s1)*(s3)-(s2)*(s2))) END AS c0,
              CASE WHEN ((s0)*((s2)*(s4)-(s3)*(s3)) - (s1)*((s1)*(s4)-(s3)*(s2)) + (s2)*((s1)*(s3)-(s2)*(s2))) <> 0 THEN ((s0)*((t1)*(s4)-(s3)*(t2)) - (t0)*((s1)*(s4)-(s3)*(s2)) + (s2)*((s1)*(t2)-(t1)*(s2))) / ((s0)*((s2)*(s4)-(s3)*(s3)) - (s1)*((s1)*(s4)-(s3)*(s2)) + (s2)*((s1)*(s3)-(s2)*(s2))) END AS c1,
              CASE WHEN ((s0)*((s2)*(s4)-(s3)*(s3)) - (s1)*((s1)*(s4)-(s3)*(s2)) + (s2)*((s1)*(s3)-(s2)*(s2))) <> 0 THEN ((s0)*((s2)*(t2)-(t1)*(s3)) - (s1)*((s1)*(t2)-(t1)*(s2)) + (t0)*((s1)*(s3)-(s2)*(s2))) / ((s0)*((s2)*(s4)-(s3)*(s3)) - (s1)*((s1)*(s4)-(s3)*(s2)) + (s2)*((s1)*(s3)-(s2)*(s2))) END AS c2 FROM s)
SELECT day, avg_review, orders,
       round(c0 + c1 * CAST(day AS DOUBLE) + c2 * CAST(day AS DOUBLE) * CAST(day AS DOUBLE), 6) AS fitted
FROM pts, co
""")(lambda c: B.review_delay_curve(c.enriched))

query("k1_ordered_report", """
SELECT CAST(date_trunc('month', CAST(order_purchase_timestamp AS DATE)) AS DATE) AS month,
       count(DISTINCT id) AS total_orders
FROM fact_orders WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL
GROUP BY 1 ORDER BY 1
""")(lambda c: B.biz_monthly_revenue(c.fact).select("month", "total_orders").orderBy("month"))

query("k4_head_sample", """
SELECT review_id, review_score, title, message FROM b_review_texts
WHERE trim(coalesce(message, '')) <> '' ORDER BY review_id LIMIT 30
""")(lambda c: c.review_texts.filter(F.trim(F.coalesce("message", F.lit(""))) != "")
     .select("review_id", "review_score", "title", "message").orderBy("review_id").limit(30))


def _base(c):
    return B.delivered_base(c.fact, c.src.order_reviews, c.gold.dim_customers)


_BASE = """
, base AS (
  SELECT f.*, br.review_score, c.customer_unique_id,
    CAST(date_diff('day', CAST(f.order_estimated_delivery_date AS DATE),
                   CAST(f.order_delivered_customer_date AS DATE)) AS BIGINT) AS delivery_delay_days
  FROM (SELECT DISTINCT id AS order_id, customer_id, order_status, order_purchase_timestamp,
               order_delivered_customer_date, order_estimated_delivery_date
        FROM fact_orders WHERE order_status = 'delivered'
          AND order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL
          AND NOT has_invalid_delivery_date AND NOT has_missing_delivery_date) f
  LEFT JOIN (SELECT order_id, max(review_score) AS review_score FROM b_reviews GROUP BY 1) br
    ON f.order_id = br.order_id
  LEFT JOIN (SELECT id, customer_unique_id FROM dim_customers) c ON f.customer_id = c.id)
"""
query("a48_delivered_base", _BASE + "SELECT * FROM base")(_base)
query("a44_review_by_delay_bucket", _BASE + """
SELECT CASE WHEN delivery_delay_days IS NULL THEN NULL
            WHEN delivery_delay_days < -7 THEN '1. Very Early (>7d)'
            WHEN delivery_delay_days < 0 THEN '2. Early (1-7d)'
            WHEN delivery_delay_days = 0 THEN '3. On Time'
            WHEN delivery_delay_days <= 3 THEN '4. Slightly Late (1-3d)'
            WHEN delivery_delay_days <= 7 THEN '5. Late (4-7d)'
            ELSE '6. Very Late (7d+)' END AS delay_bucket,
       avg(review_score) AS avg_review, count(*) AS orders
FROM base WHERE review_score IS NOT NULL GROUP BY 1
""")(lambda c: B.review_by_delay_bucket(_base(c)))
query("a45_repeat_by_review", _BASE + """
, per AS (SELECT customer_unique_id, avg(review_score) AS avg_score, count(DISTINCT order_id) AS n_orders
          FROM base WHERE customer_unique_id IS NOT NULL GROUP BY 1)
SELECT CAST(round_even(avg_score, 0) AS BIGINT) AS score_class, count(*) AS customers,
       count(*) FILTER (WHERE n_orders > 1) AS repeaters,
       count(*) FILTER (WHERE n_orders > 1) / count(*) AS repeat_rate
FROM per WHERE avg_score IS NOT NULL GROUP BY 1
""")(lambda c: B.repeat_by_review(_base(c)))
query("a46_low_score_by_lateness", _BASE + """
SELECT delivery_delay_days > 0 AS is_late, count(*) AS orders,
       count(*) FILTER (WHERE review_score <= 2) AS low_scores,
       count(*) FILTER (WHERE review_score <= 2) / count(*) AS low_share
FROM base WHERE review_score IS NOT NULL GROUP BY 1
""")(lambda c: B.low_score_by_lateness(_base(c)))
query("a47_geo_quality", _BASE + """
SELECT c.customer_state, avg(b.review_score) AS avg_review, avg(b.delivery_delay_days) AS avg_delay_days,
       count(*) AS orders
FROM base b LEFT JOIN dim_customers c ON b.customer_id = c.id GROUP BY 1
""")(lambda c: B.geo_quality(_base(c), c.gold.dim_customers))

query("a50_sample_pairs", """
SELECT order_id, gmv, freight FROM orders_e WHERE order_id IS NOT NULL
ORDER BY md5(CAST(order_id AS VARCHAR) || ':42'), order_id LIMIT 200
""")(
    lambda c: B.sample_pairs(c.enriched, ["gmv", "freight"], 200, seed=42))

query("j5_orders_customers_inner", """
SELECT o.id AS order_id, c.customer_unique_id, c.customer_state
FROM (SELECT DISTINCT id, customer_id FROM fact_orders) o JOIN dim_customers c ON o.customer_id = c.id
""")(lambda c: c.fact.select("id", "customer_id").distinct()
     .join(c.gold.dim_customers.select(F.col("id").alias("customer_id"), "customer_unique_id",
                                       "customer_state"), "customer_id", "inner")
     .select(F.col("id").alias("order_id"), "customer_unique_id", "customer_state"))


@query("p_scalar_expressions", f"""
SELECT order_id,
  CAST(date_diff('day', CAST(purchase_ts AS DATE), CAST(delivered_ts AS DATE)) AS BIGINT) AS days_calendar,
  {_wd('purchase_ts', 'delivered_ts')} AS days_whole,
  CAST(floor((epoch_us(delivered_ts) - epoch_us(purchase_ts)) / 86400000000.0) AS BIGINT) AS days_floor,
  {_wd('delivered_ts', 'purchase_ts')} AS days_whole_neg,
  CAST(floor((epoch_us(purchase_ts) - epoch_us(delivered_ts) - 43200000000) / 86400000000.0) AS BIGINT) AS days_floor_neg,
  (epoch_us(approved_ts) - epoch_us(purchase_ts)) / 3600000000.0 AS approval_hours,
  CAST((year(order_month) - year(cohort_month)) * 12 + month(order_month) - month(cohort_month) AS BIGINT) AS months_since,
  delivery_bucket, review_bucket,
  CASE WHEN days_vs_estimate IS NULL THEN NULL
       WHEN days_vs_estimate < -7 THEN '1. Very Early (>7d)' WHEN days_vs_estimate < 0 THEN '2. Early (1-7d)'
       WHEN days_vs_estimate = 0 THEN '3. On Time' WHEN days_vs_estimate <= 3 THEN '4. Slightly Late (1-3d)'
       WHEN days_vs_estimate <= 7 THEN '5. Late (4-7d)' ELSE '6. Very Late (7d+)' END AS delay_bucket6,
  CASE WHEN delivered_ts IS NULL THEN 'not delivered' WHEN estimated_ts IS NULL THEN 'unknown'
       WHEN delivered_ts <= estimated_ts THEN 'on time' ELSE 'late' END AS outcome,
  freight / nullif(gmv, 0) AS freight_ratio,
  freight * 100.0 / nullif(gmv, 0) AS freight_pct,
  greatest(least(CAST(days_vs_estimate AS DOUBLE), 30.0), -30.0) AS clipped_delay,
  days_vs_estimate > 0 AS is_late,
  upper(substr(replace(payment_type, '_', ' '), 1, 1)) || lower(substr(replace(payment_type, '_', ' '), 2)) AS pretty_payment,
  round_even(gmv / 1000.0, 0) AS gmv_k_even,
  CASE WHEN trim(coalesce(payment_type, '')) = '' THEN NULL ELSE trim(payment_type) END AS blank_null,
  lower(coalesce(CASE WHEN order_id LIKE '%7' THEN NULL ELSE order_status END, 'unavailable')) AS std_status,
  CASE WHEN gmv <= 0 THEN NULL ELSE gmv END AS positive_gmv
FROM orders_e
""")
def p_scalar_expressions(c):
    """P18–P24, P27–P32, P6, P8, P9 over the order grain."""
    o = c.enriched
    shifted = F.timestamp_add("HOUR", F.lit(-12), F.col("purchase_ts"))
    return o.select(
        "order_id",
        X.days_between("purchase_ts", "delivered_ts", "calendar").alias("days_calendar"),
        X.days_between("purchase_ts", "delivered_ts", "whole").alias("days_whole"),
        X.days_between("purchase_ts", "delivered_ts", "floor").alias("days_floor"),
        X.days_between("delivered_ts", "purchase_ts", "whole").alias("days_whole_neg"),
        X.days_between("delivered_ts", shifted, "floor").alias("days_floor_neg"),
        X.hours_between("purchase_ts", "approved_ts").alias("approval_hours"),
        X.months_since("order_month", "cohort_month").alias("months_since"),
        X.delivery_bucket("days_vs_estimate").alias("delivery_bucket"),
        X.review_bucket("review_score").alias("review_bucket"),
        X.delay_bucket6("days_vs_estimate").alias("delay_bucket6"),
        X.delivery_outcome("delivered_ts", "estimated_ts").alias("outcome"),
        X.safe_div("freight", "gmv").alias("freight_ratio"),
        X.freight_pct("freight", "gmv").alias("freight_pct"),
        X.clip(F.col("days_vs_estimate").cast("double"), -30.0, 30.0).alias("clipped_delay"),
        X.is_late("days_vs_estimate").alias("is_late"),
        F.concat(F.upper(F.substring(F.regexp_replace("payment_type", "_", " "), 1, 1)),
                 F.lower(F.expr("substring(regexp_replace(payment_type, '_', ' '), 2)")))
        .alias("pretty_payment"),
        X.bround(F.col("gmv") / 1000.0).alias("gmv_k_even"),
        X.blank_to_null("payment_type").alias("blank_null"),
        X.std_enum(F.when(~F.col("order_id").endswith("7"), F.col("order_status")),
                   "unavailable").alias("std_status"),
        X.null_if("gmv", F.col("gmv") <= 0).alias("positive_gmv"))


query("p31_pretty_labels", """
SELECT product_category,
  array_to_string(list_transform(string_split(replace(product_category, '_', ' '), ' '),
      lambda w: upper(w[1]) || lower(w[2:])), ' ') AS pretty
FROM (SELECT DISTINCT product_category FROM category)
""")(lambda c: c.category.select("product_category").distinct()
     .select("product_category", X.pretty("product_category").alias("pretty")))


@query("j4_star_join", f"""
SELECT f.id, f.order_item_id, c.customer_unique_id, c.customer_state, r.review_score,
       coalesce(p.product_category, 'unknown') AS product_category
FROM fact_orders f LEFT JOIN dim_customers c ON f.customer_id = c.id
LEFT JOIN cur_review r ON f.id = r.order_id
LEFT JOIN {CUR_PROD} p ON f.product_id = p.product_id
""")
def j4_star_join(c):
    g = c.gold
    cust = g.dim_customers.select(F.col("id").alias("customer_id"), "customer_unique_id",
                                  "customer_state")
    rev = G.current_review_per_order(g.dim_reviews_current).withColumnRenamed("order_id", "id")
    prod = G.current(g.dim_products).select("product_id", "product_category")
    return (c.fact.join(cust, "customer_id", "left").join(rev, "id", "left")
            .join(prod, "product_id", "left")
            .select("id", "order_item_id", "customer_unique_id", "customer_state", "review_score",
                    F.coalesce("product_category", F.lit("unknown")).alias("product_category")))
