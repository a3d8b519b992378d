"""Registered queries: dashboard metrics."""
from __future__ import annotations

from pyspark.sql import functions as F

from emporium.functions import expr as X
from emporium.operators import metrics as M
from emporium.plans.catalog import query
from emporium.sources import binding

# Fixed dashboard filter used by the "filtered" variants.
F_START, F_END = "1996-01-01", "2000-12-01"
F_STATES = ["NATION_1", "NATION_3", "NATION_7", "NATION_12", "NATION_20"]
_STATES_SQL = ", ".join(f"'{s}'" for s in F_STATES)
FILTERED = (f", orders_f AS (SELECT * FROM orders_e WHERE order_month >= DATE '{F_START}' "
            f"AND order_month <= DATE '{F_END}' AND customer_state IN ({_STATES_SQL}))")


def _of(c):
    return X.apply_filters(c.enriched, F_START, F_END, F_STATES)


def _kpis_sql(rel: str) -> str:
    return f"""
SELECT coalesce(CAST(sum(CAST(gmv AS DECIMAL(18,2))) AS DOUBLE), 0.0) AS gmv,
  count(*) AS orders,
  count(DISTINCT customer_unique_id) AS customers,
  coalesce(CAST(sum(CAST(gmv AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(*), 0), 0.0) AS aov,
  coalesce((SELECT count(*) FROM (SELECT customer_unique_id FROM {rel}
            WHERE customer_unique_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1))
           / nullif(count(DISTINCT customer_unique_id), 0), 0.0) AS repeat_rate,
  count(*) FILTER (WHERE is_delivered AND days_vs_estimate <= 0)
    / nullif(count(*) FILTER (WHERE is_delivered AND days_vs_estimate IS NOT NULL), 0) AS on_time_rate,
  avg(review_score) AS avg_review,
  avg(delivery_days) AS avg_lead_days,
  count(DISTINCT order_month) AS n_months
FROM {rel}"""


def _gmv_monthly_sql(rel: str) -> str:
    return f"""
SELECT order_month,
  CAST(coalesce(sum(CAST(gmv AS DECIMAL(18,2))) FILTER (WHERE NOT is_repeat_order), 0) AS DOUBLE) AS new_gmv,
  CAST(coalesce(sum(CAST(gmv AS DECIMAL(18,2))) FILTER (WHERE is_repeat_order), 0) AS DOUBLE) AS repeat_gmv,
  CAST(coalesce(sum(CAST(gmv AS DECIMAL(18,2))) FILTER (WHERE NOT is_repeat_order), 0)
       + coalesce(sum(CAST(gmv AS DECIMAL(18,2))) FILTER (WHERE is_repeat_order), 0) AS DOUBLE) AS total_gmv,
  count(*) AS orders
FROM {rel} GROUP BY 1"""


query("a2_kpis", _kpis_sql("orders_e"))(lambda c: M.kpis(c.enriched))
query("a2_kpis_filtered", FILTERED + _kpis_sql("orders_f"))(lambda c: M.kpis(_of(c)))
query("a3_gmv_monthly", _gmv_monthly_sql("orders_e"))(lambda c: M.gmv_monthly(c.enriched))
query("a3_gmv_monthly_filtered", FILTERED + _gmv_monthly_sql("orders_f"))(
    lambda c: M.gmv_monthly(_of(c)))
query("p25_apply_filters", FILTERED + " SELECT * FROM orders_f")(_of)
query("p26_month_bounds", "SELECT min(order_month) AS min_month, max(order_month) AS max_month "
      "FROM orders_e")(lambda c: X.month_bounds(c.enriched))
query("p26_states", "SELECT DISTINCT customer_state AS state FROM orders_e "
      "WHERE customer_state IS NOT NULL")(lambda c: X.states(c.enriched))

query("a4_repeat_rate_monthly", """
SELECT order_month, count(*) AS orders, count(*) FILTER (WHERE is_repeat_order) AS repeat_orders,
       count(*) FILTER (WHERE is_repeat_order) / count(*) AS repeat_order_share
FROM orders_e GROUP BY 1""")(lambda c: M.repeat_rate_monthly(c.enriched))

_COHORT = """
, d AS (SELECT DISTINCT cohort_month,
          CAST((year(order_month) - year(cohort_month)) * 12 + month(order_month) - month(cohort_month) AS BIGINT) AS months_since,
          customer_unique_id
        FROM orders_e WHERE cohort_month IS NOT NULL AND order_month IS NOT NULL
          AND customer_unique_id IS NOT NULL),
act AS (SELECT cohort_month, months_since, count(*) AS customers FROM d GROUP BY 1, 2),
ret AS (SELECT a.cohort_month, a.months_since, a.customers, s.customers AS cohort_size,
               a.customers / s.customers AS retention
        FROM act a JOIN act s ON a.cohort_month = s.cohort_month AND s.months_since = 0)
"""
query("a5_cohort_retention", _COHORT + "SELECT * FROM ret")(
    lambda c: M.cohort_retention(c.enriched))
query("a5_cohort_matrix", _COHORT + "SELECT cohort_month, "
      + ", ".join(f"max(retention) FILTER (WHERE months_since = {i}) AS m{i}" for i in range(12))
      + " FROM ret WHERE months_since <= 11 GROUP BY 1")(lambda c: M.cohort_matrix(c.enriched))

query("a6_orders_per_customer", """
, per AS (SELECT customer_unique_id, count(*) AS n FROM orders_e
          WHERE customer_unique_id IS NOT NULL GROUP BY 1)
SELECT CAST(least(n, 5) AS BIGINT) AS orders_placed, count(*) AS customers,
       CASE WHEN least(n, 5) >= 5 THEN '5+' ELSE CAST(least(n, 5) AS VARCHAR) END AS label
FROM per GROUP BY 1, 3""")(lambda c: M.orders_per_customer(c.enriched))

_RFM = """
, snap AS (SELECT max(purchase_ts) AS s FROM orders_e),
per AS (SELECT customer_unique_id, max(purchase_ts) AS last_ts, count(*) AS frequency,
               coalesce(sum(CAST(gmv AS DECIMAL(18,2))), 0) AS monetary_d
        FROM orders_e WHERE customer_unique_id IS NOT NULL GROUP BY 1),
seg AS (SELECT *, CASE WHEN frequency >= 2 AND recency <= 120 THEN 'Champions / Loyal'
                       WHEN frequency >= 2 THEN 'Lapsing repeat'
                       WHEN recency <= 90 THEN 'New / recent (one-off)'
                       WHEN recency <= 240 THEN 'Cooling one-off' ELSE 'Dormant one-off' END AS segment
        FROM (SELECT per.*, CAST(floor((epoch_us(snap.s) - epoch_us(last_ts)) / 86400000000.0) AS BIGINT) AS recency
              FROM per, snap))
"""
query("a7_rfm", _RFM + """
, g AS (SELECT segment, count(*) AS customers, CAST(sum(monetary_d) AS DOUBLE) AS monetary
        FROM seg GROUP BY 1)
SELECT segment, customers, monetary, customers / sum(customers) OVER () AS share FROM g
""")(lambda c: M.rfm(c.enriched))
query("a7_rfm_people", _RFM + """
SELECT customer_unique_id, recency, frequency, CAST(monetary_d AS DOUBLE) AS monetary_d, segment FROM seg
""")(lambda c: M.rfm_people(c.enriched).withColumn("monetary_d", F.col("monetary_d").cast("double")))



_RFM2 = """
, f AS (SELECT f.*, c.customer_unique_id FROM fact_orders f
        LEFT JOIN dim_customers c ON f.customer_id = c.id WHERE f.order_status = 'delivered')
SELECT {key} AS customer,
  CAST(date_diff('day', max(CAST(order_purchase_timestamp AS DATE)), DATE '2001-08-01') AS BIGINT) AS recency_days,
  count(DISTINCT id) AS frequency,
  CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS monetary,
  CASE WHEN CAST(date_diff('day', max(CAST(order_purchase_timestamp AS DATE)), DATE '2001-08-01') AS BIGINT) <= 90
            AND count(DISTINCT id) >= 3 AND CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) >= 500 THEN 'Champion'
       WHEN date_diff('day', max(CAST(order_purchase_timestamp AS DATE)), DATE '2001-08-01') <= 180
            AND count(DISTINCT id) >= 2 THEN 'Loyal'
       WHEN date_diff('day', max(CAST(order_purchase_timestamp AS DATE)), DATE '2001-08-01') <= 90 THEN 'Recent'
       WHEN date_diff('day', max(CAST(order_purchase_timestamp AS DATE)), DATE '2001-08-01') > 365 THEN 'Churned'
       ELSE 'At Risk' END AS customer_segment
FROM f GROUP BY 1"""
query("a8_rfm_customers", _RFM2.format(key="customer_unique_id"))(
    lambda c: M.rfm_customers(c.fact, c.gold.dim_customers, binding.AS_OF_ORDERS))
query("a8_rfm_customers_parity", _RFM2.format(key="customer_id"))(
    lambda c: M.rfm_customers(c.fact, c.gold.dim_customers, binding.AS_OF_ORDERS, "customer_id"))

query("a9_lead_times", """
SELECT order_id, delivery_days FROM orders_e WHERE delivery_days IS NOT NULL AND delivery_days >= 0
""")(lambda c: M.lead_times(c.enriched))

_LATE = """
SELECT {g}, count(*) AS orders, count(*) FILTER (WHERE is_late) AS late,
       count(*) FILTER (WHERE is_late) / count(*) AS late_rate
FROM orders_e WHERE is_delivered AND days_vs_estimate IS NOT NULL GROUP BY 1"""
query("a10_ontime_by_state", _LATE.format(g="customer_state"))(
    lambda c: M.ontime_by_state(c.enriched))
query("a13_late_rate_monthly", _LATE.format(g="order_month"))(
    lambda c: M.late_rate_monthly(c.enriched))
query("a11_review_distribution", """
SELECT review_score, count(*) AS orders FROM orders_e WHERE review_score IS NOT NULL GROUP BY 1
""")(lambda c: M.review_distribution(c.enriched))


def _ordinal_sql(col: str, labels: list[str]) -> str:
    whens = " ".join(f"WHEN '{lab}' THEN {i}" for i, lab in enumerate(labels))
    return f"CAST(CASE {col} {whens} END AS BIGINT)"


query("a12_review_by_delivery_bucket", f"""
SELECT delivery_bucket, avg(review_score) AS avg_review, count(*) AS orders,
       {_ordinal_sql('delivery_bucket', X.DELIVERY_BUCKETS)} AS bucket_order
FROM orders_e WHERE delivery_bucket IS NOT NULL AND review_score IS NOT NULL GROUP BY 1
""")(lambda c: M.review_by_delivery_bucket(c.enriched))
query("a14_reorder_by_review_bucket", f"""
SELECT review_bucket, avg(CAST(has_subsequent_order AS DOUBLE)) AS reorder_rate, count(*) AS orders,
       {_ordinal_sql('review_bucket', X.REVIEW_BUCKETS)} AS bucket_order
FROM orders_e WHERE review_bucket IS NOT NULL GROUP BY 1
""")(lambda c: M.reorder_by_review_bucket(c.enriched))
query("a15_reorder_by_delivery_bucket", f"""
SELECT delivery_bucket, avg(CAST(has_subsequent_order AS DOUBLE)) AS reorder_rate, count(*) AS orders,
       {_ordinal_sql('delivery_bucket', X.DELIVERY_BUCKETS)} AS bucket_order
FROM orders_e WHERE delivery_bucket IS NOT NULL GROUP BY 1
""")(lambda c: M.reorder_by_delivery_bucket(c.enriched))
query("a16_acquisition_treadmill", """
SELECT order_month,
       count(DISTINCT customer_unique_id) FILTER (WHERE NOT is_repeat_order) AS "new",
       count(DISTINCT customer_unique_id) FILTER (WHERE is_repeat_order) AS "repeat"
FROM orders_e WHERE customer_unique_id IS NOT NULL GROUP BY 1
""")(lambda c: M.acquisition_treadmill(c.enriched))

query("a18_top_categories", f"""
SELECT product_category, CAST(sum(CAST(gmv AS DECIMAL(18,2))) AS DOUBLE) AS gmv,
       CAST(sum(n_items) AS BIGINT) AS items
FROM category WHERE order_month >= DATE '{F_START}' AND order_month <= DATE '{F_END}'
  AND customer_state IN ({_STATES_SQL})
GROUP BY 1 ORDER BY gmv DESC NULLS LAST, product_category LIMIT 12
""")(lambda c: M.top_categories(c.category, F_START, F_END, F_STATES, 12))
query("a18_top_categories_k2", """
SELECT product_category, CAST(sum(CAST(gmv AS DECIMAL(18,2))) AS DOUBLE) AS gmv,
       CAST(sum(n_items) AS BIGINT) AS items
FROM category GROUP BY 1 ORDER BY gmv DESC NULLS LAST, product_category LIMIT 3
""")(lambda c: M.top_categories(c.category, n=3))
query("a19_category_state_matrix", """
, tc AS (SELECT product_category FROM category GROUP BY 1
         ORDER BY sum(CAST(gmv AS DECIMAL(18,2))) DESC NULLS LAST, product_category LIMIT 10),
ts AS (SELECT customer_state FROM category WHERE customer_state IS NOT NULL GROUP BY 1
       ORDER BY sum(CAST(gmv AS DECIMAL(18,2))) DESC NULLS LAST, customer_state LIMIT 10)
SELECT product_category, customer_state, CAST(sum(CAST(gmv AS DECIMAL(18,2))) AS DOUBLE) AS gmv
FROM category WHERE product_category IN (SELECT * FROM tc) AND customer_state IN (SELECT * FROM ts)
GROUP BY 1, 2
""")(lambda c: M.category_state_matrix(c.category))

query("a19_category_state_pivot", """
, tc AS (SELECT product_category FROM category GROUP BY 1
         ORDER BY sum(CAST(gmv AS DECIMAL(18,2))) DESC NULLS LAST, product_category LIMIT 10),
ts AS (SELECT customer_state, row_number() OVER (ORDER BY g DESC NULLS LAST, customer_state) AS r FROM (
         SELECT customer_state, sum(CAST(gmv AS DECIMAL(18,2))) AS g
         FROM category WHERE customer_state IS NOT NULL GROUP BY 1) QUALIFY r <= 10),
lg AS (SELECT product_category, r, CAST(sum(CAST(gmv AS DECIMAL(18,2))) AS DOUBLE) AS v
       FROM category JOIN ts USING (customer_state)
       WHERE product_category IN (SELECT product_category FROM tc) GROUP BY 1, 2)
SELECT product_category, """ + ", ".join(
    f"CAST(coalesce(sum(v) FILTER (WHERE r = {i}), 0) AS DOUBLE) AS state_{i}" for i in range(1, 11)) + """
FROM lg GROUP BY 1
""")(lambda c: M.category_state_matrix(c.category, pivot=True))

query("a20_cac_scenario", """
, k AS (""" + _kpis_sql("orders_e") + """)
SELECT CAST(50000.0 AS DOUBLE) * greatest(coalesce(n_months, 1), 1) AS total_spend,
       50000.0 * greatest(coalesce(n_months, 1), 1) / nullif(customers, 0) AS blended_cac,
       50000.0 * greatest(coalesce(n_months, 1), 1) / nullif(gmv, 0) AS pct_gmv_on_marketing,
       repeat_rate, customers * (2.0 / 100.0) * aov AS incremental_gmv,
       customers * (2.0 / 100.0) AS extra_repeat_customers,
       customers * (2.0 / 100.0) * 120.0 AS equiv_paid_cost
FROM k""")(lambda c: M.cac_scenario(M.kpis(c.enriched), 50000.0, 120.0, 2.0))

query("a49_headline_ratios", """
, gm AS (""" + _gmv_monthly_sql("orders_e") + """),
per AS (SELECT customer_unique_id, count(*) AS n FROM orders_e
        WHERE customer_unique_id IS NOT NULL GROUP BY 1),
rr AS (SELECT review_bucket AS b, avg(CAST(has_subsequent_order AS DOUBLE)) AS r
       FROM orders_e WHERE review_bucket IS NOT NULL GROUP BY 1),
rd AS (SELECT delivery_bucket AS b, avg(CAST(has_subsequent_order AS DOUBLE)) AS r
       FROM orders_e WHERE delivery_bucket IS NOT NULL GROUP BY 1),
rr_o AS (SELECT r, """ + _ordinal_sql("b", X.REVIEW_BUCKETS) + """ AS o FROM rr),
rd_o AS (SELECT r, """ + _ordinal_sql("b", X.DELIVERY_BUCKETS) + """ AS o FROM rd)
SELECT
  CAST(sum(CAST(repeat_gmv AS DECIMAL(18,2))) AS DOUBLE)
    / greatest(CAST(sum(CAST(total_gmv AS DECIMAL(18,2))) AS DOUBLE), 1.0) AS repeat_gmv_share,
  (SELECT count(*) FILTER (WHERE n = 1) / count(*) FROM per) AS buy_once_share,
  (SELECT CASE WHEN count(*) >= 2 THEN max(r) FILTER (WHERE o = (SELECT max(o) FROM rr_o))
                 / nullif(max(r) FILTER (WHERE o = (SELECT min(o) FROM rr_o)), 0) - 1.0 ELSE 0.0 END
   FROM rr_o) AS review_reorder_gap,
  (SELECT CASE WHEN count(*) >= 2 THEN 1.0 - max(r) FILTER (WHERE o = (SELECT max(o) FROM rd_o))
                 / nullif(max(r) FILTER (WHERE o = (SELECT min(o) FROM rd_o)), 0) ELSE 0.0 END
   FROM rd_o) AS delivery_reorder_gap
FROM gm""")(lambda c: M.headline_ratios(c.enriched, c.enriched))

query("v10_share_by_state", """
, g AS (SELECT customer_state, count(*) AS orders FROM orders_e GROUP BY 1)
SELECT customer_state, orders, orders / sum(orders) OVER () AS share FROM g
""")(lambda c: M.share(c.enriched.groupBy("customer_state").agg(F.count(F.lit(1)).alias("orders")),
                       "orders"))
