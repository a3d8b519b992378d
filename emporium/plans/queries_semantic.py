"""Registered queries: semantic datasets, metric queries (M1–M6) and marts."""
from __future__ import annotations

from emporium.operators import persons as P
from emporium.plans import rollup as R
from emporium.plans import semantic as S
from emporium.plans.catalog import query
from emporium.plans.queries_metrics import _COHORT, _RFM, F_END, F_START, F_STATES

_VCUST = _RFM + """
, vc AS (
  SELECT s.customer_unique_id, x.customer_state, s.frequency, CAST(s.monetary_d AS DOUBLE) AS monetary,
         s.recency AS recency_days, x.cohort_month, s.frequency > 1 AS is_repeat_customer,
         CASE WHEN s.frequency >= 5 THEN '5+' ELSE CAST(s.frequency AS VARCHAR) END AS orders_placed_bucket,
         s.segment
  FROM seg s JOIN (SELECT customer_unique_id, max(customer_state) AS customer_state,
                          min(order_month) AS cohort_month
                   FROM orders_e WHERE customer_unique_id IS NOT NULL GROUP BY 1) x
    ON s.customer_unique_id = x.customer_unique_id)
"""
_VCOH = _COHORT + """
, vco AS (SELECT cohort_month, CAST(months_since AS VARCHAR) AS months_since,
                 months_since AS months_since_num, customers AS active_customers, cohort_size, retention
          FROM ret)
"""
_VORD = """
, vo AS (SELECT *, CAST((year(order_month) - year(cohort_month)) * 12
                        + month(order_month) - month(cohort_month) AS BIGINT) AS months_since_first
         FROM orders_e)
"""
query("m1_v_orders_dataset", _VORD + "SELECT * FROM vo")(lambda c: S.v_orders(c.enriched))
query("m2_v_customers", _VCUST + "SELECT * FROM vc")(lambda c: S.v_customers(c.enriched))
query("m3_v_cohort", _VCOH + "SELECT * FROM vco")(lambda c: S.v_cohort(c.enriched))
query("m4_v_category", "SELECT * FROM category")(lambda c: c.category)

_ALL_ORDER_METRICS = list(S.METRICS["v_orders"])
query("m5_named_metrics", _VORD + "SELECT " + ", ".join(
    f"{expr.replace('BIGINT', 'BIGINT')} AS {name}" for name, expr in S.METRICS["v_orders"].items())
    + " FROM vo")(lambda c: S.metric_query(S.v_orders(c.enriched), "v_orders", _ALL_ORDER_METRICS))

query("m5_category_metrics", "SELECT " + ", ".join(
    f"CAST({e} AS {'BIGINT' if n == 'items' else 'DOUBLE'}) AS {n}" for n, e in S.METRICS["v_category"].items())
    + " FROM category")(lambda c: S.metric_query(c.category, "v_category", list(S.METRICS["v_category"])))

# M6: the 18 charts (six single numbers, twelve grouped).
_CHARTS = [
    # name, dataset, metrics, dims, filters, order_by, desc, limit
    ("m6_gmv_by_repeat", "v_orders", ["gmv_total"], ["order_month", "is_repeat_order"], [], None, True, None),
    ("m6_repeat_share_by_month", "v_orders", ["repeat_order_share"], ["order_month"], [], None, True, None),
    ("m6_customers_by_orders_bucket", "v_customers", ["customer_count"], ["orders_placed_bucket"], [],
     "customer_count", True, 10),
    ("m6_customers_by_segment", "v_customers", ["customer_count"], ["segment"], [], "customer_count", True, 10),
    ("m6_reorder_by_review_bucket", "v_orders", ["reorder_rate"], ["review_bucket"], [], "reorder_rate", True, 10),
    ("m6_orders_by_delivery_bucket", "v_orders", ["order_count"], ["delivery_bucket"], [], "order_count", True, 10),
    ("m6_late_rate_by_state", "v_orders", ["late_rate"], ["customer_state"], [], "late_rate", True, 27),
    ("m6_avg_review_by_delivery_bucket", "v_orders", ["avg_review"], ["delivery_bucket"], [], "avg_review", True, 10),
    ("m6_late_rate_by_month", "v_orders", ["late_rate"], ["order_month"], [], None, True, None),
    ("m6_reorder_by_delivery_bucket", "v_orders", ["reorder_rate"], ["delivery_bucket"], [], "reorder_rate", True, 10),
    ("m6_top_categories", "v_category", ["gmv_total"], ["product_category"], [], "gmv_total", True, 12),
    ("m6_retention_heatmap", "v_cohort_retention", ["avg_retention"], ["cohort_month", "months_since"], [], None,
     True, None),
    ("m6_kpi_gmv", "v_orders", ["gmv_total"], [], [], None, True, None),
    ("m6_kpi_orders", "v_orders", ["order_count"], [], [], None, True, None),
    ("m6_kpi_aov", "v_orders", ["aov"], [], [], None, True, None),
    ("m6_kpi_repeat_customer_rate", "v_customers", ["repeat_customer_rate"], [], [], None, True, None),
    ("m6_kpi_on_time", "v_orders", ["on_time_rate"], [], [], None, True, None),
    ("m6_kpi_review", "v_orders", ["avg_review"], [], [], None, True, None),
    # A metric query with a filter, and one of two metrics.
    ("m6_delivered_orders", "v_orders", ["order_count", "on_time_rate"], [], ["is_delivered"], None, True, None),
    # Months and states of the dashboard's filter (P25), and a filter that no set covers.
    ("m6_filtered_gmv_by_repeat", "v_orders", ["gmv_total", "aov", "reorder_rate"], ["order_month", "is_repeat_order"],
     R.filter_sql(F_START, F_END, F_STATES), None, True, None),
    ("m6_filtered_reviews", "v_orders", ["avg_review", "order_count", "avg_lead_days"], ["delivery_bucket"],
     R.filter_sql("1995-01-01", "1996-06-01"), "order_count", True, 3),
    ("m6_orders_of_one_item", "v_orders", ["gmv_total"], ["order_month"], ["n_items = 1"], None, True, None),
    ("m6_customer_totals", "v_customers", ["repeat_customer_rate", "total_monetary"], [], [], None, True, None),
]
_SRC = {"v_orders": (_VORD, "vo", lambda c: S.v_orders(c.enriched)),
        "v_customers": (_VCUST, "vc", lambda c: S.v_customers(c.enriched)),
        "v_cohort_retention": (_VCOH, "vco", lambda c: S.v_cohort(c.enriched)),
        "v_category": ("", "category", lambda c: c.category)}


def _chart_sql(ds, metrics, dims, filters, order_by, desc, limit):
    pre, rel, _ = _SRC[ds]
    sel = ", ".join(list(dims) + [f"{S.METRICS[ds][m]} AS {m}" for m in metrics])
    where = (" WHERE " + " AND ".join(filters)) if filters else ""
    group = (" GROUP BY " + ", ".join(dims)) if dims else ""
    order = ""
    dim_order = ", ".join(f"{d} ASC NULLS FIRST" for d in dims)
    if order_by is not None and limit is not None:
        order = f" ORDER BY {order_by} {'DESC' if desc else 'ASC'} NULLS LAST" + (
            f", {dim_order}" if dims else "") + f" LIMIT {limit}"
    return pre + f"SELECT {sel} FROM {rel}{where}{group}{order}"


for (_n, _ds, _m, _d, _f, _o, _desc, _lim) in _CHARTS:
    def _fn(c, _ds=_ds, _m=_m, _d=_d, _f=_f, _o=_o, _desc=_desc, _lim=_lim):
        return R.metric_query(c.rollup(_ds, lambda: _SRC[_ds][2](c)), lambda: _SRC[_ds][2](c), _m, _d, _f, _o, _desc,
                              _lim)
    query(_n, _chart_sql(_ds, _m, _d, _f, _o, _desc, _lim))(_fn)

query("g8_customer_360", _VCUST + """
SELECT vc.*, l.first_purchase_ts, l.last_purchase_ts, vc.monetary / nullif(vc.frequency, 0) AS avg_order_value
FROM vc JOIN (SELECT customer_unique_id, min(purchase_ts) AS first_purchase_ts,
                     max(purchase_ts) AS last_purchase_ts
              FROM orders_e WHERE customer_unique_id IS NOT NULL GROUP BY 1) l
  ON vc.customer_unique_id = l.customer_unique_id
""")(lambda c: S.customer_360(c.enriched))
query("g9_monthly_revenue", """
SELECT order_month, product_category, CAST(sum(CAST(gmv AS DECIMAL(18,2))) AS DOUBLE) AS gmv,
       CAST(sum(n_items) AS BIGINT) AS items
FROM category GROUP BY 1, 2
""")(lambda c: S.monthly_revenue(c.category))

# Distinct persons by bitmaps: the same rows as A6, A16 and A28, and counts under filters
# that merge months and states.
query("a6_orders_per_customer_bitmap", """
, per AS (SELECT customer_unique_id, count(*) AS n FROM orders_e
          WHERE customer_unique_id IS NOT NULL GROUP BY 1)
SELECT CAST(least(n, 5) AS BIGINT) AS orders_placed, count(*) AS customers,
       CASE WHEN least(n, 5) >= 5 THEN '5+' ELSE CAST(least(n, 5) AS VARCHAR) END AS label
FROM per GROUP BY 1, 3""")(lambda c: P.orders_per_customer(P.bitmaps(c.enriched)))
query("a16_acquisition_treadmill_bitmap", """
SELECT order_month,
       count(DISTINCT customer_unique_id) FILTER (WHERE NOT is_repeat_order) AS "new",
       count(DISTINCT customer_unique_id) FILTER (WHERE is_repeat_order) AS "repeat"
FROM orders_e WHERE customer_unique_id IS NOT NULL GROUP BY 1
""")(lambda c: P.treadmill(P.bitmaps(c.enriched)))
query("a28_repeat_customer_rate_bitmap", """
, per AS (SELECT customer_unique_id, count(*) AS n FROM orders_e WHERE customer_unique_id IS NOT NULL GROUP BY 1)
SELECT count(*) AS customers, count(*) FILTER (WHERE n > 1) AS repeat_customers,
       count(*) FILTER (WHERE n > 1) / nullif(count(*), 0) AS repeat_customer_rate FROM per
""")(lambda c: P.repeat_customer_rate(P.bitmaps(c.enriched)))
query("a16_persons_by_state_filtered", """
SELECT customer_state, count(DISTINCT customer_unique_id) AS persons FROM orders_e
WHERE customer_unique_id IS NOT NULL AND order_month >= DATE '1994-01-01' AND order_month <= DATE '1995-06-01'
GROUP BY 1
""")(lambda c: P.count_persons(P.bitmaps(c.enriched), ["customer_state"], R.filter_sql("1994-01-01", "1995-06-01")))
