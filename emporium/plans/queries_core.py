"""Registered queries: staging, fact, dimensions, history, order grain."""
from __future__ import annotations

from pyspark.sql import functions as F

from emporium.functions import expr as X
from emporium.operators import gold as G
from emporium.operators import orders as O
from emporium.operators import scd2, staging
from emporium.operators.incremental import new_store
from emporium.plans.catalog import query
from emporium.session import scratch_path
from emporium.sources import binding
from emporium.sources.history_table import HistoryTable

# ---------------------------------------------------------------- staging --
query("t1_dedupe_items", "SELECT * FROM s_items")(
    lambda c: staging.dedupe_latest(c.src.order_items, ["order_id", "order_item_id"]))
query("t2_stg_customers", "SELECT * FROM s_customers")(lambda c: staging.stg_customers(c.src))
query("t3_stg_orders", "SELECT * FROM s_orders")(lambda c: staging.stg_orders(c.src))
query("t4_stg_order_items", "SELECT * FROM s_items")(lambda c: staging.stg_order_items(c.src))
query("t5_stg_order_payments", "SELECT * FROM s_payments")(
    lambda c: staging.stg_order_payments(c.src))
query("t6_stg_order_reviews", "SELECT * FROM s_reviews")(
    lambda c: staging.stg_order_reviews(c.src))
query("t7_stg_products", "SELECT * FROM s_products")(lambda c: staging.stg_products(c.src))
query("t8_stg_category_translation", "SELECT * FROM b_category_translation")(
    lambda c: staging.stg_category_translation(c.src))
query("t9_stg_sellers", "SELECT * FROM s_sellers")(lambda c: staging.stg_sellers(c.src))
query("t10_stg_geolocation", "SELECT * FROM s_geolocation")(
    lambda c: staging.stg_geolocation(c.src))

# ------------------------------------------------------------------- gold --
query("g1_fact_orders", "SELECT * FROM fact_orders")(lambda c: c.fact)
query("g2_dim_customers", "SELECT * FROM dim_customers")(lambda c: c.gold.dim_customers)
query("g3_dim_sellers", "SELECT * FROM dim_sellers")(lambda c: c.gold.dim_sellers)
query("g4_dim_products", "SELECT * FROM dim_products")(lambda c: c.gold.dim_products)
query("g5_dim_reviews", "SELECT * FROM dim_reviews")(lambda c: c.gold.dim_reviews)


@query("g6_dim_geolocation", """
, gl_marked AS (
  SELECT *, (lag(1) OVER w) IS NULL AS _first,
    (geolocation_lat IS NOT DISTINCT FROM lag(geolocation_lat) OVER w
     AND geolocation_lng IS NOT DISTINCT FROM lag(geolocation_lng) OVER w
     AND geolocation_city IS NOT DISTINCT FROM lag(geolocation_city) OVER w
     AND geolocation_state IS NOT DISTINCT FROM lag(geolocation_state) OVER w) AS _same
  FROM b_geolocation
  WINDOW w AS (PARTITION BY geolocation_zip_code_prefix ORDER BY updated_at NULLS FIRST,
    geolocation_lat NULLS FIRST, geolocation_lng NULLS FIRST, geolocation_city NULLS FIRST,
    geolocation_state NULLS FIRST, batched_at NULLS FIRST)
), gl_hist AS (
  SELECT *, updated_at AS valid_from,
    lead(updated_at) OVER (PARTITION BY geolocation_zip_code_prefix ORDER BY updated_at NULLS FIRST,
      geolocation_lat NULLS FIRST, geolocation_lng NULLS FIRST, geolocation_city NULLS FIRST,
      geolocation_state NULLS FIRST, batched_at NULLS FIRST) AS valid_to
  FROM gl_marked WHERE _first OR NOT _same
)
SELECT md5(concat_ws('␟', geolocation_zip_code_prefix, CAST(epoch_us(valid_from) AS VARCHAR))) AS id,
       geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_city,
       geolocation_state, valid_from, valid_to, valid_to IS NULL AS is_current
FROM gl_hist
""")
def g6_dim_geolocation(c):
    return c.gold.dim_geolocation


@query("g7_dim_date", """
, bounds AS (SELECT min(CAST(order_purchase_timestamp AS DATE)) lo,
                    max(CAST(order_purchase_timestamp AS DATE)) hi FROM fact_orders),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds)
SELECT date, CAST(year(date) AS BIGINT) AS year, CAST(quarter(date) AS BIGINT) AS quarter,
       CAST(month(date) AS BIGINT) AS month, CAST(day(date) AS BIGINT) AS day,
       CAST(dayofweek(date) + 1 AS BIGINT) AS day_of_week,
       CAST(date_trunc('month', date) AS DATE) AS month_start,
       dayofweek(date) IN (0, 6) AS is_weekend
FROM days
""")
def g7_dim_date(c):
    return G.build_dim_date(c.fact)


# ---------------------------------------------------------------- history --
@query("h1_scd2_timestamp_geolocation", """
, g_first AS (  -- first run: staging as of the earliest three update days
  SELECT * FROM b_geolocation WHERE updated_at < TIMESTAMP '2024-01-04'
  QUALIFY row_number() OVER (PARTITION BY geolocation_zip_code_prefix
    ORDER BY updated_at DESC NULLS LAST, batched_at DESC NULLS LAST, geolocation_lat DESC NULLS LAST,
    geolocation_lng DESC NULLS LAST, geolocation_city DESC NULLS LAST, geolocation_state DESC NULLS LAST) = 1
), g_cur AS (SELECT * FROM s_geolocation),
h0 AS (SELECT *, updated_at AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM g_first),
j AS (SELECT h.geolocation_zip_code_prefix AS hk, c.geolocation_zip_code_prefix AS ck,
             coalesce(c.updated_at > h.updated_at, false) AS chg,
             h.geolocation_zip_code_prefix AS h_zip, h.geolocation_lat AS h_lat, h.geolocation_lng AS h_lng,
             h.geolocation_city AS h_city, h.geolocation_state AS h_state, h.updated_at AS h_upd,
             h.batched_at AS h_bat, h.valid_from AS h_vf,
             c.geolocation_zip_code_prefix AS c_zip, c.geolocation_lat AS c_lat, c.geolocation_lng AS c_lng,
             c.geolocation_city AS c_city, c.geolocation_state AS c_state, c.updated_at AS c_upd,
             c.batched_at AS c_bat
      FROM h0 h FULL OUTER JOIN g_cur c ON h.geolocation_zip_code_prefix = c.geolocation_zip_code_prefix)
SELECT h_zip AS geolocation_zip_code_prefix, h_lat AS geolocation_lat, h_lng AS geolocation_lng,
       h_city AS geolocation_city, h_state AS geolocation_state, h_upd AS updated_at, h_bat AS batched_at,
       h_vf AS valid_from, CASE WHEN hk IS NOT NULL AND ck IS NOT NULL AND chg THEN c_upd END AS valid_to
FROM j WHERE hk IS NOT NULL
UNION ALL
SELECT c_zip, c_lat, c_lng, c_city, c_state, c_upd, c_bat, c_upd, NULL
FROM j WHERE ck IS NOT NULL AND (hk IS NULL OR chg)
""")
def h1_scd2_timestamp_geolocation(c):
    """H1 run twice: staging as of an early cut-off, then the full staging."""
    early = staging.dedupe_latest(
        c.src.geolocation.filter(F.col("updated_at") < F.lit("2024-01-04").cast("timestamp_ntz")),
        ["geolocation_zip_code_prefix"], [("updated_at", True), ("batched_at", True)],
        descending=True)
    current = staging.stg_geolocation(c.src)
    history = HistoryTable(c.spark, scratch_path(c.spark, "geo-history"), current.schema,
                           ["geolocation_zip_code_prefix"], buckets=16)
    history.run_timestamp(early, "updated_at", "run-1")
    history.run_timestamp(current, "updated_at", "run-2")
    return history.read().drop("scd_id")


@query("h2_scd2_check_products", """
SELECT * EXCLUDE (_pk), TIMESTAMP '2024-01-01 00:00:00' AS valid_from,
       CASE WHEN _pk % 5 = 0 THEN TIMESTAMP '2024-01-15 00:00:00' END AS valid_to,
       md5(concat_ws('␟', product_id, CAST(epoch_us(TIMESTAMP '2024-01-01 00:00:00') AS VARCHAR))) AS scd_id
FROM b_products_v1
UNION ALL
SELECT *, TIMESTAMP '2024-01-15 00:00:00', CAST(NULL AS TIMESTAMP),
       md5(concat_ws('␟', product_id, CAST(epoch_us(TIMESTAMP '2024-01-15 00:00:00') AS VARCHAR)))
FROM b_products_v2 WHERE CAST(product_id AS BIGINT) % 5 = 0
""")
def h2_scd2_check_products(c):
    return c.gold.products_history


@query("h2_scd2_check_idempotent", """
SELECT count(*) AS versions, count(*) AS open_versions FROM b_products_v1
""")
def h2_scd2_check_idempotent(c):
    """Re-running a snapshot with unchanged input adds no version."""
    cur = staging.stg_products(c.src, current=False)
    history = HistoryTable(c.spark, scratch_path(c.spark, "product-history"), cur.schema, ["product_id"], buckets=16)
    history.run_check(cur, G.PRODUCT_ATTRS, binding.PRODUCTS_V1_AT, "run-1")
    history.run_check(cur, G.PRODUCT_ATTRS, binding.PRODUCTS_V2_AT, "run-2")
    return history.read().agg(F.count(F.lit(1)).alias("versions"),
                              F.count(F.when(F.col("valid_to").isNull(), 1)).alias("open_versions"))


@query("h2_scd2_check_history_table", """
SELECT * EXCLUDE (_pk), TIMESTAMP '2024-01-01 00:00:00' AS valid_from,
       CASE WHEN _pk % 5 = 0 THEN TIMESTAMP '2024-01-15 00:00:00' END AS valid_to,
       md5(concat_ws('␟', product_id, CAST(epoch_us(TIMESTAMP '2024-01-01 00:00:00') AS VARCHAR))) AS scd_id
FROM b_products_v1
UNION ALL
SELECT *, TIMESTAMP '2024-01-15 00:00:00', CAST(NULL AS TIMESTAMP),
       md5(concat_ws('␟', product_id, CAST(epoch_us(TIMESTAMP '2024-01-15 00:00:00') AS VARCHAR)))
FROM b_products_v2 WHERE CAST(product_id AS BIGINT) % 5 = 0
""")
def h2_scd2_check_history_table(c):
    """Two snapshot runs that write open rows of changed keys and append closed ones."""
    first = staging.stg_products(c.src, current=False)
    history = HistoryTable(c.spark, scratch_path(c.spark, "product-history"), first.schema, ["product_id"], buckets=16)
    history.run_check(first, G.PRODUCT_ATTRS, binding.PRODUCTS_V1_AT, "run-1")
    history.run_check(staging.stg_products(c.src, current=True), G.PRODUCT_ATTRS, binding.PRODUCTS_V2_AT, "run-2")
    return history.read()


@query("h3_validity_reviews", """
SELECT review_id, valid_from, valid_to, valid_to IS NULL AS is_current FROM reviews_history
""")
def h3_validity_reviews(c):
    return c.gold.reviews_history.select("review_id", "valid_from", "valid_to", "is_current")


@query("h4_surrogate_key", """
SELECT review_id, md5(concat_ws('␟', coalesce(review_id, ''),
       coalesce(CAST(epoch_us(review_answer_timestamp) AS VARCHAR), ''))) AS sk
FROM b_reviews
""")
def h4_surrogate_key(c):
    r = c.src.order_reviews
    return r.select("review_id",
                    scd2.surrogate_key(r, ["review_id", "review_answer_timestamp"]).alias("sk"))


@query("h5_version_ranges", """
, v AS (SELECT review_id, review_score, review_comment_title, review_comment_message,
               review_answer_timestamp, min(review_creation_date) AS start_at,
               max(review_creation_date) AS last_seen_at
        FROM b_reviews GROUP BY ALL)
SELECT *, lead(start_at) OVER (PARTITION BY review_id ORDER BY start_at NULLS FIRST,
          review_score NULLS FIRST, review_comment_title NULLS FIRST,
          review_comment_message NULLS FIRST, review_answer_timestamp NULLS FIRST) AS end_at,
       lead(start_at) OVER (PARTITION BY review_id ORDER BY start_at NULLS FIRST,
          review_score NULLS FIRST, review_comment_title NULLS FIRST,
          review_comment_message NULLS FIRST, review_answer_timestamp NULLS FIRST) IS NULL AS is_current
FROM v
""")
def h5_version_ranges(c):
    return scd2.version_ranges(
        c.src.order_reviews, ["review_id"],
        ["review_score", "review_comment_title", "review_comment_message",
         "review_answer_timestamp"], "review_creation_date")


@query("h6_scd2_from_log_reviews", """
SELECT *, md5(concat_ws('␟', coalesce(review_id, ''), coalesce(CAST(epoch_us(valid_from) AS VARCHAR), ''))) AS scd_id,
       valid_to IS NULL AS is_current
FROM reviews_history
""")
def h6_scd2_from_log_reviews(c):
    return c.gold.reviews_history


# ------------------------------------------------------------ order grain --
query("a1_orders", "SELECT * FROM orders_o")(lambda c: c.orders)
query("m1_v_orders", "SELECT * FROM orders_e")(lambda c: c.enriched)
query("a17_category", "SELECT * FROM category")(lambda c: c.category)


@query("j6_current_review_per_order", "SELECT * FROM cur_review")
def j6_current_review_per_order(c):
    return G.current_review_per_order(c.gold.dim_reviews_current)


@query("j11_current_products", "SELECT * FROM dim_products WHERE is_current")
def j11_current_products(c):
    return G.current(c.gold.dim_products)


@query("j10_orphans_fact_products", """
SELECT f.* FROM fact_orders f WHERE f.product_id IS NOT NULL
  AND f.product_id NOT IN (SELECT product_id FROM dim_products WHERE product_id IS NOT NULL)
""")
def j10_orphans_fact_products(c):
    return G.orphans(c.fact, c.gold.dim_products, "product_id", "product_id")


@query("j10_orphans_reviews_orders", """
SELECT r.* FROM dim_reviews r WHERE r.order_id IS NOT NULL
  AND r.order_id NOT IN (SELECT id FROM fact_orders)
""")
def j10_orphans_reviews_orders(c):
    return G.orphans(c.gold.dim_reviews, c.fact, "order_id", "id")


@query("j9_fill_regions", """
, st AS (SELECT customer_state, count(*) AS orders FROM orders_o
         WHERE delivered_ts IS NOT NULL GROUP BY 1)
SELECT n.n_name AS customer_state, r.r_name AS region, st.orders
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN st ON st.customer_state = n.n_name
""")
def j9_fill_regions(c):
    """Every nation (the region reference) with its delivered-order count, if any."""
    n = c.spark.read.parquet(f"{c.sf_dir}/nation.parquet")
    r = c.spark.read.parquet(f"{c.sf_dir}/region.parquet")
    regions = (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
               .select(F.col("n_name").alias("customer_state"), F.col("r_name").alias("region")))
    m = (c.orders.filter(F.col("delivered_ts").isNotNull()).groupBy("customer_state")
         .agg(F.count(F.lit(1)).alias("orders")))
    return G.fill_regions(m, regions, "customer_state")


@query("v5_best_review", """
SELECT order_id, review_score, review_id FROM (
  SELECT order_id, review_score, review_id FROM dim_reviews WHERE is_current)
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY review_score DESC NULLS LAST,
                           review_id DESC NULLS LAST) = 1
""")
def v5_best_review(c):
    cur = G.current(c.gold.dim_reviews_current).select("order_id", "review_score", "review_id")
    return O.best_review(cur)

query("p2_star_minus", "SELECT * EXCLUDE (order_status, order_approved_at) FROM b_orders")(
    lambda c: X.drop_cols(c.src.orders, "order_status", "order_approved_at"))


# ------------------------------------------------------------- increments --
FIRST_LOAD_BEFORE = "1996-01-01"


def _two_loads(c):
    """All five tables in two loads, cut by different columns, the second one repeated."""
    src, day = c.src, F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz")
    early = {"orders": F.col("order_purchase_timestamp") < day, "order_items": F.col("shipping_limit_date") < day,
             "order_payments": F.col("payment_sequential") <= 1,
             "order_reviews": F.col("review_answer_timestamp") < F.lit("2024-01-15").cast("timestamp_ntz"),
             "customers": F.col("customer_state") != "NATION_3"}
    tables = {n: getattr(src, n) for n in early}
    store = new_store(c.spark, {n: t.schema for n, t in tables.items()})
    store.load({n: t.where(early[n]) for n, t in tables.items()}, "load-1")
    late = {n: t.where(~F.coalesce(early[n], F.lit(False))) for n, t in tables.items()}
    store.load(late, "load-2")
    store.load(late, "load-2")
    return store


query("a1_orders_incremental", "SELECT * FROM orders_o")(lambda c: _two_loads(c).grain.read())
query("m1_v_orders_incremental", "SELECT * FROM orders_e")(lambda c: _two_loads(c).enriched.read())
