"""Registered queries: loads, sinks, the incremental stream and monitoring.

I/O operators return the table they produced (written under the session's
shared checkpoint folder and read back), so they are compared with the same
oracle rows as the in-memory frames.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from emporium.operators import business as B
from emporium.operators import monitor as MO
from emporium.plans.catalog import query
from emporium.session import scratch_path
from emporium.plans.queries_text import RT
from emporium.sources import io, reconcile
from emporium.sources.csv_split import infer_schema_split, read_csv_split
from emporium.sources.keyed_table import KeyedTable
from emporium.streaming.upsert_stream import stream_upsert

ORDERS_SCHEMA = ("order_id string, customer_id string, order_status string, "
                 "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
                 "order_delivered_carrier_date timestamp_ntz, "
                 "order_delivered_customer_date timestamp_ntz, "
                 "order_estimated_delivery_date timestamp_ntz")
FIRST_LOAD_BEFORE = "2024-01-15 00:00:00"
RUN_AS_OF = "2024-01-30 12:00:00"


@query("s1_csv_roundtrip", "SELECT * FROM b_orders")
def s1_csv_roundtrip(c):
    path = io.write_csv(c.src.orders, scratch_path(c.spark, "csv-orders"))
    return io.read_csv(c.spark, path, ORDERS_SCHEMA)


@query("s2_infer_schema", """
SELECT * FROM (VALUES ('seller_id', 'int'), ('seller_zip_code_prefix', 'int'), ('seller_city', 'string'),
                      ('seller_state', 'string')) t("column", "type")""")
def s2_infer_schema(c):
    path = io.write_csv(c.src.sellers, scratch_path(c.spark, "csv-sellers"))
    schema = io.infer_schema(c.spark, path)
    rows = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return c.spark.createDataFrame(rows, "column string, type string")


@query("s1_csv_split", "SELECT * FROM b_orders")
def s1_csv_split(c):
    """The same round trip by the reader that finds records in splits of a file."""
    path = io.write_csv(c.src.orders, scratch_path(c.spark, "csv-orders"))
    return read_csv_split(c.spark, path, ORDERS_SCHEMA)


@query("s1_csv_split_texts", f"SELECT review_id, review_score, title, message FROM {RT}")
def s1_csv_split_texts(c):
    """Texts with newlines and quotes, written by as many tasks as read them: files of several splits."""
    path = io.write_csv(c.review_texts, scratch_path(c.spark, "csv-texts"))
    return read_csv_split(c.spark, path, "review_id string, review_score long, title string, message string")


@query("s2_infer_schema_split", """
SELECT * FROM (VALUES ('seller_id', 'int'), ('seller_zip_code_prefix', 'int'), ('seller_city', 'string'),
                      ('seller_state', 'string')) t("column", "type")""")
def s2_infer_schema_split(c):
    path = io.write_csv(c.src.sellers, scratch_path(c.spark, "csv-sellers"))
    rows = [(f.name, f.dataType.simpleString()) for f in infer_schema_split(c.spark, path)]
    return c.spark.createDataFrame(rows, "column string, type string")


_FIRST = f"(SELECT * FROM b_reviews WHERE review_answer_timestamp < TIMESTAMP '{FIRST_LOAD_BEFORE}')"


def _first_load(c):
    return c.src.order_reviews.filter(
        F.col("review_answer_timestamp") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz"))


@query("s4_incremental_read", f"""
SELECT * FROM b_reviews WHERE review_answer_timestamp >= (SELECT max(review_answer_timestamp) FROM {_FIRST})
""")
def s4_incremental_read(c):
    _, state = io.incremental_read(_first_load(c), "review_answer_timestamp", None)
    delta, _ = io.incremental_read(c.src.order_reviews, "review_answer_timestamp", state)
    return delta


@query("s5_upsert", f"""
, tgt AS (SELECT * FROM {_FIRST} QUALIFY row_number() OVER (PARTITION BY review_id
    ORDER BY review_answer_timestamp DESC NULLS LAST, order_id DESC NULLS LAST,
             review_score DESC NULLS LAST, review_comment_title DESC NULLS LAST,
             review_comment_message DESC NULLS LAST, review_creation_date DESC NULLS LAST) = 1),
dl AS (SELECT * FROM b_reviews WHERE review_answer_timestamp >=
         (SELECT max(review_answer_timestamp) FROM {_FIRST})),
dd AS (SELECT * FROM dl QUALIFY row_number() OVER (PARTITION BY review_id
    ORDER BY review_answer_timestamp DESC NULLS LAST, order_id DESC NULLS LAST,
             review_score DESC NULLS LAST, review_comment_title DESC NULLS LAST,
             review_comment_message DESC NULLS LAST, review_creation_date DESC NULLS LAST) = 1)
SELECT * FROM tgt WHERE review_id NOT IN (SELECT review_id FROM dd)
UNION ALL SELECT * FROM dd
""")
def s5_upsert(c):
    """A table in key buckets: first load, then an increment, which is replayed."""
    table = KeyedTable(c.spark, scratch_path(c.spark, "reviews"), c.src.order_reviews.schema, ["review_id"], 16)
    order = [("review_answer_timestamp", True)]
    table.upsert(_first_load(c), "load-1", order)
    _, state = io.incremental_read(_first_load(c), "review_answer_timestamp", None)
    delta, _ = io.incremental_read(c.src.order_reviews, "review_answer_timestamp", state)
    table.upsert(delta, "load-2", order)
    table.upsert(delta, "load-2", order)  # committed before: nothing happens
    table.upsert(delta, "load-3", order)  # the same rows again: idempotent
    table.vacuum()
    return table.read()


_NEWEST = """QUALIFY row_number() OVER (PARTITION BY {keys}
    ORDER BY review_answer_timestamp DESC NULLS LAST, order_id DESC NULLS LAST,
             review_score DESC NULLS LAST, review_comment_title DESC NULLS LAST,
             review_comment_message DESC NULLS LAST, review_creation_date DESC NULLS LAST) = 1"""


@query("s5_late_rows", "SELECT * FROM b_reviews " + _NEWEST.format(keys="review_id"))
def s5_late_rows(c):
    """The older load arrives after the newer one: no newer row is replaced."""
    keys, order = ["review_id"], [("review_answer_timestamp", True)]
    late = _first_load(c)
    target = io.upsert(c.src.order_reviews.limit(0), c.src.order_reviews.filter(
        F.col("review_answer_timestamp") >= F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz")), keys, order)
    return io.upsert(target, late, keys, order)


@query("s5_composite_key", "SELECT * FROM b_reviews " + _NEWEST.format(keys="review_id, order_id"))
def s5_composite_key(c):
    """Reviews merged by (review_id, order_id) in two loads."""
    keys, order = ["review_id", "order_id"], [("review_answer_timestamp", True)]
    target = io.upsert(c.src.order_reviews.limit(0), _first_load(c), keys, order)
    return io.upsert(target, c.src.order_reviews, keys, order)


@query("s6_append_history", """
SELECT * EXCLUDE (batched_at), TIMESTAMP '2024-02-01 02:00:00' AS batched_at FROM b_geolocation
UNION ALL
SELECT * EXCLUDE (batched_at), TIMESTAMP '2024-02-02 02:00:00' AS batched_at FROM b_geolocation
""")
def s6_append_history(c):
    path, rows = scratch_path(c.spark, "history"), c.src.geolocation.drop("batched_at")
    io.append_history(rows, "2024-02-01 02:00:00", path)
    return io.append_history(rows, "2024-02-02 02:00:00", path)


_BRONZE = ["orders", "customers", "order_items", "order_payments", "order_reviews", "products",
           "sellers", "geolocation", "category_translation"]
_BRONZE_SQL = {"orders": "b_orders", "customers": "b_customers", "order_items": "b_items",
               "order_payments": "b_payments", "order_reviews": "b_reviews",
               "products": "b_products_v1", "sellers": "b_sellers",
               "geolocation": "b_geolocation", "category_translation": "b_category_translation"}


@query("s7_s10_load_and_reconcile", " UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", count(*) AS src_n, count(*) AS tgt_n, 'exact' AS status "
    f"FROM {_BRONZE_SQL[n]}" for n in _BRONZE))
def s7_s10_load_and_reconcile(c):
    sources = {n: getattr(c.src, n) for n in _BRONZE}
    paths = io.load_all(sources, scratch_path(c.spark, "bronze"))
    loaded = {n: c.spark.read.parquet(p) for n, p in paths.items()}
    return io.reconcile_counts(sources, loaded)


@query("s9_batched_load", """
SELECT count(*) AS rows, CAST(1 AS BIGINT) AS whole_files FROM b_orders
""")
def s9_batched_load(c):
    """Orders loaded in files of at most 100 rows: all rows, and no file with more."""
    path = io.load_all({"orders": c.src.orders}, scratch_path(c.spark, "batched"), max_records_per_file=100)["orders"]
    files = c.spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return files.agg(F.sum("n").alias("rows"), F.min((F.col("n") <= 100).cast("long")).alias("whole_files"))


@query("s8_flatten", """
SELECT order_id, order_purchase_timestamp AS dates__purchase,
       order_approved_at AS dates__handling__approved,
       order_delivered_carrier_date AS dates__handling__carrier
FROM b_orders
""")
def s8_flatten(c):
    nested = c.src.orders.select(
        "order_id",
        F.struct(F.col("order_purchase_timestamp").alias("purchase"),
                 F.struct(F.col("order_approved_at").alias("approved"),
                          F.col("order_delivered_carrier_date").alias("carrier"))
                 .alias("handling")).alias("dates"))
    return io.flatten(nested, depth=2)


@query("s11_materialize_gold", "SELECT * FROM fact_orders")
def s11_materialize_gold(c):
    return io.materialize(c.fact, "fact_orders", "gold", scratch_path(c.spark, "warehouse"))


@query("s12_cached_result", """
SELECT order_month, count(*) AS orders FROM orders_e GROUP BY 1
""")
def s12_cached_result(c):
    build = lambda: c.enriched.groupBy("order_month").agg(F.count(F.lit(1)).alias("orders"))
    base = scratch_path(c.spark, "cache")
    io.cached(c.spark, "orders_by_month", build, base, ttl_seconds=3600)
    io.cached(c.spark, "orders_by_month", build, base, ttl_seconds=3600)  # hit
    io.cached(c.spark, "orders_by_month", build, base, ttl_seconds=-1)  # expired: built again
    io.cached(c.spark, "orders_by_month", build, base, force=True)
    return io.cached(c.spark, "orders_by_month", build, base, ttl_seconds=-1, offline=True)


@query("s13_seed", "SELECT * FROM b_category_translation")
def s13_seed(c):
    path = io.write_csv(c.src.category_translation, scratch_path(c.spark, "seed"))
    return io.seed(c.spark, path,
                   "product_category_name string, product_category_name_english string")


@query("s14_category_revenue_csv", """
, catrev AS (SELECT coalesce(p.product_category, 'unknown') AS product_category,
       CAST(sum(CAST(f.price AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue, count(DISTINCT f.id) AS total_orders
FROM fact_orders f LEFT JOIN (SELECT product_id, product_category FROM dim_products WHERE is_current) p
  ON f.product_id = p.product_id GROUP BY 1)
SELECT *, total_revenue / nullif(total_orders, 0) AS avg_order_value FROM catrev
""")
def s14_category_revenue_csv(c):
    df = B.category_revenue(c.fact, c.gold.dim_products)
    path = io.write_csv(df, scratch_path(c.spark, "catrev"))
    return io.read_csv(c.spark, path, "product_category string, total_revenue double, "
                                      "total_orders long, avg_order_value double")


@query("s16_log_run", """
SELECT 'nightly-1' AS run_id, 'success' AS status, TIMESTAMP '2024-02-01 02:00:00' AS started,
       TIMESTAMP '2024-02-01 02:10:00' AS ended, count(*) AS rows FROM orders
""")
def s16_log_run(c):
    n = c.src.orders.count()
    return io.log_run(c.spark, scratch_path(c.spark, "runlog"), "nightly-1", "success",
                      "2024-02-01 02:00:00", "2024-02-01 02:10:00", n)


def _stream(c, keys):
    """Two arriving loads, some files a micro-batch."""
    src_dir, ev = scratch_path(c.spark, "stream-src"), c.src.order_reviews
    late = F.col("review_answer_timestamp") >= F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz")
    ev.filter(~late).write.parquet(f"{src_dir}/part=1")
    ev.filter(F.coalesce(late, F.lit(True))).write.parquet(f"{src_dir}/part=2")
    return stream_upsert(c.spark, f"{src_dir}/*", scratch_path(c.spark, "stream-tgt"),
                         scratch_path(c.spark, "stream-ckpt"), ev.schema, keys,
                         [("review_answer_timestamp", True)], max_files_per_trigger=1)


query("r1_stream_upsert", "SELECT * FROM s_reviews")(lambda c: _stream(c, ["review_id"]))
query("r1_stream_composite_key", "SELECT * FROM b_reviews " + _NEWEST.format(keys="review_id, order_id"))(
    lambda c: _stream(c, ["review_id", "order_id"]))


# ---------------------------------------------------------------- monitoring --
def _runs(c):
    e = c.src.order_reviews.select(F.col("review_answer_timestamp").alias("ts"))
    d = F.to_date("ts")
    return (e.groupBy(d.alias("day")).agg(F.count(F.lit(1)).alias("rows"),
                                         F.min("ts").alias("started"), F.max("ts").alias("ended"))
            .select(F.lit("events").alias("pipeline"), F.col("day").cast("string").alias("run_id"),
                    F.when(F.dayofmonth("day") % 7 == 3, "failed").otherwise("success")
                    .alias("status"), "started", "ended", "rows"))


_RUNS = """
, runs AS (SELECT 'events' AS pipeline, CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id,
    CASE WHEN day(CAST(ts AS DATE)) % 7 = 3 THEN 'failed' ELSE 'success' END AS status,
    min(ts) AS started, max(ts) AS ended, count(*) AS rows FROM events GROUP BY ALL)
"""
query("o1_freshness", """
SELECT event_type AS "table", max(ts) AS last_loaded_at,
  (epoch_us(TIMESTAMP '2024-01-30 12:00:00') - epoch_us(max(ts))) / 3600000000.0 AS age_hours,
  (epoch_us(TIMESTAMP '2024-01-30 12:00:00') - epoch_us(max(ts))) / 3600000000.0 > 26.0 AS is_stale
FROM events GROUP BY 1
""")(lambda c: MO.freshness(
    c.spark.read.parquet(f"{c.sf_dir}/events.parquet")
    .select(F.col("event_type").alias("table"), F.col("ts").alias("loaded_at")), RUN_AS_OF))

query("o2_volume_anomalies", _RUNS + """
SELECT *, avg(CAST(rows AS DOUBLE)) OVER w AS trailing_avg,
       coalesce(rows < 0.8 * avg(CAST(rows AS DOUBLE)) OVER w, false) AS is_anomaly
FROM runs WINDOW w AS (PARTITION BY pipeline ORDER BY run_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)
""")(lambda c: MO.volume_anomalies(_runs(c), 3, 0.2))

query("o3_failing_checks", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id,
  count(*) FILTER (WHERE value > 400) AS failing,
  count(*) FILTER (WHERE value > 300 AND value <= 400) AS warning, count(*) AS checks
FROM events GROUP BY 1
""")(lambda c: MO.failing_checks(
    c.spark.read.parquet(f"{c.sf_dir}/events.parquet").select(
        F.to_date("ts").cast("string").alias("run_id"),
        F.when(F.col("value") > 400, "fail").when(F.col("value") > 300, "warn")
        .otherwise("pass").alias("status"))))

query("o4_top_jobs", f"""
SELECT event_id AS job_id, 'user_' || CAST(user_id AS VARCHAR) AS user_email, event_type AS statement_type,
       CAST(floor(value * 100) AS BIGINT) * 10000 AS total_bytes_billed,
       date_trunc('minute', ts) AS minute
FROM events WHERE ts >= TIMESTAMP '{RUN_AS_OF}' - INTERVAL 24 HOUR AND ts <= TIMESTAMP '{RUN_AS_OF}'
ORDER BY total_bytes_billed DESC, job_id LIMIT 20
""")(lambda c: MO.top_jobs(
    c.spark.read.parquet(f"{c.sf_dir}/events.parquet").select(
        F.col("event_id").alias("job_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_email"),
        F.col("event_type").alias("statement_type"),
        (F.floor(F.col("value") * 100).cast("long") * 10000).alias("total_bytes_billed"),
        F.col("ts").alias("creation_time")), RUN_AS_OF))

query("o5_run_stats", _RUNS + """
, per AS (SELECT *, (epoch_us(ended) - epoch_us(started)) / 1000000.0 AS duration_s FROM runs)
SELECT p.*, s.runs, s.success_ratio, s.avg_duration_s FROM per p JOIN (
  SELECT pipeline, count(*) AS runs, count(*) FILTER (WHERE status = 'success') / count(*) AS success_ratio,
         avg(duration_s) AS avg_duration_s FROM per GROUP BY 1) s ON p.pipeline = s.pipeline
""")(lambda c: MO.run_stats(_runs(c)))


# ---------------------------------------------------------- reconciliation --
_KEYS = {"orders": ["order_id"], "customers": ["customer_id"], "order_items": ["order_id", "order_item_id"],
         "order_payments": ["order_id", "payment_sequential"], "sellers": ["seller_id"]}


def _faulty_loads(c):
    """Loads of five sources: exact but shuffled, with added, with lost and with altered rows, and none."""
    s = {n: getattr(c.src, n) for n in _KEYS}
    boleto = F.col("payment_type") == "boleto"
    more = s["customers"].withColumn("customer_id", F.concat("customer_id", F.lit("-copy")))
    return s, {
        "orders": s["orders"].repartition(5, "customer_id"),
        "customers": s["customers"].unionByName(more),
        "order_items": s["order_items"].where("NOT coalesce(price < 20000, false)"),
        "order_payments": s["order_payments"].withColumn(
            "payment_value", F.when(boleto, F.col("payment_value") + 1).otherwise(F.col("payment_value")))}


query("s10_reconcile_rows", """
SELECT 'orders' AS "table", count(*) AS src_n, count(*) AS tgt_n, CAST(0 AS BIGINT) AS missing_keys,
       CAST(0 AS BIGINT) AS extra_keys, CAST(0 AS BIGINT) AS changed_keys, 'exact' AS status FROM b_orders
UNION ALL SELECT 'customers', count(*), 2 * count(*), 0, count(DISTINCT customer_id), 0, 'appended' FROM b_customers
UNION ALL
SELECT 'order_items', CAST(sum(n) AS BIGINT), CAST(sum(k) AS BIGINT), count(*) FILTER (WHERE k = 0), 0, count(*) FILTER (WHERE k BETWEEN 1 AND n - 1),
       CASE WHEN count(*) FILTER (WHERE k BETWEEN 1 AND n - 1) > 0 THEN 'changed'
            WHEN count(*) FILTER (WHERE k = 0) > 0 THEN 'missing' ELSE 'exact' END
FROM (SELECT order_id, order_item_id, count(*) AS n, count(*) FILTER (WHERE NOT coalesce(price < 20000, false)) AS k
      FROM b_items GROUP BY 1, 2)
UNION ALL
SELECT 'order_payments', CAST(sum(n) AS BIGINT), CAST(sum(n) AS BIGINT), 0, 0, count(*) FILTER (WHERE b > 0), 'changed'
FROM (SELECT order_id, payment_sequential, count(*) AS n,
             count(*) FILTER (WHERE payment_type = 'boleto' AND payment_value IS NOT NULL) AS b FROM b_payments GROUP BY 1, 2)
UNION ALL SELECT 'sellers', count(*), 0, count(DISTINCT seller_id), 0, 0, 'missing' FROM b_sellers
""")(lambda c: reconcile.reconcile_rows(*_faulty_loads(c), _KEYS))
query("s10_changed_rows", """
SELECT order_id, payment_sequential, 'changed' AS kind, count(*) AS source_rows, count(*) AS loaded_rows
FROM b_payments GROUP BY 1, 2
HAVING count(*) FILTER (WHERE payment_type = 'boleto' AND payment_value IS NOT NULL) > 0
""")(lambda c: (lambda s, t: reconcile.differing_rows(
    s["order_payments"], t["order_payments"], _KEYS["order_payments"]))(*_faulty_loads(c)))
