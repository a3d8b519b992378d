"""Registered queries: the gold-layer test suite (C1–C15, S15) with its oracle."""
from __future__ import annotations

from collections import defaultdict

from pyspark.sql import functions as F

from emporium.operators import metrics as M
from emporium.operators import quality as Q
from emporium.plans.catalog import query
from emporium.plans.context import materialize_gold
from emporium.plans.queries_metrics import _RFM
from emporium.session import scratch_path
from emporium.sources import binding

# Fixed accepted-value lists of the gold contract.
ORDER_STATUSES = ["delivered", "shipped", "canceled", "unavailable", "invoiced", "processing",
                  "created", "approved"]
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]
HIGH_VALUE_PAYMENT = 1000.0

_REL = {"fact_orders": "fact_orders", "dim_customers": "dim_customers",
        "dim_sellers": "dim_sellers", "dim_products": "dim_products",
        "dim_reviews": "dim_reviews", "dim_geolocation": "dim_geolocation_q",
        "orders": "orders_e", "v_customers": "seg",
        "stg_customers": "s_customers", "stg_orders": "s_orders", "stg_order_items": "s_items",
        "stg_order_payments": "s_payments", "stg_order_reviews": "s_reviews", "stg_products": "s_products",
        "stg_category_translation": "b_category_translation", "stg_sellers": "s_sellers",
        "stg_geolocation": "s_geolocation"}


def _frame(c, table):
    g = c.gold
    if table.startswith("stg_"):
        return g.stage(table)
    return {"fact_orders": lambda: c.fact, "dim_customers": lambda: g.dim_customers,
            "dim_sellers": lambda: g.dim_sellers, "dim_products": lambda: g.dim_products,
            "dim_reviews": lambda: g.dim_reviews, "dim_geolocation": lambda: g.dim_geolocation,
            "orders": lambda: c.enriched}[table]()


def _status(sev: str) -> str:
    return f"CASE WHEN n_failed = 0 THEN 'pass' ELSE '{'warn' if sev == 'warn' else 'fail'}' END"


def _wrap(check, table, column, sev, inner):
    return (f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", '{column}' AS \"column\", "
            f"'{sev}' AS severity, CAST(n_rows AS BIGINT) AS n_rows, "
            f"CAST(coalesce(n_failed, 0) AS BIGINT) AS n_failed, {_status(sev)} AS status "
            f"FROM ({inner})")


def _pred_sql(check, table, column, sev, bad):
    rel = _REL[table]
    return _wrap(check, table, column, sev,
                 f"SELECT count(*) AS n_rows, count(*) FILTER (WHERE {bad}) AS n_failed FROM {rel}")


# Each spec: (name, spark builder ctx → result row, SQL)
SPECS = []


def spec(name, spark_fn, sql, pred=None):
    """``pred`` = (table, factory of a predicate Check) lets the suite fold it per table."""
    SPECS.append((name, spark_fn, sql))
    if pred is not None:
        PRED.append((name, pred[0], pred[1]))


PRED = []


def _nn(table, col, sev="error"):
    spec(f"c1_not_null_{table}_{col}", lambda c: Q.not_null(_frame(c, table), table, col, sev),
         _pred_sql("not_null", table, col, sev, f"{col} IS NULL"),
         (table, lambda: Q.Check("not_null", table, col, F.col(col).isNull(), sev)))


def _uq(table, cols, sev="error"):
    name = "unique" if len(cols) == 1 else "unique_combination"
    rel = _REL[table]
    cl = ", ".join(cols)
    nonnull = " AND ".join(f"{x} IS NOT NULL" for x in cols)
    inner = (f"SELECT sum(n) AS n_rows, count(*) FILTER (WHERE {nonnull} AND n > 1) AS n_failed "
             f"FROM (SELECT {cl}, count(*) AS n FROM {rel} GROUP BY {cl})")
    spec(f"c{2 if len(cols) == 1 else 3}_{name}_{table}_{'_'.join(cols)}",
         lambda c: Q.unique(_frame(c, table), table, cols, sev),
         _wrap(name, table, ",".join(cols), sev, inner))


def _acc(table, col, values, sev="error"):
    vals = ", ".join(f"'{v}'" for v in values)
    spec(f"c4_accepted_{table}_{col}", lambda c: Q.accepted(_frame(c, table), table, col, values, sev),
         _pred_sql("accepted_values", table, col, sev, f"{col} IS NOT NULL AND {col} NOT IN ({vals})"),
         (table, lambda: Q.Check("accepted_values", table, col,
                                 F.col(col).isNotNull() & ~F.col(col).isin(list(values)), sev)))


def _rel(table, col, parent, pcol, sev="error"):
    inner = (f"SELECT count(*) AS n_rows, count(*) FILTER (WHERE ck IS NOT NULL AND pk IS NULL) AS n_failed "
             f"FROM (SELECT {col} AS ck FROM {_REL[table]}) c "
             f"LEFT JOIN (SELECT DISTINCT {pcol} AS pk FROM {_REL[parent]}) p ON c.ck = p.pk")
    spec(f"c5_relationship_{table}_{col}",
         lambda c: Q.relationship(_frame(c, table), _frame(c, parent), table, col, pcol, sev),
         _wrap("relationships", table, col, sev, inner))


_SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
              "timestamp_ntz": "TIMESTAMP"}


def _type(table, col, type_name, sev="error"):
    spec(f"c6_type_{table}_{col}", lambda c: Q.has_type(_frame(c, table), table, col, type_name, sev),
         _pred_sql(f"type_{type_name}", table, col, sev, f"typeof({col}) <> '{_SQL_TYPES[type_name]}'"),
         (table, lambda: Q.type_check(table, col, type_name, sev)))


# ---- the suite (gold contract + expectation tests + singular tests) -------
for t, col in [("fact_orders", "id"), ("fact_orders", "customer_id"),
               ("fact_orders", "order_status"), ("dim_customers", "id"),
               ("dim_customers", "customer_unique_id"), ("dim_sellers", "id"),
               ("dim_products", "surrogate_key"), ("dim_products", "product_id"),
               ("dim_reviews", "id"), ("dim_reviews", "order_id"), ("dim_geolocation", "id"),
               ("stg_order_items", "order_id"), ("stg_order_items", "order_item_id"),
               ("stg_order_payments", "order_id"), ("stg_order_payments", "payment_sequential")]:
    _nn(t, col)
for t, cols in [("dim_customers", ["id"]), ("dim_sellers", ["id"]),
                ("dim_products", ["surrogate_key"]), ("dim_reviews", ["id"]),
                ("dim_geolocation", ["id"]), ("fact_orders", ["id", "order_item_id"])]:
    _uq(t, cols)
_nn("fact_orders", "payment_type", "warn")  # orders without a payment exist in the test tables
for t, col in [("stg_customers", "customer_id"), ("stg_orders", "order_id"), ("stg_order_reviews", "review_id"),
               ("stg_products", "product_id"), ("stg_category_translation", "product_category_name"),
               ("stg_sellers", "seller_id"), ("stg_geolocation", "geolocation_zip_code_prefix")]:
    _nn(t, col)
    _uq(t, [col])
_uq("fact_orders", ["id"], "warn")  # fails by design at item grain: shows a warn row
_acc("fact_orders", "order_status", ORDER_STATUSES)
_acc("fact_orders", "payment_type", PAYMENT_TYPES)
_rel("fact_orders", "customer_id", "dim_customers", "id")
_rel("fact_orders", "product_id", "dim_products", "product_id", "warn")
_rel("fact_orders", "seller_id", "dim_sellers", "id", "warn")
_rel("dim_reviews", "order_id", "fact_orders", "id", "warn")
_rel("fact_orders", "id", "dim_reviews", "order_id", "warn")
for t in ("dim_customers", "dim_sellers", "dim_reviews", "dim_geolocation", "fact_orders"):
    _type(t, "id", "string")
_type("dim_products", "surrogate_key", "string")
_type("dim_reviews", "review_score", "bigint")
_type("fact_orders", "customer_id", "string")
for col in ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date", "shipping_limit_date"):
    _type("fact_orders", col, "timestamp_ntz")
for col in ("order_item_id", "payment_sequential", "payment_installments"):
    _type("fact_orders", col, "bigint")
for col in ("price", "freight_value", "payment_value"):
    _type("fact_orders", col, "double")
_type("fact_orders", "has_no_items", "boolean")

spec("c7_between_fact_price", lambda c: Q.between(c.fact, "fact_orders", "price", lo=0, severity="warn"),
     _pred_sql("between", "fact_orders", "price", "warn", "coalesce(price < 0, false)"),
     ("fact_orders", lambda: Q.Check("between", "fact_orders", "price",
                                     F.coalesce(F.col("price") < 0, F.lit(False)), "warn")))
spec("c7_between_review_score",
     lambda c: Q.between(c.gold.dim_reviews, "dim_reviews", "review_score", 1, 5),
     _pred_sql("between", "dim_reviews", "review_score", "error",
               "coalesce(review_score < 1 OR review_score > 5, false)"),
     ("dim_reviews", lambda: Q.Check("between", "dim_reviews", "review_score", F.coalesce(
         (F.col("review_score") < 1) | (F.col("review_score") > 5), F.lit(False)))))
spec("c7_between_payment_value",
     lambda c: Q.between(c.fact, "fact_orders", "payment_value", lo=0,
                         where=F.col("payment_value").isNotNull(), severity="warn"),
     _pred_sql("between", "fact_orders", "payment_value", "warn",
               "coalesce(payment_value < 0, false) AND coalesce(payment_value IS NOT NULL, false)"),
     ("fact_orders", lambda: Q.Check("between", "fact_orders", "payment_value",
                                     F.coalesce(F.col("payment_value") < 0, F.lit(False))
                                     & F.col("payment_value").isNotNull(), "warn")))
spec("c8_pair_delivered_after_purchase",
     lambda c: Q.pair_greater(c.fact, "fact_orders", "order_delivered_customer_date",
                              "order_purchase_timestamp", False,
                              F.col("order_delivered_customer_date").isNotNull(), "warn"),
     _pred_sql("pair_greater", "fact_orders", "order_delivered_customer_date,order_purchase_timestamp",
               "warn", "NOT coalesce(order_delivered_customer_date > order_purchase_timestamp, false) "
                       "AND coalesce(order_delivered_customer_date IS NOT NULL, false)"),
     ("fact_orders", lambda: Q.Check(
         "pair_greater", "fact_orders", "order_delivered_customer_date,order_purchase_timestamp",
         ~F.coalesce(F.col("order_delivered_customer_date") > F.col("order_purchase_timestamp"),
                     F.lit(False)) & F.col("order_delivered_customer_date").isNotNull(), "warn")))
spec("c9_delivered_have_date",
     lambda c: Q.assert_empty(c.fact, "delivered_have_delivery_date", "fact_orders",
                              (F.col("order_status") == "delivered")
                              & F.col("order_delivered_customer_date").isNull()),
     _pred_sql("delivered_have_delivery_date", "fact_orders", "", "error",
               "order_status = 'delivered' AND order_delivered_customer_date IS NULL"),
     ("fact_orders", lambda: Q.Check("delivered_have_delivery_date", "fact_orders", "",
                                     (F.col("order_status") == "delivered")
                                     & F.col("order_delivered_customer_date").isNull())))
spec("c10_no_future_purchase",
     lambda c: Q.assert_empty(c.fact, "no_future_purchase", "fact_orders",
                              F.col("order_purchase_timestamp")
                              > F.lit(binding.AS_OF_ORDERS).cast("timestamp_ntz")),
     _pred_sql("no_future_purchase", "fact_orders", "", "error",
               f"order_purchase_timestamp > TIMESTAMP '{binding.AS_OF_ORDERS}'"),
     ("fact_orders", lambda: Q.Check("no_future_purchase", "fact_orders", "",
                                     F.col("order_purchase_timestamp")
                                     > F.lit(binding.AS_OF_ORDERS).cast("timestamp_ntz"))))
spec("c11_high_value_has_payment",
     lambda c: Q.assert_empty(c.fact, "high_value_has_payment", "fact_orders",
                              (F.col("price") > HIGH_VALUE_PAYMENT)
                              & F.col("has_missing_payment_info")),
     _pred_sql("high_value_has_payment", "fact_orders", "", "error",
               f"price > {HIGH_VALUE_PAYMENT} AND has_missing_payment_info"),
     ("fact_orders", lambda: Q.Check("high_value_has_payment", "fact_orders", "",
                                     (F.col("price") > HIGH_VALUE_PAYMENT)
                                     & F.col("has_missing_payment_info"))))
spec("c12_reconcile_gmv",
     lambda c: Q.reconcile(c.orders, "gmv", c.fact.filter(F.col("order_purchase_timestamp").isNotNull()),
                           "price", "orders_vs_fact"),
     _wrap("reconcile", "orders_vs_fact", "gmv=price", "error",
           "SELECT 1 AS n_rows, CASE WHEN abs(coalesce((SELECT sum(CAST(gmv AS DECIMAL(18,2))) FROM orders_o), 0)"
           " - coalesce((SELECT sum(CAST(price AS DECIMAL(18,2))) FROM fact_orders "
           "WHERE order_purchase_timestamp IS NOT NULL), 0)) > 0.01 THEN 1 ELSE 0 END AS n_failed"))
spec("c13_non_negative_lead_time",
     lambda c: Q.assert_empty(c.enriched, "non_negative_lead_time", "orders",
                              F.col("delivery_days") < 0, "warn"),
     _pred_sql("non_negative_lead_time", "orders", "", "warn", "delivery_days < 0"),
     ("orders", lambda: Q.Check("non_negative_lead_time", "orders", "",
                                F.col("delivery_days") < 0, "warn")))
spec("c13_one_segment_per_customer",
     lambda c: Q.unique(M.rfm_people(c.enriched), "v_customers", "customer_unique_id"),
     _wrap("unique", "v_customers", "customer_unique_id", "error",
           "SELECT sum(n) AS n_rows, count(*) FILTER (WHERE n > 1) AS n_failed "
           "FROM (SELECT customer_unique_id, count(segment) AS n FROM seg GROUP BY 1)"))

PROFILE_COLS = ["gmv", "freight", "review_score", "delivery_days"]
_BOUNDS = {"review_score": ["NOT (round(avg(CAST(review_score AS DOUBLE)), 9) BETWEEN 1.0 AND 5.0)",
                            "min(review_score) < 1.0", "max(review_score) > 5.0"],
           "freight": ["min(freight) < 0.0", "max(freight) > 1000000.0"]}


def _envelope(profile):
    return Q.envelope(profile, "orders", 0.9, {"review_score": (1.0, 5.0)},
                      ranges={"review_score": (1.0, 5.0), "freight": (0.0, 1e6)})


spec("c14_envelope_orders",
     lambda c: _envelope(Q.profile(c.enriched.filter(F.col("purchase_ts") < F.lit(
         binding.AS_OF_ORDERS).cast("timestamp_ntz")), PROFILE_COLS)),
     _wrap("envelope", "orders", "*", "warn",
           "SELECT 4 AS n_rows, " + " + ".join(
               "CASE WHEN coalesce(" + " OR ".join([f"1 - count({col}) / count(*) > 0.9", *_BOUNDS.get(col, [])])
               + ", true) THEN 1 ELSE 0 END" for col in PROFILE_COLS)
           + f" AS n_failed FROM orders_e WHERE purchase_ts < TIMESTAMP '{binding.AS_OF_ORDERS}'"))

_GEO_Q = """, dim_geolocation_q AS (SELECT md5(concat_ws('␟', geolocation_zip_code_prefix,
    CAST(epoch_us(valid_from) AS VARCHAR))) AS id FROM (
  SELECT geolocation_zip_code_prefix, updated_at AS valid_from FROM (
    SELECT *, (lag(1) OVER w) IS NULL AS _first,
      (geolocation_lat IS NOT DISTINCT FROM lag(geolocation_lat) OVER w
       AND geolocation_lng IS NOT DISTINCT FROM lag(geolocation_lng) OVER w
       AND geolocation_city IS NOT DISTINCT FROM lag(geolocation_city) OVER w
       AND geolocation_state IS NOT DISTINCT FROM lag(geolocation_state) OVER w) AS _same
    FROM b_geolocation
    WINDOW w AS (PARTITION BY geolocation_zip_code_prefix ORDER BY updated_at NULLS FIRST,
      geolocation_lat NULLS FIRST, geolocation_lng NULLS FIRST, geolocation_city NULLS FIRST,
      geolocation_state NULLS FIRST, batched_at NULLS FIRST))
  WHERE _first OR NOT _same))
"""

for _name, _fn, _sql in SPECS:
    query(_name, (_GEO_Q if "dim_geolocation_q" in _sql else "") + (_RFM if "FROM seg" in _sql else "") + _sql)(_fn)


#: Checks that the writes of the suite's tables measure beside their row predicates.
_BY_WRITE = {"c12_reconcile_gmv", "c14_envelope_orders"}


def _c15(c):
    """Row predicates, totals and profile are measured by the writes of the tables;
    keys and relationships are then counted over the written ones, in one job."""
    by_table = defaultdict(list)
    for _, table, make in PRED:
        by_table[table].append(make())
    before = F.col("purchase_ts") < F.lit(binding.AS_OF_ORDERS).cast("timestamp_ntz")
    watches = {t: Q.Watch(t, checks) for t, checks in by_table.items()}
    watches["orders"] = Q.Watch("orders", by_table["orders"], PROFILE_COLS, before)
    watches["orders_grain"] = Q.Watch("orders_grain", totals={"gmv": F.col("gmv")})
    watches["fact_orders"] = Q.Watch("fact_orders", by_table["fact_orders"], totals={
        "price": F.when(F.col("order_purchase_timestamp").isNotNull(), F.col("price"))})
    c = materialize_gold(c, scratch_path(c.spark, "gold"), {t: w.on for t, w in watches.items()})
    parts = [w.report(c.spark) for w in watches.values() if w.checks]
    parts.append(Q.reconciled(c.spark, watches["orders_grain"].total("gmv"), watches["fact_orders"].total("price"),
                              "orders_vs_fact", "gmv=price"))
    parts.append(_envelope(watches["orders"].profiled(c.spark)))
    done = {name for name, _, _ in PRED} | _BY_WRITE
    parts += [fn(c) for name, fn, _ in SPECS if name not in done]
    return Q.run_suite(parts)


query("c15_run_suite", _GEO_Q + _RFM + " UNION ALL ".join(f"({s})" for _, _, s in SPECS))(_c15)

query("c14_profile_orders", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{col}' AS \"column\", 1 - count({col}) / count(*) AS null_rate, "
    f"CAST(min({col}) AS DOUBLE) AS min, CAST(max({col}) AS DOUBLE) AS max, "
    f"round(avg(CAST({col} AS DOUBLE)), 9) AS mean FROM orders_e" for col in PROFILE_COLS) + ")")(
    lambda c: Q.profile(c.enriched, PROFILE_COLS))

query("s15_failing_rows_unique_fact_id", """
SELECT id, count(*) AS n FROM fact_orders GROUP BY 1 HAVING count(*) > 1
""")(lambda c: Q.store_failures(Q.unique_failures(c.fact, ["id"]), scratch_path(c.spark, "audit"), "unique_fact_id"))
query("s15_failing_rows_delivered_before_purchase", """
SELECT * FROM fact_orders WHERE NOT coalesce(order_delivered_customer_date > order_purchase_timestamp, false)
  AND order_delivered_customer_date IS NOT NULL
""")(lambda c: Q.store_failures(Q.Check("pair_greater", "fact_orders", "", ~F.coalesce(
    F.col("order_delivered_customer_date") > F.col("order_purchase_timestamp"), F.lit(False))
    & F.col("order_delivered_customer_date").isNotNull()).failures(c.fact),
    scratch_path(c.spark, "audit"), "delivered_before_purchase"))
