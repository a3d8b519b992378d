"""Semantic layer (M1–M6) and the designed marts.

Datasets are DataFrames; metrics are named Spark SQL aggregate expressions;
a metric query is ``groupBy(dims).agg(metrics)`` with filters, an order and a
row limit — the limit is the feature (a chart's row cap), applied with a
top-k, never a full sort.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporium.functions import expr as X
from emporium.operators import metrics as M

# Fixed metric definitions (Spark SQL).  Money sums are exact decimal sums.
METRICS: dict[str, dict[str, str]] = {
    "v_orders": {
        "gmv_total": "CAST(SUM(CAST(gmv AS DECIMAL(18,2))) AS DOUBLE)",
        "order_count": "COUNT(DISTINCT order_id)",
        "aov": "CAST(SUM(CAST(gmv AS DECIMAL(18,2))) AS DOUBLE) / NULLIF(COUNT(DISTINCT order_id), 0)",
        "avg_review": "AVG(review_score)",
        "avg_lead_days": "AVG(delivery_days)",
        "on_time_rate": "AVG(CASE WHEN days_vs_estimate IS NULL THEN NULL "
                        "WHEN days_vs_estimate <= 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)",
        "late_rate": "AVG(CASE WHEN days_vs_estimate IS NULL THEN NULL "
                     "WHEN days_vs_estimate > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)",
        "reorder_rate": "AVG(CAST(has_subsequent_order AS BIGINT))",
        "repeat_order_share": "AVG(CAST(is_repeat_order AS BIGINT))",
    },
    "v_customers": {
        "customer_count": "COUNT(DISTINCT customer_unique_id)",
        "repeat_customer_rate": "AVG(CAST(is_repeat_customer AS BIGINT))",
        "total_monetary": "CAST(SUM(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE)",
    },
    "v_cohort_retention": {
        "avg_retention": "AVG(retention)",
    },
    "v_category": {
        "gmv_total": "CAST(SUM(CAST(gmv AS DECIMAL(18,2))) AS DOUBLE)",
        "items": "SUM(n_items)",
    },
}


def metric(dataset: str, name: str):
    """M5: the named metric as a Column."""
    return F.expr(METRICS[dataset][name]).alias(name)


def v_orders(enriched: DataFrame) -> DataFrame:
    """M1: enriched orders plus months since the person's first order."""
    return enriched.withColumn("months_since_first",
                               X.months_since("order_month", "cohort_month"))


def v_customers(enriched: DataFrame, person: str = M.PERSON) -> DataFrame:
    """M2: one row per person: state, frequency, monetary, recency, cohort, segment."""
    return _customers(enriched, person)


def _customers(enriched: DataFrame, person: str, more: Sequence[Column] = ()) -> DataFrame:
    """v_customers and the aggregates ``more``, in one pass over the orders."""
    people = M.rfm_people(enriched, person, [F.max("customer_state").alias("customer_state"),
                                             F.min("order_month").alias("cohort_month"), *more])
    known = {person, "recency", "frequency", "monetary_d", "segment", "customer_state", "cohort_month"}
    return people.select(
        person, "customer_state", "frequency",
        F.col("monetary_d").cast("double").alias("monetary"),
        F.col("recency").alias("recency_days"), "cohort_month",
        (F.col("frequency") > 1).alias("is_repeat_customer"),
        F.when(F.col("frequency") >= 5, F.lit("5+"))
        .otherwise(F.col("frequency").cast("string")).alias("orders_placed_bucket"),
        "segment", *[c for c in people.columns if c not in known])


def v_cohort(enriched: DataFrame) -> DataFrame:
    """M3: cohort retention, long form, with a label and a numeric month."""
    r = M.cohort_retention(enriched)
    return r.select("cohort_month", F.col("months_since").cast("string").alias("months_since"),
                    F.col("months_since").alias("months_since_num"),
                    F.col("customers").alias("active_customers"), "cohort_size", "retention")


def metric_query(ds: DataFrame, dataset: str, metrics: Sequence[str],
                 dims: Sequence[str] = (), filters: Sequence[str] = (),
                 order_by: str | None = None, desc: bool = True,
                 limit: int | None = None) -> DataFrame:
    """M6: metrics × dimensions × filters; a ``limit`` keeps the first rows by the
    metric ``order_by`` and is only allowed with it."""
    if limit is not None and order_by is None:
        raise ValueError("a limit needs a metric to order by")
    d = ds
    for f in filters:
        d = d.filter(F.expr(f))
    aggs = [metric(dataset, m) for m in metrics]
    return ordered(d.groupBy(*dims).agg(*aggs) if dims else d.agg(*aggs), dims, order_by, desc, limit)


def ordered(out: DataFrame, dims: Sequence[str], order_by: str | None, desc: bool, limit: int | None) -> DataFrame:
    """The first ``limit`` rows by a metric, ties by the dimensions; all rows without a limit."""
    if order_by is not None and limit is not None:
        key = F.col(order_by).desc_nulls_last() if desc else F.col(order_by).asc_nulls_last()
        return out.orderBy(key, *[F.col(x).asc_nulls_first() for x in dims]).limit(limit)
    return out


def customer_360(enriched: DataFrame, person: str = M.PERSON) -> DataFrame:
    """v_customers plus first/last purchase and lifetime average order value."""
    base = _customers(enriched, person, [F.min("purchase_ts").alias("first_purchase_ts"),
                                         F.max("purchase_ts").alias("last_purchase_ts")])
    return base.withColumn("avg_order_value", X.safe_div(F.col("monetary"), F.col("frequency")))


def monthly_revenue(category: DataFrame) -> DataFrame:
    """GMV and items by month × category."""
    return (category.groupBy("order_month", "product_category")
            .agg(F.sum(F.col("gmv").cast("decimal(18,2)")).cast("double").alias("gmv"),
                 F.sum("n_items").alias("items")))
