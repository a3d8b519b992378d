"""Dashboard metrics over the enriched order frame.

``of`` is the filtered frame (``apply_filters``), ``full`` the whole history.
Every metric is a lazy ``DataFrame → DataFrame``; distinct counts are exact.
Since ``order_id`` is unique after A1, order counts are plain ``count``.
Scalars that must reach every row (a global max, a total) are attached as
scalar subqueries (computed once, used as constants), never by a join.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporium.functions import expr as X

PERSON = "customer_unique_id"


def _cnt() -> Column:
    return F.count(F.lit(1))


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row frame (a global aggregate) to every row.

    The frame becomes one scalar subquery (``DataFrame.scalar``): Spark runs
    it once and uses the value as a constant — no join and no shuffle of
    ``df``.
    """
    cols = one_row.columns
    packed = one_row.select(F.struct(*cols).alias("__scalar_row")).scalar()
    return (df.withColumn("__scalar_row", packed)
            .select(*df.columns, *[F.col(f"__scalar_row.{c}").alias(c) for c in cols]))


def share(df: DataFrame, col: str, out: str = "share") -> DataFrame:
    """``col / sum(col)`` on an already aggregated (small) frame."""
    total = df.agg(F.sum(col).alias("_total"))
    return attach_scalar(df, total).withColumn(out, X.safe_div(F.col(col), F.col("_total"))) \
        .drop("_total")


def order_labels(df: DataFrame, col: str, labels: Sequence[str],
                 out: str = "label_order") -> DataFrame:
    """K3: ordinal of a fixed label list (ordinal map joined as a literal CASE)."""
    ordinal = F.lit(None).cast("long")
    for i, lab in enumerate(labels):
        ordinal = F.when(F.col(col) == lab, F.lit(i).cast("long")).otherwise(ordinal)
    return df.withColumn(out, ordinal)


def top_k(df: DataFrame, by: Sequence[Column], k: int) -> DataFrame:
    """K2: top-k by a total order (TakeOrderedAndProject: no full sort)."""
    return df.orderBy(*by).limit(k)


# ------------------------------------------------------------------- A2 ----
def kpis(of: DataFrame, person: str = PERSON) -> DataFrame:
    """A2 headline KPIs in one row, from one two-level aggregation.

    Per-person partial sums first (combinable map-side), then totals; the
    repeat-customer count needs the per-person order count anyway.
    """
    deliv = F.col("is_delivered") & F.col("days_vs_estimate").isNotNull()
    per = of.groupBy(person).agg(
        _cnt().alias("n"),
        F.sum(F.col("gmv").cast("decimal(18,2)")).alias("gmv"),
        F.count(F.when(deliv, 1)).alias("n_deliv"),
        F.count(F.when(deliv & (F.col("days_vs_estimate") <= 0), 1)).alias("n_ontime"),
        F.sum("review_score").alias("s_review"), F.count("review_score").alias("n_review"),
        F.sum("delivery_days").alias("s_lead"), F.count("delivery_days").alias("n_lead"))
    tot = per.agg(
        F.sum("gmv").cast("double").alias("gmv_raw"),
        F.sum("n").alias("orders"),
        F.count(person).alias("customers"),
        F.count(F.when(F.col(person).isNotNull() & (F.col("n") > 1), 1)).alias("repeat_customers"),
        F.sum("n_deliv").alias("n_deliv"), F.sum("n_ontime").alias("n_ontime"),
        F.sum("s_review").alias("s_review"), F.sum("n_review").alias("n_review"),
        F.sum("s_lead").alias("s_lead"), F.sum("n_lead").alias("n_lead"))
    months = of.agg(F.count_distinct("order_month").alias("n_months"))
    return attach_scalar(tot, months).select(
        F.coalesce("gmv_raw", F.lit(0.0)).alias("gmv"),
        F.coalesce("orders", F.lit(0)).cast("long").alias("orders"),
        F.col("customers"),
        F.coalesce(X.safe_div(F.col("gmv_raw"), F.col("orders")), F.lit(0.0)).alias("aov"),
        F.coalesce(X.safe_div(F.col("repeat_customers").cast("double"), F.col("customers")),
                   F.lit(0.0)).alias("repeat_rate"),
        X.safe_div(F.col("n_ontime").cast("double"), F.col("n_deliv")).alias("on_time_rate"),
        X.safe_div(F.col("s_review").cast("double"), F.col("n_review")).alias("avg_review"),
        X.safe_div(F.col("s_lead").cast("double"), F.col("n_lead")).alias("avg_lead_days"),
        F.col("n_months"))


# ------------------------------------------------------------- A3, A4 ----
def gmv_monthly(of: DataFrame) -> DataFrame:
    """A3: monthly new / repeat / total GMV and order count (missing class → 0)."""
    g = F.col("gmv").cast("decimal(18,2)")
    rep = F.col("is_repeat_order")
    return (of.groupBy("order_month").agg(
        F.coalesce(F.sum(F.when(~rep, g)), F.lit(0)).alias("new_d"),
        F.coalesce(F.sum(F.when(rep, g)), F.lit(0)).alias("repeat_d"),
        _cnt().alias("orders"))
        .select("order_month", F.col("new_d").cast("double").alias("new_gmv"),
                F.col("repeat_d").cast("double").alias("repeat_gmv"),
                (F.col("new_d") + F.col("repeat_d")).cast("double").alias("total_gmv"),
                "orders"))


def repeat_rate_monthly(of: DataFrame) -> DataFrame:
    """A4: share of each month's orders that are repeat orders."""
    return (of.groupBy("order_month")
            .agg(_cnt().alias("orders"),
                 F.count(F.when(F.col("is_repeat_order"), 1)).alias("repeat_orders"))
            .withColumn("repeat_order_share",
                        F.col("repeat_orders") / F.col("orders")))


# ------------------------------------------------------------------ A5 ----
def cohort_retention(full: DataFrame, person: str = PERSON) -> DataFrame:
    """A5 long form: active persons per (cohort, months since) over cohort size.

    Cohorts with no month-0 row drop out (inner join), as in the dashboard.
    Persons are deduplicated per (cohort, month) first, so both counts are
    plain counts over small groups.
    """
    d = (full.filter(F.col("cohort_month").isNotNull() & F.col("order_month").isNotNull()
                     & F.col(person).isNotNull())
         .select("cohort_month", X.months_since("order_month", "cohort_month")
                 .alias("months_since"), person).distinct())
    active = d.groupBy("cohort_month", "months_since").agg(_cnt().alias("customers"))
    sizes = (active.filter(F.col("months_since") == 0)
             .select("cohort_month", F.col("customers").alias("cohort_size")))
    return (active.join(sizes, "cohort_month", "inner")
            .withColumn("retention", F.col("customers") / F.col("cohort_size")))


def cohort_matrix(full: DataFrame, max_month: int = 11) -> DataFrame:
    """A5 matrix form: one row per cohort, columns m0..m{max_month} (fixed value list)."""
    long = cohort_retention(full).filter(F.col("months_since") <= max_month)
    wide = long.groupBy("cohort_month").pivot("months_since", list(range(max_month + 1))) \
        .agg(F.first("retention"))
    return wide.select("cohort_month", *[F.col(str(i)).alias(f"m{i}")
                                         for i in range(max_month + 1)])


# ------------------------------------------------------------------ A6 ----
def orders_per_customer(of: DataFrame, person: str = PERSON) -> DataFrame:
    """Persons by number of orders placed, tail bucketed as '5+'."""
    per = of.filter(F.col(person).isNotNull()).groupBy(person).agg(_cnt().alias("n"))
    b = F.least(F.col("n"), F.lit(5)).cast("long")
    return (per.groupBy(b.alias("orders_placed")).agg(_cnt().alias("customers"))
            .withColumn("label", F.when(F.col("orders_placed") >= 5, F.lit("5+"))
                        .otherwise(F.col("orders_placed").cast("string"))))


# -------------------------------------------------------------- A7, A8 ----
RFM_SEGMENTS = ["Champions / Loyal", "Lapsing repeat", "New / recent (one-off)",
                "Cooling one-off", "Dormant one-off"]


def rfm_people(full: DataFrame, person: str = PERSON, more: Sequence[Column] = ()) -> DataFrame:
    """A7 per person: recency vs the latest purchase in the data, frequency, monetary.

    ``more``: named aggregates that the same pass over the orders adds per person."""
    snap = full.agg(F.max("purchase_ts").alias("_snapshot"))
    per = full.filter(F.col(person).isNotNull()).groupBy(person).agg(
        F.max("purchase_ts").alias("last_ts"), _cnt().alias("frequency"),
        F.coalesce(F.sum(F.col("gmv").cast("decimal(18,2)")), F.lit(0)).alias("monetary_d"), *more)
    added = [c for c in per.columns if c not in (person, "last_ts", "frequency", "monetary_d")]
    per = attach_scalar(per, snap)
    rec = X.days_between("last_ts", "_snapshot", "floor")
    seg = (F.when((F.col("frequency") >= 2) & (F.col("recency") <= 120), RFM_SEGMENTS[0])
           .when(F.col("frequency") >= 2, RFM_SEGMENTS[1])
           .when(F.col("recency") <= 90, RFM_SEGMENTS[2])
           .when(F.col("recency") <= 240, RFM_SEGMENTS[3]).otherwise(RFM_SEGMENTS[4]))
    return (per.withColumn("recency", rec).withColumn("segment", seg)
            .select(person, "recency", "frequency", "monetary_d", "segment", *added))


def rfm(full: DataFrame, person: str = PERSON) -> DataFrame:
    """Persons and money per segment, with share of persons."""
    seg = (rfm_people(full, person).groupBy("segment")
           .agg(_cnt().alias("customers"), F.sum("monetary_d").cast("double").alias("monetary")))
    return share(seg, "customers")


def rfm_customers(fact: DataFrame, dim_customers: DataFrame, as_of: str,
                  customer_col: str = PERSON) -> DataFrame:
    """Second RFM rule set over delivered orders, clock = ``as_of``.

    ``customer_col='customer_id'`` reproduces the original grouping (one id
    per order, so frequency is always 1); the default is the person.
    """
    f = fact.filter(F.col("order_status") == "delivered")
    if customer_col != "customer_id":
        cust = dim_customers.select(F.col("id").alias("customer_id"), customer_col)
        f = f.join(cust, "customer_id", "left")
    per = f.groupBy(F.col(customer_col).alias("customer")).agg(
        F.datediff(F.lit(as_of).cast("date"), F.max(F.to_date("order_purchase_timestamp")))
        .cast("long").alias("recency_days"),
        F.count_distinct("id").alias("frequency"),
        X.money_sum("price").alias("monetary"))
    seg = (F.when((F.col("recency_days") <= 90) & (F.col("frequency") >= 3)
                  & (F.col("monetary") >= 500), "Champion")
           .when((F.col("recency_days") <= 180) & (F.col("frequency") >= 2), "Loyal")
           .when(F.col("recency_days") <= 90, "Recent")
           .when(F.col("recency_days") > 365, "Churned").otherwise("At Risk"))
    return per.withColumn("customer_segment", seg)


# ------------------------------------------------------------ A9 – A16 ----
def lead_times(of: DataFrame) -> DataFrame:
    """Non-negative delivery times (feeds histograms and box stats)."""
    return (of.filter(F.col("delivery_days").isNotNull() & (F.col("delivery_days") >= 0))
            .select("order_id", "delivery_days"))


def _delivered_known(of: DataFrame) -> DataFrame:
    return of.filter(F.col("is_delivered") & F.col("days_vs_estimate").isNotNull())


def ontime_by_state(of: DataFrame) -> DataFrame:
    """A10: late rate by customer state among delivered orders with an estimate."""
    return (_delivered_known(of).groupBy("customer_state")
            .agg(_cnt().alias("orders"), F.count(F.when(F.col("is_late"), 1)).alias("late"))
            .withColumn("late_rate", F.col("late") / F.col("orders")))


def review_distribution(of: DataFrame) -> DataFrame:
    """Orders per review score."""
    return (of.filter(F.col("review_score").isNotNull()).groupBy("review_score")
            .agg(_cnt().alias("orders")))


def review_by_delivery_bucket(of: DataFrame) -> DataFrame:
    """Average review per lateness bucket, in bucket order; empty buckets absent."""
    g = (of.filter(F.col("delivery_bucket").isNotNull() & F.col("review_score").isNotNull())
         .groupBy("delivery_bucket")
         .agg(F.avg("review_score").alias("avg_review"), _cnt().alias("orders")))
    return order_labels(g, "delivery_bucket", X.DELIVERY_BUCKETS, "bucket_order")


def late_rate_monthly(of: DataFrame) -> DataFrame:
    """Monthly late rate among delivered orders with an estimate."""
    return (_delivered_known(of).groupBy("order_month")
            .agg(_cnt().alias("orders"), F.count(F.when(F.col("is_late"), 1)).alias("late"))
            .withColumn("late_rate", F.col("late") / F.col("orders")))


def _reorder_by(full: DataFrame, bucket: str, labels: Sequence[str]) -> DataFrame:
    g = (full.filter(F.col(bucket).isNotNull()).groupBy(bucket)
         .agg(F.avg(F.col("has_subsequent_order").cast("double")).alias("reorder_rate"),
              _cnt().alias("orders")))
    return order_labels(g, bucket, labels, "bucket_order")


def reorder_by_review_bucket(full: DataFrame) -> DataFrame:
    """Share of orders followed by another order of the same person, by review."""
    return _reorder_by(full, "review_bucket", X.REVIEW_BUCKETS)


def reorder_by_delivery_bucket(full: DataFrame) -> DataFrame:
    """Same, by lateness bucket."""
    return _reorder_by(full, "delivery_bucket", X.DELIVERY_BUCKETS)


def acquisition_treadmill(of: DataFrame, person: str = PERSON) -> DataFrame:
    """Distinct new vs returning persons per month (dedupe, then count)."""
    d = (of.filter(F.col(person).isNotNull())
         .select("order_month", "is_repeat_order", person).distinct())
    return (d.groupBy("order_month")
            .agg(F.count(F.when(~F.col("is_repeat_order"), 1)).alias("new"),
                 F.count(F.when(F.col("is_repeat_order"), 1)).alias("repeat")))


# ------------------------------------------------------------ A18 – A20 ----
def top_categories(cat: DataFrame, start: str | None = None, end: str | None = None,
                   states: Sequence[str] | None = None, n: int = 12) -> DataFrame:
    """Top-n categories by GMV under the dashboard filters (tie → name)."""
    d = X.apply_filters(cat, start, end, states)
    g = d.groupBy("product_category").agg(
        F.sum(F.col("gmv").cast("decimal(18,2)")).cast("double").alias("gmv"),
        F.sum("n_items").alias("items"))
    return top_k(g, [F.col("gmv").desc_nulls_last(), F.col("product_category")], n)


def category_state_matrix(cat: DataFrame, n: int = 10, m: int = 10,
                          pivot: bool = False) -> DataFrame:
    """GMV of the top-n categories × top-m states (long form, or pivoted).

    The two top-k lists are tiny (n, m rows).  The pivoted form has a column
    ``state_1`` .. ``state_m`` for each state by falling GMV, 0 where a category sold
    nothing there; no value is read on the driver.
    """
    gmv = F.sum(F.col("gmv").cast("decimal(18,2)"))
    top_c = top_k(cat.groupBy("product_category").agg(gmv.alias("g")),
                  [F.col("g").desc_nulls_last(), F.col("product_category")], n)
    top_s = top_k(cat.filter(F.col("customer_state").isNotNull()).groupBy("customer_state")
                  .agg(gmv.alias("g")),
                  [F.col("g").desc_nulls_last(), F.col("customer_state")], m)
    d = (cat.join(F.broadcast(top_c.select("product_category")), "product_category", "left_semi")
         .join(F.broadcast(top_s.select("customer_state")), "customer_state", "left_semi"))
    long = d.groupBy("product_category", "customer_state").agg(gmv.cast("double").alias("gmv"))
    if not pivot:
        return long
    order = Window.orderBy(F.col("g").desc_nulls_last(), "customer_state")  # over m rows
    ranked = top_s.select("customer_state", F.row_number().over(order).alias("_r"))
    placed = long.join(F.broadcast(ranked), "customer_state")
    return placed.groupBy("product_category").agg(*[
        F.coalesce(F.sum(F.when(F.col("_r") == i, F.col("gmv"))), F.lit(0.0)).alias(f"state_{i}")
        for i in range(1, m + 1)])


def cac_scenario(k: DataFrame, monthly_spend: float, target_cac: float | None,
                 repeat_uplift_pp: float) -> DataFrame:
    """Unit-economics scenario from the one-row KPI frame plus assumptions."""
    months = F.greatest(F.coalesce(F.col("n_months"), F.lit(1)), F.lit(1))
    total_spend = F.lit(float(monthly_spend)) * months
    extra = F.col("customers") * (repeat_uplift_pp / 100.0)
    blended = X.safe_div(total_spend, F.col("customers"))
    cac = F.lit(float(target_cac)) if target_cac else blended
    return k.select(
        total_spend.alias("total_spend"), blended.alias("blended_cac"),
        X.safe_div(total_spend, F.col("gmv")).alias("pct_gmv_on_marketing"),
        F.col("repeat_rate"), (extra * F.col("aov")).alias("incremental_gmv"),
        extra.alias("extra_repeat_customers"), (extra * cac).alias("equiv_paid_cost"))


# ------------------------------------------------------------------ A49 ----
def headline_ratios(of: DataFrame, full: DataFrame, person: str = PERSON) -> DataFrame:
    """Repeat share of GMV, buy-once share, relative reorder gaps (one row)."""
    gm = gmv_monthly(of).agg(
        (F.sum(F.col("repeat_gmv").cast("decimal(18,2)")).cast("double")
         / F.greatest(F.sum(F.col("total_gmv").cast("decimal(18,2)")).cast("double"),
                      F.lit(1.0))).alias("repeat_gmv_share"))
    opc = orders_per_customer(of, person).agg(
        X.safe_div(F.sum(F.when(F.col("orders_placed") == 1, F.col("customers"))).cast("double"),
                   F.sum("customers")).alias("buy_once_share"))

    def gap(df: DataFrame, n_labels: int, name: str, invert: bool) -> DataFrame:
        order, rate = F.col("bucket_order"), F.col("reorder_rate")
        known = order.isNotNull()
        first = -F.min(F.when(known, F.struct(order, rate.isNull(), (-rate).alias("rate"))))["rate"]
        last = F.max(F.when(known, F.struct(order, rate)))["reorder_rate"]
        ratio = X.safe_div(last, first)
        val = (F.lit(1.0) - ratio) if invert else (ratio - F.lit(1.0))
        return df.agg(F.when(_cnt() >= 2, val).otherwise(F.lit(0.0)).alias(name))

    rev = gap(reorder_by_review_bucket(full), 3, "review_reorder_gap", False)
    dlv = gap(reorder_by_delivery_bucket(full), 4, "delivery_reorder_gap", True)
    return attach_scalar(attach_scalar(attach_scalar(gm, opc), rev), dlv)
