"""Business SQL and notebook analyses.

Star joins use the *current* dimension versions (D2) and one review per
order (D3), so item-grain sums are never inflated by review versions.
Averages of money are exact decimal sums over counts; averages of float
ratios are rounded to 9 decimals so results do not depend on summation order.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporium.functions import expr as X
from emporium.operators import gold as G
from emporium.operators import orders as O
from emporium.operators.windows import running_sum
from emporium.operators.metrics import attach_scalar, share, top_k

PERSON = "customer_unique_id"


def _cnt() -> Column:
    return F.count(F.lit(1))


def avg_money(c: str) -> Column:
    """Exact average of a 2-decimal money column."""
    return X.safe_div(X.money_sum(c), F.count(c))


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def delivered(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("order_status") == "delivered")


def _one_review(dim_reviews: DataFrame) -> DataFrame:
    return G.current_review_per_order(dim_reviews).withColumnRenamed("order_id", "id")


def _product_category(dim_products: DataFrame) -> DataFrame:
    return G.current(dim_products).select("product_id", "product_category")


# ------------------------------------------------------------ A21 – A27 ----
def biz_monthly_revenue(fact: DataFrame) -> DataFrame:
    """Monthly revenue trend of delivered orders."""
    f = delivered(fact).filter(F.col("order_purchase_timestamp").isNotNull())
    return (f.groupBy(X.month("order_purchase_timestamp").alias("month")).agg(
        F.count_distinct("id").alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        X.money_sum("price").alias("gross_revenue"),
        X.money_sum("freight_value").alias("total_freight"),
        X.money_sum(F.col("price") + F.col("freight_value")).alias("total_revenue"),
        avg_money("price").alias("avg_order_value")))


def biz_sellers(fact: DataFrame, dim_sellers: DataFrame, dim_reviews: DataFrame) -> DataFrame:
    """Seller ranking with delivery quality."""
    s = dim_sellers.select(F.col("id").alias("seller_id"), "seller_state", "seller_city")
    f = (delivered(fact).join(s, "seller_id", "left").join(_one_review(dim_reviews), "id", "left"))
    return (f.groupBy("seller_id", "seller_state", "seller_city").agg(
        F.count_distinct("id").alias("total_orders"),
        X.money_sum("price").alias("total_revenue"),
        avg_money("price").alias("avg_order_value"),
        F.avg("review_score").alias("avg_review_score"),
        count_if(F.col("is_long_delivery")).alias("long_delivery_count"),
        count_if(F.col("has_invalid_delivery_date")).alias("invalid_delivery_count")))


def biz_categories(fact: DataFrame, dim_products: DataFrame, dim_reviews: DataFrame) -> DataFrame:
    """Category performance incl. freight as % of price."""
    f = (delivered(fact).join(_product_category(dim_products), "product_id", "left")
         .join(_one_review(dim_reviews), "id", "left"))
    return (f.groupBy("product_category").agg(
        F.count_distinct("id").alias("total_orders"),
        X.money_sum("price").alias("total_revenue"),
        avg_money("price").alias("avg_price"),
        avg_money("freight_value").alias("avg_freight"),
        F.avg("review_score").alias("avg_review_score"),
        count_if(F.col("is_long_delivery")).alias("long_deliveries"),
        F.round(F.avg(X.safe_div(F.col("freight_value"), F.col("price"))) * 100, 9)
        .alias("freight_pct_of_price")))


def biz_payments(fact: DataFrame) -> DataFrame:
    """Payment behaviour by type × installments."""
    f = delivered(fact).filter(F.col("payment_type") != "not_defined")
    return (f.groupBy("payment_type", "payment_installments").agg(
        F.count_distinct("id").alias("total_orders"),
        X.money_sum("price").alias("total_revenue"),
        avg_money("price").alias("avg_order_value"),
        avg_money("payment_value").alias("avg_payment_value")))


def biz_sla(fact: DataFrame, dim_sellers: DataFrame) -> DataFrame:
    """Delivery SLA by seller state (whole 24 h days)."""
    s = dim_sellers.select(F.col("id").alias("seller_id"), "seller_state")
    f = (delivered(fact).filter(F.col("order_delivered_customer_date").isNotNull())
         .join(s, "seller_id", "left"))
    return (f.groupBy("seller_state").agg(
        F.count_distinct("id").alias("total_orders"),
        F.avg(X.days_between("order_purchase_timestamp", "order_delivered_customer_date",
                             "whole")).alias("avg_delivery_days"),
        F.avg(X.days_between("order_delivered_customer_date", "order_estimated_delivery_date",
                             "whole")).alias("avg_days_vs_estimate"),
        count_if(F.col("is_long_delivery")).alias("long_deliveries"),
        count_if(F.col("is_overdue_delivery")).alias("overdue_deliveries"),
        (count_if(F.col("is_overdue_delivery")) / _cnt() * 100).alias("overdue_rate_pct")))


def biz_geo(fact: DataFrame, dim_customers: DataFrame, dim_reviews: DataFrame,
            customer_col: str = PERSON) -> DataFrame:
    """Revenue by customer state and orders per customer (person by default)."""
    c = dim_customers.select(F.col("id").alias("customer_id"), "customer_state",
                             F.col(customer_col).alias("_who") if customer_col != "customer_id"
                             else F.col("id").alias("_who"))
    f = (delivered(fact).join(c, "customer_id", "left")
         .join(_one_review(dim_reviews), "id", "left"))
    return (f.groupBy("customer_state").agg(
        F.count_distinct("_who").alias("unique_customers"),
        F.count_distinct("id").alias("total_orders"),
        X.money_sum("price").alias("total_revenue"),
        avg_money("price").alias("avg_order_value"),
        F.avg("review_score").alias("avg_satisfaction"))
        .withColumn("orders_per_customer",
                    X.safe_div(F.col("total_orders"), F.col("unique_customers"))))


def biz_reviews_by_category(fact: DataFrame, dim_products: DataFrame,
                            dim_reviews: DataFrame) -> DataFrame:
    """Review score vs category."""
    f = (fact.join(_product_category(dim_products), "product_id", "left")
         .join(_one_review(dim_reviews), "id", "inner"))
    return (f.groupBy("product_category", "review_score").agg(
        F.count_distinct("id").alias("total_orders"),
        avg_money("price").alias("avg_price"),
        F.avg(X.days_between("order_purchase_timestamp", "order_delivered_customer_date",
                             "whole")).alias("avg_delivery_days"),
        avg_money("freight_value").alias("avg_freight")))


# ------------------------------------------------------------ A28 – A35 ----
def repeat_customer_rate(fact: DataFrame, dim_customers: DataFrame,
                         person: str = PERSON) -> DataFrame:
    """Persons with more than one order over all persons (orders ⋈ customers)."""
    c = dim_customers.select(F.col("id").alias("customer_id"), person)
    per = (fact.select("id", "customer_id").distinct().join(c, "customer_id", "inner")
           .filter(F.col(person).isNotNull()).groupBy(person).agg(_cnt().alias("n")))
    return per.agg(_cnt().alias("customers"), count_if(F.col("n") > 1).alias("repeat_customers")) \
        .withColumn("repeat_customer_rate",
                    X.safe_div(F.col("repeat_customers"), F.col("customers")))


def delivery_outcomes(fact: DataFrame, legacy: bool = False) -> DataFrame:
    """Orders by delivery outcome, with the late rate among delivered ones."""
    per = fact.groupBy("id").agg(F.max("order_delivered_customer_date").alias("dl"),
                                 F.max("order_estimated_delivery_date").alias("es"))
    g = (per.groupBy(X.delivery_outcome("dl", "es", legacy).alias("delivery_outcome"))
         .agg(_cnt().alias("orders")))
    rate = g.agg(X.safe_div(F.sum(F.when(F.col("delivery_outcome") == "late", F.col("orders"))),
                            F.sum(F.when(F.col("delivery_outcome").isin("late", "on time"),
                                         F.col("orders")))).alias("late_rate"))
    return attach_scalar(g, rate)


def review_scores(dim_reviews: DataFrame) -> DataFrame:
    """Current review distribution, share, weighted average, 1–2★ share."""
    g = (G.current(dim_reviews).filter(F.col("review_score").isNotNull())
         .groupBy("review_score").agg(_cnt().alias("reviews")))
    tot = g.agg(X.safe_div(F.sum(F.col("review_score") * F.col("reviews")),
                           F.sum("reviews")).alias("avg_score"),
                X.safe_div(F.sum(F.when(F.col("review_score") <= 2, F.col("reviews"))),
                           F.sum("reviews")).alias("low_share"))
    return attach_scalar(share(g, "reviews"), tot)


def revenue_by_purchase_type(fact: DataFrame, dim_customers: DataFrame,
                             person: str = PERSON) -> DataFrame:
    """Monthly GMV, payments, first vs repeat purchase GMV (delivered).

    ``total_revenue`` keeps the original overcount (payment per item, D5);
    ``order_revenue`` counts each order's payment once.
    """
    d = delivered(fact)
    c = dim_customers.select(F.col("id").alias("customer_id"), person)
    ranked = (d.groupBy("id").agg(F.max("customer_id").alias("customer_id"),
                                  F.max("order_purchase_timestamp").alias("purchase_ts"),
                                  F.max("payment_value").alias("order_payment"))
              .join(c, "customer_id", "left"))
    ranked = O.add_order_seq(ranked, person, "purchase_ts", "id")
    month = X.month("order_purchase_timestamp").alias("order_month")
    f = d.join(ranked.select("id", "order_seq"), "id", "left")
    pz = F.col("price").cast("decimal(18,2)")
    lines = f.groupBy(month).agg(
        X.money_sum("price").alias("total_gmv"),
        X.money_sum("payment_value").alias("total_revenue"),
        F.coalesce(F.sum(F.when(F.col("order_seq") == 1, pz).otherwise(F.lit(0))), F.lit(0))
        .cast("double").alias("gmv_first_purchase"),
        F.coalesce(F.sum(F.when(F.col("order_seq") > 1, pz).otherwise(F.lit(0))), F.lit(0))
        .cast("double").alias("gmv_repeat_purchase"))
    once = (ranked.groupBy(X.month("purchase_ts").alias("order_month"))
            .agg(X.money_sum("order_payment").alias("order_revenue")))
    return lines.join(once, "order_month", "left")


def payment_mix(fact: DataFrame) -> DataFrame:
    """GMV and order count by payment type, with GMV share (not_defined dropped)."""
    g = (fact.groupBy("payment_type").agg(X.money_sum("price").alias("total_gmv"),
                                          F.count_distinct("id").alias("order_count"))
         .filter(F.col("payment_type") != "not_defined"))
    return share(g, "total_gmv", "gmv_share")


def category_revenue(fact: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Revenue, orders and revenue per order by category."""
    f = fact.join(_product_category(dim_products), "product_id", "left")
    return (f.groupBy(F.coalesce("product_category", F.lit("unknown")).alias("product_category"))
            .agg(X.money_sum("price").alias("total_revenue"),
                 F.count_distinct("id").alias("total_orders"))
            .withColumn("avg_order_value",
                        X.safe_div(F.col("total_revenue"), F.col("total_orders"))))


def top_n_others(df: DataFrame, label: str, value: str, n: int = 10) -> DataFrame:
    """Top-n labels by value plus one 'Others' row, with shares.

    The top-n list is a bounded (n rows) broadcast; the remainder is an
    anti-join aggregate, so no global window is needed.
    """
    top = top_k(df.select(label, value), [F.col(value).desc_nulls_last(), F.col(label)], n)
    rest = (df.join(F.broadcast(top.select(label)), label, "left_anti")
            .agg(F.sum(value).alias(value)).select(F.lit("Others").alias(label), value)
            .filter(F.col(value).isNotNull()))
    out = top.unionByName(rest)
    return share(out, value).withColumn("pretty_label", X.pretty(label))


def customer_mix(fact: DataFrame, dim_customers: DataFrame, person: str = PERSON) -> DataFrame:
    """First-time vs repeat persons among delivered orders, with percentage."""
    c = dim_customers.select(F.col("id").alias("customer_id"), person)
    per = (delivered(fact).join(c, "customer_id", "left").filter(F.col(person).isNotNull())
           .groupBy(person).agg(F.count_distinct("id").alias("total_orders")))
    g = (per.groupBy(F.when(F.col("total_orders") == 1, "First-Time Customer")
                     .otherwise("Repeat Customer").alias("customer_type"))
         .agg(_cnt().alias("total_customers")))
    return share(g, "total_customers", "share").withColumn("percentage", F.col("share") * 100)


# ------------------------------------------------------------ A36 – A42 ----
def state_profile(orders_df: DataFrame) -> DataFrame:
    """Revenue, volume, delivery days, late %, freight % per state."""
    g = F.col("gmv").cast("decimal(18,2)")
    return (orders_df.groupBy("customer_state").agg(
        F.sum(g).cast("double").alias("revenue"), _cnt().alias("order_volume"),
        F.avg("delivery_days").alias("avg_delivery_days"),
        (X.safe_div(count_if(F.col("is_late")), F.count("is_late")) * 100).alias("late_pct"),
        (X.safe_div(F.sum(F.col("freight").cast("decimal(18,2)")).cast("double"),
                    F.sum(g).cast("double")) * 100).alias("freight_pct")))


def ops_summary(orders_df: DataFrame) -> DataFrame:
    """Operations KPI row reshaped to (metric, value) rows."""
    row = orders_df.agg(
        _cnt().cast("double").alias("total_orders"),
        count_if(F.col("is_delivered")).cast("double").alias("delivered_orders"),
        F.avg("delivery_days").alias("avg_delivery_days"),
        X.safe_div(count_if(F.col("days_vs_estimate") <= 0),
                   F.count("days_vs_estimate")).alias("on_time_rate"),
        X.safe_div(count_if(F.col("is_late")), F.count("is_late")).alias("late_rate"),
        F.round(F.avg(X.hours_between("purchase_ts", "approved_ts")), 9)
        .alias("avg_approval_hours"),
        (X.safe_div(F.sum(F.col("freight").cast("decimal(18,2)")).cast("double"),
                    F.sum(F.col("gmv").cast("decimal(18,2)")).cast("double")) * 100)
        .alias("freight_pct"))
    names = row.columns
    return row.unpivot([], names, "metric", "value")


def status_counts(orders_df: DataFrame) -> DataFrame:
    """Order-status distribution."""
    return orders_df.groupBy("order_status").agg(_cnt().alias("orders"))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations, long form (one aggregation)."""
    cols = list(cols)
    aggs = [F.round(F.corr(F.col(a).cast("double"), F.col(b).cast("double")), 9)
            .alias(f"{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols)]
    row = df.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                               F.col(f"{i}_{j}").alias("corr"))
                      for i, a in enumerate(cols) for j, b in enumerate(cols)])
    return row.select(F.explode(pairs).alias("p")).select("p.*")


def histogram(df: DataFrame, col: str, bins: int, lo: float, hi: float) -> DataFrame:
    """Fixed-width bins over [lo, hi]; values are clipped into range first."""
    v = X.clip(F.col(col).cast("double"), lo, hi)
    width = (hi - lo) / bins
    b = F.least(F.floor((v - F.lit(lo)) * F.lit(float(bins)) / F.lit(float(hi - lo))),
                F.lit(bins - 1)).cast("long")
    return (df.filter(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(_cnt().alias("count"))
            .withColumn("bin_lo", F.lit(lo) + F.col("bin") * F.lit(width))
            .withColumn("bin_hi", F.lit(lo) + (F.col("bin") + 1) * F.lit(width)))


def kde(df: DataFrame, col: str, bandwidth: float, lo: float, hi: float,
        grid: int = 101, bins: int = 200) -> DataFrame:
    """Gaussian density on a fixed grid, from binned counts.

    Data are first reduced to ``bins`` counts (one aggregation); each bin is
    then expanded over the fixed grid by ``explode(sequence)`` (bins × grid
    rows, independent of the data size) and summed per grid point.
    """
    h = histogram(df, col, bins, lo, hi)
    n = h.agg(F.sum("count").alias("_n"))
    step = (hi - lo) / (grid - 1)
    g = (h.withColumn("center", (F.col("bin_lo") + F.col("bin_hi")) / 2)
         .select("count", "center", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("gi"))
         .withColumn("x", F.lit(lo) + F.col("gi") * F.lit(step)))
    z = (F.col("x") - F.col("center")) / F.lit(bandwidth)
    dens = F.col("count") * F.exp(-0.5 * z * z) / F.lit((2 * 3.141592653589793) ** 0.5)
    out = g.groupBy("gi", "x").agg(F.sum(dens).alias("_s"))
    return (attach_scalar(out, n)
            .select("x", F.round(F.col("_s") / (F.col("_n") * F.lit(bandwidth)), 9)
                    .alias("density")))


def box_stats(df: DataFrame, group: str, col: str) -> DataFrame:
    """Exact quartiles, 1.5·IQR whiskers and outlier count per group.

    Rows become counts of (group, value), combined map-side.  A running sum over the
    values gives each value the ranks that it holds, and a quartile is the value at its
    rank (between two ranks: in between).  The sum is sliced, so a group with a third of
    all rows, or with many values, lies in many tasks.
    """
    counts = (df.where(F.col(col).isNotNull() & F.col(group).isNotNull())
              .groupBy(group, F.col(col).cast("double").alias("_v")).agg(_cnt().alias("_c")))
    ranked = running_sum(counts, group, ["_v"], "_c", "_upto", "n")

    def quartile(q: float) -> Column:
        at = (F.col("n") - 1) * F.lit(q)
        low, high = F.floor(at), F.ceil(at)

        def value(rank: Column) -> Column:
            return F.max(F.when((rank >= F.col("_upto") - F.col("_c")) & (rank < F.col("_upto")), F.col("_v")))
        part = F.max(at - low)
        return value(low) + (value(high) - value(low)) * part

    quartiles = ranked.groupBy(group).agg(quartile(0.25).alias("q1"), quartile(0.5).alias("median"),
                                          quartile(0.75).alias("q3"), F.max("n").alias("n"))
    q = quartiles.withColumn("iqr", F.col("q3") - F.col("q1"))
    j = ranked.drop("n").join(q, group)
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    return j.groupBy(group, "q1", "median", "q3", "n", "iqr").agg(
        F.min(F.when(F.col("_v") >= lo_f, F.col("_v"))).alias("whisker_lo"),
        F.max(F.when(F.col("_v") <= hi_f, F.col("_v"))).alias("whisker_hi"),
        F.coalesce(F.sum(F.when((F.col("_v") < lo_f) | (F.col("_v") > hi_f), F.col("_c"))), F.lit(0)).alias("outliers"))


# ------------------------------------------------------------ A43 – A48 ----
def review_delay_curve(of: DataFrame, lo: int = -30, hi: int = 30) -> DataFrame:
    """Average review per day vs estimate, plus a least-squares quadratic.

    The fit uses the per-day averages as points (power sums in one
    aggregation, 3×3 normal equations solved by Cramer's rule in columns).
    """
    pts = (of.filter(F.col("review_score").isNotNull() & F.col("days_vs_estimate").between(lo, hi))
           .groupBy(F.col("days_vs_estimate").alias("day"))
           .agg(F.avg("review_score").alias("avg_review"), _cnt().alias("orders")))
    x, y = F.col("day").cast("double"), F.col("avg_review")
    s = pts.agg(_cnt().cast("double").alias("s0"), F.sum(x).alias("s1"),
                F.sum(x * x).alias("s2"), F.sum(x * x * x).alias("s3"),
                F.sum(x * x * x * x).alias("s4"), F.sum(y).alias("t0"),
                F.sum(x * y).alias("t1"), F.sum(x * x * y).alias("t2"))
    c = {k: F.col(k) for k in ["s0", "s1", "s2", "s3", "s4", "t0", "t1", "t2"]}

    def det(a, b, cc, d, e, f, g, h, i):
        return a * (e * i - f * h) - b * (d * i - f * g) + cc * (d * h - e * g)
    m = [c["s0"], c["s1"], c["s2"], c["s1"], c["s2"], c["s3"], c["s2"], c["s3"], c["s4"]]
    dd = det(*m)
    a0 = det(c["t0"], m[1], m[2], c["t1"], m[4], m[5], c["t2"], m[7], m[8]) / dd
    a1 = det(m[0], c["t0"], m[2], m[3], c["t1"], m[5], m[6], c["t2"], m[8]) / dd
    a2 = det(m[0], m[1], c["t0"], m[3], m[4], c["t1"], m[6], m[7], c["t2"]) / dd
    coef = s.select(F.when(dd != 0, a0).alias("c0"), F.when(dd != 0, a1).alias("c1"),
                    F.when(dd != 0, a2).alias("c2"))
    out = attach_scalar(pts, coef)
    fit = F.col("c0") + F.col("c1") * x + F.col("c2") * x * x
    return out.select("day", "avg_review", "orders", F.round(fit, 6).alias("fitted"))


def delivered_base(fact: DataFrame, raw_reviews: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Clean delivered orders (valid dates) with the best review per order."""
    f = (fact.filter((F.col("order_status") == "delivered")
                     & F.col("order_delivered_customer_date").isNotNull()
                     & F.col("order_estimated_delivery_date").isNotNull()
                     & ~F.col("has_invalid_delivery_date") & ~F.col("has_missing_delivery_date"))
         .select(F.col("id").alias("order_id"), "customer_id", "order_status",
                 "order_purchase_timestamp", "order_delivered_customer_date",
                 "order_estimated_delivery_date").distinct())
    best = raw_reviews.groupBy("order_id").agg(F.max("review_score").alias("review_score"))
    c = dim_customers.select(F.col("id").alias("customer_id"), PERSON)
    return (f.join(best, "order_id", "left").join(c, "customer_id", "left")
            .withColumn("delivery_delay_days",
                        X.days_between("order_estimated_delivery_date",
                                       "order_delivered_customer_date")))


def review_by_delay_bucket(base: DataFrame) -> DataFrame:
    """Average review per six-way delay bucket."""
    return (base.filter(F.col("review_score").isNotNull())
            .groupBy(X.delay_bucket6("delivery_delay_days").alias("delay_bucket"))
            .agg(F.avg("review_score").alias("avg_review"), _cnt().alias("orders")))


def repeat_by_review(base: DataFrame, person: str = PERSON) -> DataFrame:
    """Repeat rate by the person's half-even-rounded average review."""
    per = (base.filter(F.col(person).isNotNull()).groupBy(person)
           .agg(F.avg("review_score").alias("avg_score"),
                F.count_distinct("order_id").alias("n_orders")))
    return (per.filter(F.col("avg_score").isNotNull())
            .groupBy(X.bround("avg_score").cast("long").alias("score_class"))
            .agg(_cnt().alias("customers"), count_if(F.col("n_orders") > 1).alias("repeaters"))
            .withColumn("repeat_rate", F.col("repeaters") / F.col("customers")))


def low_score_by_lateness(base: DataFrame) -> DataFrame:
    """Share of 1–2★ reviews among late vs on-time deliveries."""
    d = base.filter(F.col("review_score").isNotNull())
    return (d.groupBy((F.col("delivery_delay_days") > 0).alias("is_late"))
            .agg(_cnt().alias("orders"), count_if(F.col("review_score") <= 2).alias("low_scores"))
            .withColumn("low_share", F.col("low_scores") / F.col("orders")))


def geo_quality(base: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Average review and delay by customer state."""
    c = dim_customers.select(F.col("id").alias("customer_id"), "customer_state")
    return (base.join(c, "customer_id", "left").groupBy("customer_state")
            .agg(F.avg("review_score").alias("avg_review"),
                 F.avg("delivery_delay_days").alias("avg_delay_days"), _cnt().alias("orders")))


def sample_pairs(df: DataFrame, cols: Sequence[str], n: int, seed: int = 42,
                 key: str = "order_id") -> DataFrame:
    """Repeatable sample of n rows, ordered by a seeded hash of the key."""
    return (df.select(key, *cols).filter(F.col(key).isNotNull())
            .withColumn("_h", F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))))
            .orderBy("_h", key).limit(n).drop("_h"))
