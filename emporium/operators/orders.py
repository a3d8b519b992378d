"""Order-grain result sets: A1 (orders), V2–V5 (sequence, cohort), A17 (category).

``orders`` collapses the item-grain fact *before* joining the dimensions
(eager aggregation by hand: Catalyst does not push aggregates through
joins), so the star join runs on one row per order.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporium.functions import expr as X
from emporium.operators import gold as G
from emporium.operators.windows import seq_number


def orders(fact: DataFrame, dim_customers: DataFrame, dim_reviews: DataFrame) -> DataFrame:
    """A1: one row per order with customer, review and day counts.

    ANY_VALUE of the source becomes ``max`` (constant within an order, but
    deterministic even when it is not).
    """
    ordr = (fact.filter(F.col("order_purchase_timestamp").isNotNull())
            .groupBy(F.col("id").alias("order_id"))
            .agg(F.max("customer_id").alias("customer_id"),
                 F.max("order_status").alias("order_status"),
                 F.max("order_purchase_timestamp").alias("purchase_ts"),
                 F.max("order_approved_at").alias("approved_ts"),
                 F.max("order_delivered_customer_date").alias("delivered_ts"),
                 F.max("order_estimated_delivery_date").alias("estimated_ts"),
                 X.money_sum("price").alias("gmv"),
                 X.money_sum("freight_value").alias("freight"),
                 F.count(F.lit(1)).alias("n_items"),
                 F.max("payment_type").alias("payment_type"),
                 F.max("payment_installments").alias("payment_installments"),
                 F.max("payment_value").alias("payment_value")))
    return _with_dims(ordr, dim_customers, dim_reviews)


def orders_from_staging(orders: DataFrame, items: DataFrame, payments: DataFrame, dim_customers: DataFrame,
                        dim_reviews: DataFrame) -> DataFrame:
    """A1 straight from the staged tables, where the fact has not been written.

    The same rows as ``orders`` over the fact; items are added up per order before any
    join, so every join is at order grain and a hot order leaves each task as one row.
    """
    o, i, p = G.order_parts(orders, items, payments)
    per_order = (o.where(F.col("order_purchase_timestamp").isNotNull()).groupBy("order_id")
                 .agg(F.max("customer_id").alias("customer_id"), F.max("order_status").alias("order_status"),
                      F.max("order_purchase_timestamp").alias("purchase_ts"),
                      F.max("order_approved_at").alias("approved_ts"),
                      F.max("order_delivered_customer_date").alias("delivered_ts"),
                      F.max("order_estimated_delivery_date").alias("estimated_ts"),
                      F.count(F.lit(1)).alias("_k")))  # ids that differ in blanks only are one order
    money = {c: F.sum(F.col(c).cast("decimal(18,2)")).alias(c) for c in ("price", "freight_value")}
    per_item = i.withColumns(G.plausible_money()).groupBy("order_id").agg(
        money["price"], money["freight_value"], F.count(F.lit(1)).alias("_n"))
    j = per_order.join(per_item, "order_id", "left").join(G.one_payment_per_order(p), "order_id", "left")

    def total(c: str) -> Column:
        return (F.col(c) * F.col("_k")).cast("decimal(38,2)").cast("double")

    ordr = j.select("order_id", "customer_id", "order_status", "purchase_ts", "approved_ts", "delivered_ts",
                    "estimated_ts", total("price").alias("gmv"), total("freight_value").alias("freight"),
                    (F.greatest(F.coalesce("_n", F.lit(1)), F.lit(1)) * F.col("_k")).alias("n_items"),
                    X.std_enum("payment_type", "not_defined").alias("payment_type"), "payment_installments",
                    "payment_value")
    return _with_dims(ordr, dim_customers, dim_reviews)


def _with_dims(ordr: DataFrame, dim_customers: DataFrame, dim_reviews: DataFrame) -> DataFrame:
    """Orders with customer, current review and day counts."""
    cust = dim_customers.select(F.col("id").alias("customer_id"), "customer_unique_id",
                                "customer_state")
    rev = G.current_review_per_order(dim_reviews)
    o = ordr.join(cust, "customer_id", "left").join(rev, "order_id", "left")
    return o.select(
        "order_id", "order_status", "purchase_ts", X.month("purchase_ts").alias("order_month"),
        "approved_ts", "delivered_ts", "estimated_ts", "gmv", "freight", "n_items",
        "payment_type", "payment_installments", "payment_value", "customer_unique_id",
        "customer_state", "review_score",
        F.when(F.col("delivered_ts").isNotNull(),
               X.days_between("purchase_ts", "delivered_ts")).alias("delivery_days"),
        F.when(F.col("delivered_ts").isNotNull() & F.col("estimated_ts").isNotNull(),
               X.days_between("estimated_ts", "delivered_ts")).alias("days_vs_estimate"))


def add_order_seq(df: DataFrame, person: str = "customer_unique_id", ts: str = "purchase_ts",
                  tie: str = "order_id") -> DataFrame:
    """V2: 1-based order sequence per person by (ts, tie); NULL person → NULL."""
    seq = seq_number(df, person, [ts, tie], "order_seq")
    return seq.withColumn("order_seq", F.when(F.col(person).isNotNull(), F.col("order_seq")))


def enrich(orders_df: DataFrame, person: str = "customer_unique_id") -> DataFrame:
    """V2–V4 + flags + buckets, computed on the *full* history.

    The order grain is written once, in slices of (person, time, order id); the
    sequence, the person's total and the cohort month all come from the slices,
    so a person with a third of all orders is split over many tasks.  Orders
    without a person (NULL key) get none of the three, as in a pandas group-by.
    """
    out = seq_number(orders_df, person, ["purchase_ts", "order_id"], "order_seq",
                     total="cust_total_orders", key_mins={"cohort_month": "order_month"})
    known = F.col(person).isNotNull()
    out = out.withColumns({c: F.when(known, F.col(c))
                           for c in ("order_seq", "cust_total_orders", "cohort_month")})
    return out.select(
        "*",
        F.coalesce(F.col("order_seq") > 1, F.lit(False)).alias("is_repeat_order"),
        F.coalesce(F.col("order_seq") < F.col("cust_total_orders"), F.lit(False))
        .alias("has_subsequent_order"),
        F.coalesce(F.col("order_status") == "delivered", F.lit(False)).alias("is_delivered"),
        X.is_late("days_vs_estimate").alias("is_late"),
        X.delivery_bucket("days_vs_estimate").alias("delivery_bucket"),
        X.review_bucket("review_score").alias("review_bucket"))


def category(fact: DataFrame, dim_products: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Item GMV by month × customer state × category (current product version)."""
    prod = G.current(dim_products).select("product_id", "product_category")
    cust = dim_customers.select(F.col("id").alias("customer_id"), "customer_state")
    f = (fact.filter(F.col("order_purchase_timestamp").isNotNull())
         .select(X.month("order_purchase_timestamp").alias("order_month"), "customer_id",
                 "product_id", "price"))
    j = f.join(prod, "product_id", "left").join(cust, "customer_id", "left")
    return (j.groupBy("order_month", "customer_state",
                      F.coalesce("product_category", F.lit("unknown")).alias("product_category"))
            .agg(X.money_sum("price").alias("gmv"), F.count(F.lit(1)).alias("n_items")))


def best_review(df: DataFrame, key: str = "order_id", score: str = "review_score") -> DataFrame:
    """V5: one row per order, highest score first (NULLs last), as an aggregate."""
    others = [c for c in df.columns if c not in (key, score)]
    packed = F.struct(F.col(score).isNotNull().alias("_nn"), F.col(score).alias("_s"),
                      *[F.col(c) for c in others])
    return (df.groupBy(key).agg(F.max(packed).alias("_r"))
            .select(key, F.col("_r._s").alias(score), *[F.col(f"_r.{c}") for c in others]))
