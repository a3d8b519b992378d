"""Gold layer: the item-grain order fact and the dimensions.

Join shapes are chosen for skew: the big side of every join is the
*streamed* side of an inner or left-outer join, so AQE's skew-join split can
cut a hot order or hot customer into several tasks, and the other side is
reduced to one row per key (by aggregation, which combines map-side) before
it is shuffled.  Explicit broadcasts are only used for seed tables whose size
is fixed by definition; every data-derived dimension is left to AQE, whose
broadcast decision is a runtime size check with sort-merge beyond it.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporium.functions import expr as X
from emporium.operators import scd2, staging
from emporium.sources import binding
from emporium.sources.binding import Sources

FACT_COLUMNS = [
    "id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date", "order_item_id", "product_id", "seller_id",
    "shipping_limit_date", "price", "freight_value", "payment_sequential", "payment_type",
    "payment_installments", "payment_value",
]
FLAG_COLUMNS = [
    "has_invalid_delivery_date", "is_overdue_delivery", "is_high_value_product",
    "has_missing_delivery_date", "is_long_delivery", "has_missing_payment_info", "has_no_items",
]


def one_payment_per_order(payments: DataFrame) -> DataFrame:
    """J1/V11 fan-out control: the lowest payment sequence per order (NULLs last).

    An aggregate instead of ``row_number`` after a fan-out join: partial
    aggregation collapses a hot order map-side.
    """
    packed = F.struct(F.col("payment_sequential").isNull().alias("_n"),
                      "payment_sequential", "payment_type", "payment_installments",
                      "payment_value")
    return (payments.groupBy("order_id").agg(F.min(packed).alias("_p"))
            .select("order_id", "_p.payment_sequential", "_p.payment_type",
                    "_p.payment_installments", "_p.payment_value"))


def order_parts(orders: DataFrame, items: DataFrame, payments: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged orders, items and payments with keys and types of the gold layer."""
    o = X.require(orders.select(
        X.norm_key("order_id").alias("order_id"),
        X.norm_key("customer_id").alias("customer_id"),
        X.std_enum("order_status", "unavailable").alias("order_status"),
        X.to_ts("order_purchase_timestamp").alias("order_purchase_timestamp"),
        X.to_ts("order_approved_at").alias("order_approved_at"),
        X.to_ts("order_delivered_carrier_date").alias("order_delivered_carrier_date"),
        X.to_ts("order_delivered_customer_date").alias("order_delivered_customer_date"),
        X.to_ts("order_estimated_delivery_date").alias("order_estimated_delivery_date"),
    ), ["order_id", "customer_id"])
    i = X.require(items.select(
        X.norm_key("order_id").alias("order_id"),
        X.to_long("order_item_id").alias("order_item_id"),
        X.norm_key("product_id").alias("product_id"),
        X.norm_key("seller_id").alias("seller_id"),
        X.to_ts("shipping_limit_date").alias("shipping_limit_date"),
        X.to_double("price").alias("price"),
        X.to_double("freight_value").alias("freight_value"),
    ), ["order_id", "order_item_id", "seller_id", "product_id"])
    p = X.require(payments.select(
        X.norm_key("order_id").alias("order_id"),
        X.to_long("payment_sequential").alias("payment_sequential"),
        F.col("payment_type"),
        X.to_long("payment_installments").alias("payment_installments"),
        X.to_double("payment_value").alias("payment_value"),
    ), ["order_id"])
    return o, i, p


def plausible_money() -> dict[str, Column]:
    """An item's price and freight, null where they can't be."""
    return {"price": X.null_if("price", F.col("price") <= 0),
            "freight_value": X.null_if("freight_value", F.col("freight_value") < 0)}


def build_fact_orders(orders: DataFrame, items: DataFrame, payments: DataFrame,
                      as_of: str, high_value: float = 10000.0,
                      long_days: int = 30) -> DataFrame:
    """G1: order fact at item grain; an order without items gives one row."""
    o, i, p = order_parts(orders, items, payments)
    item_cols = ["order_item_id", "product_id", "seller_id", "shipping_limit_date",
                 "price", "freight_value"]
    # Orders with items: items stream, orders (unique per key) are the build side.
    with_items = i.join(o, "order_id", "inner")
    # Orders without items: anti join against the distinct item order ids.
    item_orders = i.select("order_id").distinct()
    no_items = o.join(item_orders, "order_id", "left_anti").select(
        "*", *[F.lit(None).cast(i.schema[c].dataType).alias(c) for c in item_cols])
    lines = with_items.unionByName(no_items)
    pay = one_payment_per_order(p)
    fact = (lines.join(pay, "order_id", "left")
            .withColumn("payment_type", X.std_enum("payment_type", "not_defined"))
            .withColumns(plausible_money())
            .withColumnRenamed("order_id", "id"))
    fact = fact.select(*FACT_COLUMNS)
    return X.quality_flags(fact, as_of, high_value, long_days)


def build_dim_customers(stg_customers: DataFrame) -> DataFrame:
    """G2 / P1."""
    return X.select_as(stg_customers, {
        "id": "customer_id", "customer_unique_id": "customer_unique_id",
        "customer_zip_code_prefix": "customer_zip_code_prefix",
        "customer_city": "customer_city", "customer_state": "customer_state"})


def build_dim_sellers(stg_sellers: DataFrame, stg_geo: DataFrame) -> DataFrame:
    """Sellers ⟕ one point per zip (stg_geo is unique per zip)."""
    g = stg_geo.select("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                       "geolocation_city", "geolocation_state")
    return (stg_sellers.join(g, F.col("seller_zip_code_prefix")
                             == F.col("geolocation_zip_code_prefix"), "left")
            .select(F.col("seller_id").alias("id"), "seller_zip_code_prefix", "seller_city",
                    "seller_state", "geolocation_lat", "geolocation_lng", "geolocation_city",
                    "geolocation_state"))


PRODUCT_ATTRS = ["product_category_name", "product_name_length", "product_description_length",
                 "product_photos_qty", "product_weight_g", "product_length_cm",
                 "product_height_cm", "product_width_cm"]


def build_dim_products(history: DataFrame, translation: DataFrame) -> DataFrame:
    """Product versions with English category and ``is_current``."""
    t = translation.select("product_category_name", "product_category_name_english")
    return (history.join(t, "product_category_name", "left")
            .select(F.col("scd_id").alias("surrogate_key"), "product_id",
                    F.col("product_category_name_english").alias("product_category"),
                    *PRODUCT_ATTRS[1:], "valid_from", "valid_to",
                    F.col("valid_to").isNull().alias("is_current")))


def build_dim_reviews(history: DataFrame) -> DataFrame:
    """Review versions with a non-null order id."""
    return (history.filter(F.col("order_id").isNotNull())
            .select(F.col("scd_id").alias("id"), "review_id", "order_id", "review_score",
                    "review_comment_title", "review_comment_message",
                    "review_answer_timestamp", "valid_from", "valid_to",
                    F.col("valid_to").isNull().alias("is_current")))


def current_reviews(stg_reviews: DataFrame) -> DataFrame:
    """Current versions of ``dim_reviews`` straight from staging.

    A review's current version carries the attributes of its latest log row
    (the staging row), opened at that row's answer time, so readers that
    only need current reviews skip the history build: one map-side-combined
    aggregate instead of the ordered history.
    """
    r = stg_reviews.filter(F.col("order_id").isNotNull())
    r = r.withColumn("valid_from", F.col("review_answer_timestamp"))
    return r.select(scd2.surrogate_key(r, ["review_id", "valid_from"]).alias("id"), "review_id",
                    "order_id", "review_score", "review_comment_title", "review_comment_message",
                    "review_answer_timestamp", "valid_from",
                    F.lit(None).cast(r.schema["valid_from"].dataType).alias("valid_to"),
                    F.lit(True).alias("is_current"))


def build_dim_geolocation(history: DataFrame) -> DataFrame:
    """Geolocation versions per zip prefix."""
    return history.select(F.col("scd_id").alias("id"), "geolocation_zip_code_prefix",
                          "geolocation_lat", "geolocation_lng", "geolocation_city",
                          "geolocation_state", "valid_from", "valid_to",
                          F.col("valid_to").isNull().alias("is_current"))


def build_dim_date(fact: DataFrame, ts_col: str = "order_purchase_timestamp") -> DataFrame:
    """One row per calendar day between the first and last fact date."""
    bounds = fact.agg(F.min(F.to_date(ts_col)).alias("lo"), F.max(F.to_date(ts_col)).alias("hi"))
    d = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))
    return d.select(
        "date", F.year("date").cast("long").alias("year"),
        F.quarter("date").cast("long").alias("quarter"),
        F.month("date").cast("long").alias("month"),
        F.dayofmonth("date").cast("long").alias("day"),
        F.dayofweek("date").cast("long").alias("day_of_week"),
        X.month("date").alias("month_start"),
        F.dayofweek("date").isin(1, 7).alias("is_weekend"))


def current(dim: DataFrame) -> DataFrame:
    """Current versions of an SCD2 dimension."""
    return dim.filter(F.col("is_current"))


def current_review_per_order(dim_reviews: DataFrame) -> DataFrame:
    """One review score per order: the best current review."""
    return (current(dim_reviews).filter(F.col("order_id").isNotNull())
            .groupBy("order_id").agg(F.max("review_score").alias("review_score")))


def orphans(child: DataFrame, parent: DataFrame, child_key: str,
            parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    keys = parent.select(F.col(parent_key).alias("_pk")).distinct()
    return (child.filter(F.col(child_key).isNotNull())
            .join(keys, F.col(child_key) == F.col("_pk"), "left_anti"))


def fill_regions(metrics: DataFrame, regions: DataFrame, key: str) -> DataFrame:
    """Every reference region, with its metrics where present."""
    return regions.join(metrics, key, "left")


# ------------------------------------------------------------ assembled --
class Gold:
    """The gold tables over bound sources, built lazily once per instance."""

    def __init__(self, src: Sources, as_of: str = binding.AS_OF_ORDERS,
                 high_value: float = binding.HIGH_VALUE):
        self.src = src
        self.as_of = as_of
        self.high_value = high_value
        self._cache: dict[str, DataFrame] = {}
        self.staged: dict[str, DataFrame] = {}  # staging views that have been written, by name

    def stage(self, name: str) -> DataFrame:
        """A staging view."""
        return self.staged[name] if name in self.staged else getattr(staging, name)(self.src)

    def _get(self, name, fn):
        if name not in self._cache:
            self._cache[name] = fn()
        return self._cache[name]

    @property
    def fact_orders(self) -> DataFrame:
        return self._get("fact", lambda: build_fact_orders(
            self.stage("stg_orders"), self.stage("stg_order_items"),
            self.stage("stg_order_payments"), self.as_of, self.high_value))

    @property
    def dim_customers(self) -> DataFrame:
        return self._get("cust", lambda: build_dim_customers(self.stage("stg_customers")))

    @property
    def dim_sellers(self) -> DataFrame:
        return self._get("sell", lambda: build_dim_sellers(
            self.stage("stg_sellers"), self.stage("stg_geolocation")))

    @property
    def reviews_history(self) -> DataFrame:
        log = self.src.order_reviews
        attrs = [c for c in log.columns if c != "review_id"]
        return self._get("rev_hist", lambda: scd2.scd2_from_log(
            log, ["review_id"], "review_answer_timestamp", attrs))

    @property
    def dim_reviews(self) -> DataFrame:
        return self._get("rev", lambda: build_dim_reviews(self.reviews_history))

    @property
    def dim_reviews_current(self) -> DataFrame:
        return self._get("rev_cur", lambda: current_reviews(self.stage("stg_order_reviews")))

    @property
    def products_history(self) -> DataFrame:
        def run():
            first = scd2.scd2_check(None, staging.stg_products(self.src, current=False),
                                    ["product_id"], PRODUCT_ATTRS, binding.PRODUCTS_V1_AT)
            return scd2.scd2_check(first, self.stage("stg_products"),
                                   ["product_id"], PRODUCT_ATTRS, binding.PRODUCTS_V2_AT)
        return self._get("prod_hist", run)

    @property
    def dim_products(self) -> DataFrame:
        return self._get("prod", lambda: build_dim_products(
            self.products_history, self.stage("stg_category_translation")))

    @property
    def geolocation_history(self) -> DataFrame:
        log = self.src.geolocation
        attrs = ["geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state"]
        return self._get("geo_hist", lambda: scd2.scd2_from_log(
            log, ["geolocation_zip_code_prefix"], "updated_at", attrs))

    @property
    def dim_geolocation(self) -> DataFrame:
        return self._get("geo", lambda: build_dim_geolocation(self.geolocation_history))
