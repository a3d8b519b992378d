"""Bind the driver's TPC-H-style test tables to the nine commerce source tables.

Every rule is integer arithmetic on keys so the Spark frames and the DuckDB
oracle (``emporium.plans.oracle``) produce identical rows.  All frames are
lazy scans: Catalyst prunes the columns and pushes filters to parquet.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the binding (FIXTURES.md §2).
AS_OF_ORDERS = "2001-08-01 00:00:00"      # clock for order data
AS_OF_EVENTS = "2024-02-01 00:00:00"      # clock for event data
HIGH_VALUE = 100000.0                      # high-value threshold for the test tables
GEO_BASE = "2024-01-01 00:00:00"          # base of geolocation load stamps
PRODUCTS_V1_AT = "2024-01-01 00:00:00"    # first product load
PRODUCTS_V2_AT = "2024-01-15 00:00:00"    # second product load (weight change)

# Category translation seed; 'promo' deliberately absent (tests 'unknown').
CATEGORY_TRANSLATION = [
    ("economy", "budget"),
    ("standard", "standard_line"),
    ("medium", "mid_range"),
    ("large", "large_goods"),
    ("small", "small_goods"),
]


Read = Callable[[str], DataFrame]


def _ts(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def _plus_days(ts: Column, n: Column) -> Column:
    return F.timestamp_add("DAY", n, ts)


def _plus_hours(ts: Column, n: Column) -> Column:
    return F.timestamp_add("HOUR", n, ts)


def orders(read: Read) -> DataFrame:
    o = read("orders")
    key = F.col("o_orderkey")
    ts = F.col("o_orderdate")
    status = (F.when(key % 97 == 0, F.lit(None).cast("string"))
              .when(F.col("o_orderstatus") == "F", "Delivered")
              .when(F.col("o_orderstatus") == "O", "shipped")
              .when(F.col("o_orderstatus") == "P", "processing"))
    delivered = F.when(
        (F.col("o_orderstatus") == "F") & (key % 53 != 0),
        F.when(key % 211 == 0, _plus_days(ts, F.lit(-2)))
        .otherwise(_plus_days(ts, (key * 7) % 40)))
    return o.select(
        key.cast("string").alias("order_id"),
        key.cast("string").alias("customer_id"),
        status.alias("order_status"),
        ts.alias("order_purchase_timestamp"),
        _plus_hours(ts, key % 72).alias("order_approved_at"),
        _plus_days(ts, key % 5).alias("order_delivered_carrier_date"),
        delivered.alias("order_delivered_customer_date"),
        _plus_days(ts, F.col("o_custkey") % 5 + 20).alias("order_estimated_delivery_date"),
    )


def customers(read: Read) -> DataFrame:
    o = read("orders").select("o_orderkey", "o_custkey")
    c = read("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read("nation").select("n_nationkey", "n_name")
    key = F.col("o_orderkey")
    person = (F.when(key % 10 < 8, F.concat(F.lit("O"), key.cast("string")))
              .otherwise(F.concat(F.lit("C"), F.col("o_custkey").cast("string"))))
    # nation is 25 rows by definition of the schema: a fixed-size broadcast.
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(key.cast("string").alias("customer_id"),
                    person.alias("customer_unique_id"),
                    F.col("c_nationkey").cast("string").alias("customer_zip_code_prefix"),
                    F.col("c_mktsegment").alias("customer_city"),
                    F.col("n_name").alias("customer_state")))


def order_items(read: Read) -> DataFrame:
    li = read("lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("long").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.when(F.col("l_quantity") == 1, F.lit(0.0)).otherwise(F.col("l_extendedprice"))
        .alias("price"),
        F.when(F.col("l_linenumber") == 7, F.lit(-1.0)).otherwise(F.col("l_quantity"))
        .alias("freight_value"),
    )


def order_payments(read: Read) -> DataFrame:
    o = read("orders")
    key = F.col("o_orderkey")
    prio = F.substring("o_orderpriority", 1, 1)
    ptype = (F.when(prio == "1", "credit_card").when(prio == "2", "boleto")
             .when(prio == "3", "debit_card").when(prio == "5", "voucher"))
    # One row per order and sequence number: sequence 1 unless key%29=0,
    # sequence 2 when key%10=0.  Expressed as one scan + explode.
    seqs = F.filter(F.array(F.when(key % 29 != 0, F.lit(1)), F.when(key % 10 == 0, F.lit(2))),
                    lambda s: s.isNotNull())
    return (o.select(key, F.explode(seqs).alias("seq"), ptype.alias("ptype"),
                     "o_custkey", "o_totalprice")
            .select(key.cast("string").alias("order_id"),
                    F.col("seq").cast("long").alias("payment_sequential"),
                    F.col("ptype").alias("payment_type"),
                    (F.col("o_custkey") % 10 + 1).cast("long").alias("payment_installments"),
                    F.col("o_totalprice").alias("payment_value")))


def order_reviews(read: Read) -> DataFrame:
    """Two versions per review (consecutive event ids)."""
    e = read("events")
    rid = F.floor(F.col("event_id") / 2).cast("long")
    oid = F.when(rid % 10 == 9, (rid - 1) * 3).otherwise(rid * 3)
    return e.select(
        rid.cast("string").alias("review_id"),
        oid.cast("string").alias("order_id"),
        (F.floor("value").cast("long") % 5 + 1).alias("review_score"),
        F.col("event_type").alias("review_comment_title"),
        F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.col("props"))
        .alias("review_comment_message"),
        F.to_date("ts").cast("timestamp_ntz").alias("review_creation_date"),
        F.col("ts").alias("review_answer_timestamp"),
    )


def _products(read: Read, version: int) -> DataFrame:
    p = read("part")
    key = F.col("p_partkey")
    weight = F.col("p_size").cast("long") * 100
    if version == 2:
        weight = F.when(key % 5 == 0, weight + 100).otherwise(weight)
    return p.select(
        key.cast("string").alias("product_id"),
        F.lower("p_type").alias("product_category_name"),
        F.length("p_name").cast("long").alias("product_name_length"),
        F.length("p_brand").cast("long").alias("product_description_length"),
        (F.col("p_size") % 5).cast("long").alias("product_photos_qty"),
        weight.alias("product_weight_g"),
        F.col("p_size").cast("long").alias("product_length_cm"),
        (F.floor(F.col("p_size") / 2) + 1).cast("long").alias("product_height_cm"),
        (F.col("p_size") % 7 + 1).cast("long").alias("product_width_cm"),
    )


def products(read: Read) -> DataFrame:
    """First product load."""
    return _products(read, 1)


def products_update(read: Read) -> DataFrame:
    """Second product load: weight + 100 g where key % 5 = 0."""
    return _products(read, 2)


def sellers(read: Read) -> DataFrame:
    s = read("supplier")
    n = read("nation").select("n_nationkey", "n_name")
    return (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
            .select(F.col("s_suppkey").cast("string").alias("seller_id"),
                    F.col("s_nationkey").cast("string").alias("seller_zip_code_prefix"),
                    F.col("s_name").alias("seller_city"),
                    F.col("n_name").alias("seller_state")))


def geolocation(read: Read) -> DataFrame:
    """Append-only geolocation log: several versions per zip prefix."""
    s = read("supplier")
    n = read("nation").select("n_nationkey", "n_name")
    base = _ts(GEO_BASE)
    return (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
            .select(F.col("s_nationkey").cast("string").alias("geolocation_zip_code_prefix"),
                    F.col("s_acctbal").alias("geolocation_lat"),
                    (-F.col("s_acctbal")).alias("geolocation_lng"),
                    F.col("s_name").alias("geolocation_city"),
                    F.col("n_name").alias("geolocation_state"),
                    _plus_days(base, F.col("s_suppkey") % 7).alias("updated_at"),
                    _plus_hours(base, F.col("s_suppkey")).alias("batched_at")))


def category_translation(read: Read) -> DataFrame:
    """The translations of the product names that the parts have."""
    names = read("part").select(F.lower(F.split("p_type", " ")[0]).alias("w")).distinct()
    english = F.create_map(*[F.lit(x) for pair in CATEGORY_TRANSLATION for x in pair])
    return (names.withColumn("e", F.try_element_at(english, F.col("w"))).where("e is not null")
            .select(F.col("w").alias("product_category_name"),
                    F.col("e").alias("product_category_name_english")))


def spread(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as there are cores, if its scan has fewer (a few
    files of one row group): for work that costs far more than moving its rows once."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def review_texts(read: Read) -> DataFrame:
    """Free-text corpus for the text operators: documents ⟕ labels."""
    d = spread(read("documents").select("doc_id", "text", "source"))
    lab = read("labels").select("doc_id", "quality")
    score = (F.when(F.col("quality") == 1, F.lit(5)).when(F.col("quality") == 0, F.lit(1))
             .otherwise(F.col("doc_id") % 5 + 1)).cast("long")
    return (d.join(lab, "doc_id", "left")
            .select(F.col("doc_id").cast("string").alias("review_id"),
                    score.alias("review_score"),
                    F.col("source").alias("title"),
                    F.col("text").alias("message")))


class Sources:
    """The nine bronze tables plus the second product load, built lazily.

    Each driver table is opened once per instance, however many source
    tables derive from it.
    """

    _BUILDERS = {
        "orders": orders, "customers": customers, "order_items": order_items,
        "order_payments": order_payments, "order_reviews": order_reviews,
        "products": products, "products_update": products_update, "sellers": sellers,
        "geolocation": geolocation,
    }

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}
        self._reads: dict[str, DataFrame] = {}

    def read(self, table: str) -> DataFrame:
        """A driver table, opened once for this instance."""
        if table not in self._reads:
            self._reads[table] = self._spark.read.parquet(f"{self._sf_dir.rstrip('/')}/{table}.parquet")
        return self._reads[table]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._built:
            if name == "category_translation":
                self._built[name] = category_translation(self.read)
            elif name in self._BUILDERS:
                self._built[name] = self._BUILDERS[name](self.read)
            else:
                raise AttributeError(name)
        return self._built[name]


def load_sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(spark, sf_dir)
