"""Distinct persons under any filter, from mergeable exact bitmaps.

Counts of distinct persons do not add up over months or states, sets of persons do.
Persons are numbered densely, those of one first month beside each other, and every
(month, state, repeat, class of the person's order) keeps the set of its persons as
bitmaps of 32,768 numbers each.  Any filter and grouping then merges bitmaps (OR) and
counts bits; the orders are not read again and no person is shuffled.

The order class is the order's number in the person's history, up to ``CLASSES``: the
persons with at least n orders are those that have an order of class n.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.functions import expr as X
from emporium.operators.windows import seq_number
from emporium.session import scratch_path

PERSON = "customer_unique_id"
DIMS = ["order_month", "customer_state", "is_repeat_order", "order_class"]
CLASSES = 5


def numbered(enriched: DataFrame, person: str = PERSON) -> DataFrame:
    """(person, nr): dense numbers from 1 by first month, then person."""
    people = (enriched.where(F.col(person).isNotNull()).groupBy(person)
              .agg(F.min("order_month").alias("_first")).withColumn("_one", F.lit(1)))
    return seq_number(people, "_one", ["_first", person], "nr").select(person, "nr")


def bitmaps(enriched: DataFrame, person: str = PERSON) -> DataFrame:
    """(dimensions, bucket, persons): the sets of persons, written once.

    An order of a person whose first month, state and class repeat is one row before
    the numbers are joined, so a person with many orders is met a few times."""
    spark = enriched.sparkSession
    rows = (enriched.where(F.col(person).isNotNull())
            .select("order_month", "customer_state", "is_repeat_order",
                    F.least("order_seq", F.lit(CLASSES)).cast("int").alias("order_class"), person).distinct())
    placed = rows.join(numbered(enriched, person), person).select(
        *DIMS, F.bitmap_bucket_number("nr").alias("bucket"), F.bitmap_bit_position("nr").alias("bit"))
    sets = placed.groupBy(*DIMS, "bucket").agg(F.bitmap_construct_agg("bit").alias("persons"))
    path = scratch_path(spark, "person-bitmaps")
    sets.write.option("compression", "zstd").parquet(path)  # few bits of most bitmaps are set
    return spark.read.schema(sets.schema).parquet(path)


def count_persons(sets: DataFrame, by: Sequence[str] = (), where: Sequence[str] = ()) -> DataFrame:
    """(by, persons): distinct persons of the sets that meet the filters (Spark SQL)."""
    for f in where:
        sets = sets.filter(F.expr(f))
    merged = sets.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("persons")).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("persons")
    return merged.groupBy(*by).agg(total) if by else merged.agg(total)


def treadmill(sets: DataFrame, where: Sequence[str] = ()) -> DataFrame:
    """Distinct new and returning persons per month."""
    per = count_persons(sets, ["order_month", "is_repeat_order"], where)
    return per.groupBy("order_month").agg(
        F.coalesce(F.sum(F.when(~F.col("is_repeat_order"), F.col("persons"))), F.lit(0)).alias("new"),
        F.coalesce(F.sum(F.when(F.col("is_repeat_order"), F.col("persons"))), F.lit(0)).alias("repeat"))


def repeat_customer_rate(sets: DataFrame) -> DataFrame:
    """Persons with a second order over all persons."""
    per = count_persons(sets, ["order_class"])
    return per.agg(
        F.coalesce(F.sum(F.when(F.col("order_class") == 1, F.col("persons"))), F.lit(0)).alias("customers"),
        F.coalesce(F.sum(F.when(F.col("order_class") == 2, F.col("persons"))), F.lit(0)).alias("repeat_customers")
    ).withColumn("repeat_customer_rate", X.safe_div(F.col("repeat_customers"), F.col("customers")))


def orders_per_customer(sets: DataFrame) -> DataFrame:
    """Persons by number of orders, those of ``CLASSES`` or more together.

    Exactly n orders: an order of class n and none of class n + 1."""
    per = count_persons(sets, ["order_class"])
    after = per.select((F.col("order_class") - 1).alias("order_class"), F.col("persons").alias("_more"))
    n = F.col("persons") - F.coalesce("_more", F.lit(0))
    label = F.when(F.col("order_class") >= CLASSES, F.lit(f"{CLASSES}+")).otherwise(F.col("order_class").cast("string"))
    return (per.join(after, "order_class", "left")
            .select(F.col("order_class").cast("long").alias("orders_placed"), n.alias("customers"), label.alias("label"))
            .where("customers > 0"))
