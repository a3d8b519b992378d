"""Numbering and neighbours within a key without a hot-key window (V2, V9).

``row_number().over(partitionBy(key).orderBy(...))`` sends every row of a key to
one task.  Here the rows are range-partitioned by (key, order) and written, so
that a key holding a third of all rows lies in many slices, also when all its
rows bear one time stamp (the tie columns split it).  A window over (slice, key)
numbers each slice in its own task.  Only a key that runs on from one slice into
the next needs more, and of those there is at most one between two slices: their
totals are a table of at most two rows a slice, which is broadcast.

Null keys and null order values are ordinary values and come first.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporium.session import scratch_path, shuffle_partitions

SLICE = "_slice"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _asc(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in cols]


def sliced(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` in slices of the order of (key, order), written once: column ``_slice``."""
    spark = df.sparkSession
    n = shuffle_partitions(spark)
    path = scratch_path(spark, "slices")
    (df.repartitionByRange(n, *_asc([*_keys(key), *order]))
     .withColumn(SLICE, F.spark_partition_id()).write.parquet(path))
    schema = T.StructType([*df.schema.fields, T.StructField(SLICE, T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


def _match(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_b_{c}"]) for c in cols])


def _spans(df: DataFrame, keys: list[str], aggs: list[Column], over: list[Column]) -> DataFrame:
    """Per slice of a key that lies in several slices, ``aggs`` of its rows there and
    then ``over`` them; at most two rows a slice.  Key columns get the prefix ``_b_``."""
    ends = df.groupBy(SLICE).agg(F.min(F.struct(*keys)).alias("a"), F.max(F.struct(*keys)).alias("b"))
    edge = (ends.select(SLICE, F.explode(F.array_distinct(F.array("a", "b"))).alias("k"))
            .select(F.col(SLICE).alias(f"_b_{SLICE}"), *[F.col(f"k.{k}").alias(f"_b_{k}") for k in keys]))
    cols = [SLICE, *keys]
    counted = (df.join(F.broadcast(edge), _match(df, edge, cols), "left_semi")  # two rows a slice
               .groupBy(*cols).agg(*aggs))
    shared = counted.withColumn("_n_slices", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    return shared.where("_n_slices > 1").select(
        *[F.col(c).alias(f"_b_{c}") for c in cols], *over)


def seq_number(df: DataFrame, key: str | Sequence[str], order: Sequence[str], out: str = "seq",
               total: str | None = None, key_mins: dict[str, str] | None = None) -> DataFrame:
    """1-based position of each row within its key by ``order`` (a total order).

    ``total`` adds the key's row count and ``key_mins`` ({out: column}) the key's
    minimum of a column, from the same slices.
    """
    keys, mins = _keys(key), key_mins or {}
    rows = sliced(df, keys, order)
    own = Window.partitionBy(SLICE, *keys)
    rows = rows.withColumns({
        "_local": F.row_number().over(own.orderBy(*_asc(order))),
        **({"_count": F.count(F.lit(1)).over(own)} if total else {}),
        **{f"_min_{o}": F.min(c).over(own) for o, c in mins.items()}})
    of_key = Window.partitionBy(*keys)
    earlier = of_key.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    spans = _spans(rows, keys, [F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(f"_m_{o}") for o, c in mins.items()]],
                   [F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"), F.sum("_n").over(of_key).alias("_all"),
                    *[F.min(f"_m_{o}").over(of_key).alias(f"_all_{o}") for o in mins]])
    j = rows.join(F.broadcast(spans), _match(rows, spans, [SLICE, *keys]), "left")
    return j.select(
        *df.columns, (F.coalesce("_off", F.lit(0)) + F.col("_local")).cast("long").alias(out),
        *([F.coalesce("_all", "_count").cast("long").alias(total)] if total else []),
        *[F.coalesce(f"_all_{o}", f"_min_{o}").alias(o) for o in mins])


def running_sum(df: DataFrame, key: str | Sequence[str], order: Sequence[str], col: str, out: str,
                total: str) -> DataFrame:
    """Sum of ``col`` over a key's rows up to and with this one by ``order``, and over all of them."""
    keys = _keys(key)
    rows = sliced(df, keys, order)
    own = Window.partitionBy(SLICE, *keys)
    upto = own.orderBy(*_asc(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"_local": F.sum(col).over(upto), "_part": F.sum(col).over(own)})
    of_key = Window.partitionBy(*keys)
    earlier = of_key.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    spans = _spans(rows, keys, [F.sum(col).alias("_n")],
                   [F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"), F.sum("_n").over(of_key).alias("_all")])
    j = rows.join(F.broadcast(spans), _match(rows, spans, [SLICE, *keys]), "left")
    return j.select(*df.columns, (F.coalesce("_off", F.lit(0)) + F.col("_local")).alias(out),
                    F.coalesce("_all", "_part").alias(total))


def neighbour(rows: DataFrame, key: str | Sequence[str], order: Sequence[str], cols: Sequence[str],
              offset: int, prefix: str) -> DataFrame:
    """LAG (offset -1) or LEAD (offset +1) of ``cols`` within ``key`` by ``order``.

    ``rows`` comes from ``sliced`` over the same key and order (a subset of its rows
    will do).  Adds ``{prefix}{col}`` and ``{prefix}exists``.
    """
    keys = _keys(key)
    step = F.lag if offset < 0 else F.lead
    own = Window.partitionBy(SLICE, *keys).orderBy(*_asc(order))
    packed = F.struct(*cols)
    near = rows.withColumn("_near", step(packed).over(own))
    pick = F.max_by if offset < 0 else F.min_by  # the row of the slice before, or after
    spans = _spans(rows, keys, [pick(packed, F.struct(*order)).alias("_edge")],
                   [step("_edge").over(Window.partitionBy(*keys).orderBy(SLICE)).alias("_far")])
    j = near.join(F.broadcast(spans), _match(near, spans, [SLICE, *keys]), "left")
    found = F.coalesce("_near", "_far")
    return j.select(*rows.columns, *[found[c].alias(f"{prefix}{c}") for c in cols],
                    found.isNotNull().alias(f"{prefix}exists"))
