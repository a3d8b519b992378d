"""S10 by rows: order-free checksums per key bucket, drilled down where they differ.

Each side gives one row a bucket of keys: count, sum and exclusive-or of the rows'
64-bit hashes.  Equal rows in any order, file or partition give equal checksums, so two
tables are compared without a join of their rows and one aggregate crosses the network.
Only the keys of buckets that differ are then compared one by one, and named.

Rows are hashed in the source's column names and types.  A key that occurs several
times is compared as the set of its rows with their numbers.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024
KINDS = ("missing", "extra", "changed")


def _hashed(df: DataFrame, like: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, _h): a hash of every row over the columns of ``like``; null is a value."""
    cols = [F.col(f"`{f.name}`").cast(f.dataType) for f in like.schema.fields]
    known = [c.isNull() for c in cols]  # else a null would hash as if the column were not there
    return df.select(*[F.col(k).cast(like.schema[k].dataType).alias(k) for k in keys],
                     F.xxhash64(*cols, *known).alias("_h"))


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(BUCKETS)).cast("int")


def _sums(rows: DataFrame, by: Sequence[Column | str], prefix: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias(f"{prefix}_n"), F.bit_xor("_h").alias(f"{prefix}_x"),
                                 F.sum(F.pmod("_h", F.lit((1 << 31) - 1))).alias(f"{prefix}_s"))


def _differs() -> Column:
    return ~(F.col("a_n").eqNullSafe(F.col("b_n")) & F.col("a_x").eqNullSafe(F.col("b_x"))
             & F.col("a_s").eqNullSafe(F.col("b_s")))


def _outer(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on null-safe keys, the keys once."""
    right = b.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    same = reduce(lambda x, y: x & y, [a[k].eqNullSafe(right[f"_{k}"]) for k in keys])
    j = a.withColumn("_here", F.lit(True)).join(right, same, "full_outer")
    return j.select(*[F.when(F.col("_here"), F.col(k)).otherwise(F.col(f"_{k}")).alias(k) for k in keys],
                    *[c for c in a.columns + right.columns if c not in keys and not c.startswith("_")])


def checksums(source: DataFrame, loaded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(bucket, a_n, a_x, a_s, b_n, b_x, b_s): checksums of source and load, at most ``BUCKETS`` rows."""
    a = _sums(_hashed(source, source, keys), [_bucket(keys).alias("bucket")], "a")
    b = _sums(_hashed(loaded, source, keys), [_bucket(keys).alias("bucket")], "b")
    return _outer(a, b, ["bucket"])


def differing_rows(source: DataFrame, loaded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, kind, source_rows, loaded_rows): the keys whose rows differ.

    ``missing``: not loaded; ``extra``: not in the source; ``changed``: in both, other rows."""
    worse = checksums(source, loaded, keys).where(_differs()).select(F.col("bucket").alias("_b"))

    def within(df: DataFrame) -> DataFrame:
        rows = _hashed(df, source, keys)
        return rows.join(F.broadcast(worse), _bucket(keys) == worse["_b"], "left_semi")  # at most BUCKETS rows

    j = _outer(_sums(within(source), keys, "a"), _sums(within(loaded), keys, "b"), keys).where(_differs())
    kind = F.when(F.col("b_n").isNull(), KINDS[0]).when(F.col("a_n").isNull(), KINDS[1]).otherwise(KINDS[2])
    return j.select(*keys, kind.alias("kind"), F.coalesce("a_n", F.lit(0)).alias("source_rows"),
                    F.coalesce("b_n", F.lit(0)).alias("loaded_rows"))


def reconcile_rows(sources: Mapping[str, DataFrame], tables: Mapping[str, DataFrame],
                   keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row a source: counts, keys that are missing, extra or changed, and a status.

    ``exact``: the same rows; ``changed``: some key's rows differ; ``missing``: some key is not
    loaded; ``appended``: only keys beyond the source's.  The worst counts, in the order changed,
    missing, appended.  A source without a table is missing."""
    parts = []
    for name, source in sources.items():
        loaded = tables[name] if name in tables else source.limit(0)
        n = checksums(source, loaded, keys[name]).agg(F.coalesce(F.sum("a_n"), F.lit(0)).alias("src_n"),
                                                      F.coalesce(F.sum("b_n"), F.lit(0)).alias("tgt_n"))
        kinds = differing_rows(source, loaded, keys[name]).agg(
            *[F.count(F.when(F.col("kind") == k, 1)).alias(f"{k}_keys") for k in KINDS])
        found = kinds.select(F.struct(*kinds.columns).alias("k")).scalar()
        parts.append(n.withColumn("k", found).select(F.lit(name).alias("table"), "src_n", "tgt_n", "k.*"))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    status = (F.when(F.col("changed_keys") > 0, "changed").when(F.col("missing_keys") > 0, "missing")
              .when(F.col("extra_keys") > 0, "appended").otherwise("exact"))
    return out.withColumn("status", status)
