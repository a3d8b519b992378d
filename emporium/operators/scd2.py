"""Type-2 history (H1–H6).

History is state: a pure function ``(history, current, …) → new history``.
The caller writes the result to a *new* path and swaps (never overwrite a
path that is being read).  Output columns: the tracked columns, ``scd_id``
(surrogate per version), ``valid_from``, ``valid_to``.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporium.functions.expr import epoch_micros
from emporium.operators.windows import SLICE, neighbour, sliced

SEP = "␟"  # unit-separator glyph: never appears in keys


def surrogate_key(df: DataFrame, cols: Sequence[str]) -> Column:
    """H4: md5 over the listed columns, NULL-safe.

    Timestamps enter as epoch microseconds so the text form does not depend
    on an engine's timestamp formatting.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for c in cols:
        col = F.col(c)
        if isinstance(types.get(c), (T.TimestampType, T.TimestampNTZType)):
            col = epoch_micros(col)
        parts.append(F.coalesce(col.cast("string"), F.lit("")))
    return F.md5(F.concat_ws(SEP, *parts))


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def null_safe_equal(cols: Sequence[str], left: str, right: str) -> Column:
    return all_of([F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols])


def _one_row_a_key(current: DataFrame, key: Sequence[str]) -> DataFrame:
    """``current``; a key that it holds twice raises when the result is computed.

    Counted map-side, at most one row a key after it."""
    counted = current.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    twins = counted.where(F.col("_n") > 1).agg(F.count(F.lit(1)).alias("n")).scalar()
    return current.where(F.when(twins > 0, F.raise_error(F.lit("duplicate keys in the snapshot's input")))
                         .otherwise(F.lit(True)))


def changed_versions(open_rows: DataFrame, current: DataFrame, key: Sequence[str], changed: Column,
                     valid_from: Column, data_cols: Sequence[str], schema: T.StructType) -> DataFrame:
    """What a snapshot run changes, in ``schema``: the versions that end (``valid_to`` set) and
    those that begin, of changed and new keys.

    ``changed`` and ``valid_from`` are written over ``h`` (open row) and ``c`` (current row)."""
    types = {f.name: f.dataType for f in schema.fields}
    h, c = open_rows.withColumn("_h", F.lit(True)).alias("h"), _one_row_a_key(current, key).alias("c")
    j = c.join(h, null_safe_equal(key, "h", "c"), "left")
    is_new = F.col("h._h").isNull()
    start = valid_from.cast(types["valid_from"])
    none = F.lit(None).cast(types["valid_from"])
    old = F.struct(*[F.col(f"h.{x}").cast(types[x]).alias(x) for x in data_cols], F.col("h.valid_from").alias("valid_from"),
                   start.alias("valid_to"), F.col("h.scd_id").alias("scd_id"))
    new = F.struct(*[F.col(f"c.{x}").cast(types[x]).alias(x) for x in data_cols], start.alias("valid_from"),
                   none.alias("valid_to"), F.lit(None).cast("string").alias("scd_id"))
    rows = (j.where(is_new | F.coalesce(changed, F.lit(False)))
            .select(F.explode(F.when(is_new, F.array(new)).otherwise(F.array(old, new))).alias("v")).select("v.*"))
    return rows.withColumn("scd_id", F.coalesce("scd_id", surrogate_key(rows, [*key, "valid_from"])))


def _snapshot(history: DataFrame | None, current: DataFrame, key: Sequence[str],
              changed: Column, valid_from: Column, keep_cols: Sequence[str]) -> DataFrame:
    """Shared fold of H1/H2.

    ``changed`` and ``valid_from`` are written over aliases ``h`` (open history row)
    and ``c`` (current row).  Keys match null-safe.  One join: every joined row
    gives one version (kept or new) or two (ended and new).  A key that ``current``
    holds twice raises when the result is computed.
    """
    key, data_cols = list(key), list(keep_cols)
    cols = [*data_cols, "valid_from", "valid_to", "scd_id"]
    current = _one_row_a_key(current, key)
    if history is None:
        new = current.alias("c").select(*[F.col(f"c.{x}") for x in data_cols],
                                        valid_from.alias("valid_from"))
        new = new.withColumn("valid_to", F.lit(None).cast(new.schema["valid_from"].dataType))
        return new.withColumn("scd_id", surrogate_key(new, key + ["valid_from"])).select(*cols)
    closed = history.filter(F.col("valid_to").isNotNull())
    open_ = history.filter(F.col("valid_to").isNull()).withColumn("_h", F.lit(True))
    cond = reduce(lambda a, b: a & b, [F.col(f"h.{k}").eqNullSafe(F.col(f"c.{k}")) for k in key])
    j = open_.alias("h").join(current.withColumn("_c", F.lit(True)).alias("c"), cond, "full_outer")
    has_h, has_c = F.col("h._h").isNotNull(), F.col("c._c").isNotNull()
    is_changed = has_h & has_c & F.coalesce(changed, F.lit(False))
    vf_type = history.schema["valid_from"].dataType
    types = {f.name: f.dataType for f in history.schema.fields}
    start = valid_from.cast(vf_type)
    none = F.lit(None).cast(vf_type)
    old = F.struct(*[F.col(f"h.{x}").cast(types[x]).alias(x) for x in data_cols],
                   F.col("h.valid_from").alias("valid_from"),
                   F.when(is_changed, start).otherwise(none).alias("valid_to"), F.col("h.scd_id").alias("scd_id"))
    new = F.struct(*[F.col(f"c.{x}").cast(types[x]).alias(x) for x in data_cols],
                   start.alias("valid_from"), none.alias("valid_to"), F.lit(None).cast("string").alias("scd_id"))
    versions = F.when(is_changed, F.array(old, new)).when(has_h, F.array(old)).otherwise(F.array(new))
    rows = j.select(F.explode(versions).alias("v")).select("v.*")
    rows = rows.withColumn("scd_id", F.coalesce("scd_id", surrogate_key(rows, key + ["valid_from"])))
    return closed.select(*cols).unionByName(rows.select(*cols))


def scd2_timestamp(history: DataFrame | None, current: DataFrame, key: Sequence[str],
                   updated_at: str) -> DataFrame:
    """H1: new version when ``updated_at`` is newer than the open row's.

    ``valid_from`` of a version is its ``updated_at``.  Keys missing from
    ``current`` stay open; re-running with the same input changes nothing.
    """
    changed = F.col(f"c.{updated_at}") > F.col(f"h.{updated_at}")
    return _snapshot(history, current, key, changed, F.col(f"c.{updated_at}"),
                     current.columns)


def scd2_check(history: DataFrame | None, current: DataFrame, key: Sequence[str],
               check_cols: Sequence[str], as_of: str) -> DataFrame:
    """H2: new version when any ``check_cols`` differs (NULL-safe); opened at ``as_of``."""
    changed = ~null_safe_equal(check_cols, "h", "c")
    return _snapshot(history, current, key, changed,
                     F.lit(as_of).cast("timestamp_ntz"), current.columns)


def with_validity(df: DataFrame) -> DataFrame:
    """H3: ``is_current`` flag over ``valid_to``."""
    return df.withColumn("is_current", F.col("valid_to").isNull())


def version_ranges(log: DataFrame, key: Sequence[str], attrs: Sequence[str],
                   ts: str) -> DataFrame:
    """H5: hand-built version ranges from a full change log.

    One row per distinct (key, attrs) version: ``start_at`` = first time it was
    seen (FIRST_VALUE / RANK = 1 / DISTINCT collapse to a ``min``),
    ``last_seen_at`` = last time (LAST_VALUE over the whole frame = ``max``),
    ``end_at`` = start of the key's next version (LEAD).
    """
    key, attrs = list(key), list(attrs)
    versions = log.groupBy(*key, *attrs).agg(F.min(ts).alias("start_at"),
                                             F.max(ts).alias("last_seen_at"))
    order = ["start_at", *attrs]
    nxt = neighbour(sliced(versions, key, order), key, order, ["start_at"], +1, "_next_")
    out = nxt.withColumnRenamed("_next_start_at", "end_at").drop("_next_exists", SLICE)
    return out.withColumn("is_current", F.col("end_at").isNull())


def scd2_from_log(log: DataFrame, key: Sequence[str], ts: str,
                  check_cols: Sequence[str]) -> DataFrame:
    """H6: rebuild the whole history from an append-only log.

    Rows equal (NULL-safe) to the key's previous row on ``check_cols`` are not
    new versions; ``valid_to`` is the next kept version's ``valid_from``.  The log
    is sliced by (key, time, rest) once; both neighbours come from those slices,
    so a key with a third of all log rows is spread over many tasks, also when a
    bulk load gave them one time stamp.
    """
    key, check_cols = list(key), list(check_cols)
    order = [ts, *[c for c in log.columns if c not in key and c != ts]]
    prev = neighbour(sliced(log, key, order), key, order, check_cols, -1, "_prev_")
    same = reduce(lambda a, b: a & b,
                  [F.col(c).eqNullSafe(F.col(f"_prev_{c}")) for c in check_cols], F.lit(True))
    kept = prev.filter(~F.col("_prev_exists") | ~same).select(*log.columns, SLICE)
    out = (neighbour(kept, key, order, [ts], +1, "_next_").withColumn("valid_from", F.col(ts))
           .withColumnRenamed(f"_next_{ts}", "valid_to"))
    out = out.select(*log.columns, "valid_from", "valid_to")
    out = out.withColumn("scd_id", surrogate_key(out, key + ["valid_from"]))
    return with_validity(out)
