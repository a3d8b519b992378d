"""Scalar column expressions (projections, casts, flags, buckets, date maths).

Every function returns a native ``Column`` so it stays inside whole-stage
codegen; none of them is a Python UDF.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed label sets (values that must equal the dashboards' labels).
DELIVERY_BUCKETS = ["Early / on-time", "1-3 days late", "4-7 days late", "8+ days late"]
REVIEW_BUCKETS = ["1-2 ★ (detractor)", "3 ★ (passive)", "4-5 ★ (promoter)"]
DELAY_BUCKETS6 = ["1. Very Early (>7d)", "2. Early (1-7d)", "3. On Time",
                  "4. Slightly Late (1-3d)", "5. Late (4-7d)", "6. Very Late (7d+)"]


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


EPOCH = "1970-01-01 00:00:00"


def epoch_micros(c: ColumnOrName) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock timestamp.

    Computed as a TIMESTAMP_NTZ difference, so the result does not depend on
    the session time zone (a cast to TIMESTAMP would read the wall time in
    that zone and shift across daylight-saving changes).
    """
    return F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"),
                            _c(c).cast("timestamp_ntz"))


# ---------------------------------------------------------------- P1, P2 ----
def select_as(df: DataFrame, mapping: Mapping[str, ColumnOrName]) -> DataFrame:
    """rename/select projection, ``{new_name: old_column}``."""
    return df.select(*[_c(old).alias(new) for new, old in mapping.items()])


def drop_cols(df: DataFrame, *cols: str) -> DataFrame:
    """Star minus columns."""
    return df.drop(*cols)


# ------------------------------------------------------------- P3 – P9 ----
def norm_key(c: ColumnOrName) -> Column:
    """TRIM(CAST(x AS STRING))."""
    return F.trim(_c(c).cast("string"))


def to_long(c: ColumnOrName) -> Column:
    """Tolerant integer cast (bad text → NULL under ANSI mode)."""
    return F.try_cast(_c(c), "long") if hasattr(F, "try_cast") else _c(c).try_cast("long")


def to_double(c: ColumnOrName) -> Column:
    """Tolerant float cast."""
    return _c(c).try_cast("double")


def to_ts(c: ColumnOrName) -> Column:
    """P5: timestamp cast; already-typed columns pass through."""
    return _c(c).try_cast("timestamp_ntz")


def std_enum(c: ColumnOrName, default: str) -> Column:
    """LOWER(COALESCE(x, default))."""
    return F.lower(F.coalesce(_c(c), F.lit(default)))


def require(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop rows whose key columns are NULL."""
    return df.dropna(subset=list(cols))


def null_if(c: ColumnOrName, cond: Column) -> Column:
    """NULL where ``cond`` holds, value otherwise."""
    return F.when(~cond | cond.isNull(), _c(c))


def blank_to_null(c: ColumnOrName) -> Column:
    """P9: '' or all-blank → NULL."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


# ----------------------------------------------------------- P10 – P16 ----
def quality_flags(df: DataFrame, as_of: str, high_value: float = 10000.0,
                  long_days: int = 30) -> DataFrame:
    """The seven boolean data-quality flags of the order fact.

    ``as_of`` replaces the wall clock so the result is a function of the data.
    """
    purchase = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    clock = F.lit(as_of).cast("timestamp_ntz")
    return df.select(
        "*",
        F.coalesce(delivered < purchase, F.lit(False)).alias("has_invalid_delivery_date"),
        (estimated.isNotNull() & F.coalesce(clock > estimated, F.lit(False))
         & delivered.isNull()).alias("is_overdue_delivery"),
        F.coalesce(F.col("price") > high_value, F.lit(False)).alias("is_high_value_product"),
        (delivered.isNull() & F.coalesce(F.col("order_status") == "delivered", F.lit(False)))
        .alias("has_missing_delivery_date"),
        F.coalesce(days_between(purchase, delivered, "whole") > long_days, F.lit(False))
        .alias("is_long_delivery"),
        ((F.col("payment_type") == "not_defined") | F.col("payment_value").isNull())
        .alias("has_missing_payment_info"),
        F.col("order_item_id").isNull().alias("has_no_items"),
    )


# ----------------------------------------------------------- P17 – P20 ----
def month(c: ColumnOrName) -> Column:
    """First day of the month as DATE."""
    return F.trunc(F.to_date(_c(c)), "MM")


def days_between(start: ColumnOrName, end: ColumnOrName, mode: str = "calendar") -> Column:
    """Day difference ``end - start``.

    * ``calendar`` – difference of calendar dates;
    * ``whole``    – whole 24 h periods, truncated toward zero;
    * ``floor``    – whole 24 h periods, floored (pandas ``.dt.days``).
    """
    s, e = _c(start), _c(end)
    if mode == "calendar":
        return F.datediff(F.to_date(e), F.to_date(s)).cast("long")
    secs = epoch_micros(e) - epoch_micros(s)
    if mode == "whole":
        return (secs / F.lit(86400 * 1_000_000)).cast("long")
    if mode == "floor":
        return F.floor(secs / F.lit(86400 * 1_000_000)).cast("long")
    raise ValueError(f"unknown mode {mode!r}")


def hours_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Elapsed hours as a double."""
    return (epoch_micros(end) - epoch_micros(start)) / F.lit(3600 * 1_000_000)


def months_since(month_col: ColumnOrName, cohort_col: ColumnOrName) -> Column:
    """P20: whole calendar months between a cohort month and an order month."""
    m, c = _c(month_col), _c(cohort_col)
    return ((F.year(m) - F.year(c)) * 12 + (F.month(m) - F.month(c))).cast("long")


# ----------------------------------------------------------- P21 – P24 ----
def delivery_bucket(days_vs_estimate: ColumnOrName) -> Column:
    """Four lateness buckets; NULL stays NULL."""
    d = _c(days_vs_estimate)
    return (F.when(d.isNull(), F.lit(None).cast("string"))
            .when(d <= 0, DELIVERY_BUCKETS[0]).when(d <= 3, DELIVERY_BUCKETS[1])
            .when(d <= 7, DELIVERY_BUCKETS[2]).otherwise(DELIVERY_BUCKETS[3]))


def review_bucket(score: ColumnOrName) -> Column:
    """Detractor / passive / promoter."""
    s = _c(score)
    return (F.when(s.isNull(), F.lit(None).cast("string"))
            .when(s <= 2, REVIEW_BUCKETS[0]).when(s == 3, REVIEW_BUCKETS[1])
            .otherwise(REVIEW_BUCKETS[2]))


def delay_bucket6(days: ColumnOrName) -> Column:
    """Six delay buckets over delivered-minus-estimated days."""
    d = _c(days)
    return (F.when(d.isNull(), F.lit(None).cast("string"))
            .when(d < -7, DELAY_BUCKETS6[0]).when(d < 0, DELAY_BUCKETS6[1])
            .when(d == 0, DELAY_BUCKETS6[2]).when(d <= 3, DELAY_BUCKETS6[3])
            .when(d <= 7, DELAY_BUCKETS6[4]).otherwise(DELAY_BUCKETS6[5]))


def delivery_outcome(delivered: ColumnOrName, estimated: ColumnOrName,
                     legacy: bool = False) -> Column:
    """P24: 'not delivered' / 'on time' / 'late' (+ 'unknown' unless legacy).

    ``legacy=True`` reproduces the dashboard, where a delivered order with an
    unknown estimate fell into the ELSE branch ('late').
    """
    dl, es = _c(delivered), _c(estimated)
    base = F.when(dl.isNull(), F.lit("not delivered"))
    if not legacy:
        base = base.when(es.isNull(), F.lit("unknown"))
    return base.when(dl <= es, F.lit("on time")).otherwise(F.lit("late"))


# ----------------------------------------------------------- P25 – P26 ----
def apply_filters(df: DataFrame, start: str | None = None, end: str | None = None,
                  states: Iterable[str] | None = None, month_col: str = "order_month",
                  state_col: str = "customer_state") -> DataFrame:
    """P25: optional month range and state list, composed as one filter."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(month_col) >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (F.col(month_col) <= F.lit(end).cast("date"))
    if states:
        cond = cond & F.col(state_col).isin(list(states))
    return df.filter(cond)


def month_bounds(df: DataFrame, month_col: str = "order_month") -> DataFrame:
    """One row with the first and last month."""
    return df.agg(F.min(month_col).alias("min_month"), F.max(month_col).alias("max_month"))


def states(df: DataFrame, state_col: str = "customer_state") -> DataFrame:
    """Sorted distinct non-null states."""
    return (df.select(F.col(state_col).alias("state")).where(F.col("state").isNotNull())
            .distinct().orderBy("state"))


# ----------------------------------------------------------- P27 – P32 ----
def safe_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """A / b, NULL when b is 0 or NULL (never raises under ANSI)."""
    return F.try_divide(_c(a), F.nullif(_c(b), F.lit(0)))


def freight_pct(freight: ColumnOrName, price: ColumnOrName) -> Column:
    """Freight as a percentage of price."""
    return safe_div(_c(freight) * 100.0, price)


def clip(c: ColumnOrName, lo: float, hi: float) -> Column:
    """Clamp to [lo, hi]."""
    return F.greatest(F.least(_c(c), F.lit(hi)), F.lit(lo))


def is_late(days_vs_estimate: ColumnOrName) -> Column:
    """Strictly after the estimate; NULL stays NULL."""
    return _c(days_vs_estimate) > 0


def pretty(c: ColumnOrName) -> Column:
    """P31: 'health_beauty' → 'Health Beauty'."""
    return F.initcap(F.regexp_replace(_c(c), "_", " "))


def bround(c: ColumnOrName, scale: int = 0) -> Column:
    """Half-to-even rounding (pandas ``.round``)."""
    return F.bround(_c(c), scale)


def money_sum(c: ColumnOrName) -> Column:
    """Order-independent money total: exact decimal sum, returned as double."""
    return F.sum(_c(c).cast("decimal(18,2)")).cast("double")
