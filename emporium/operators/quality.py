"""Data-quality checks (C1–C15) and failing-row sinks.

Every check is one aggregation returning the uniform row
``(check, table, column, severity, n_rows, n_failed, status)``; the rows that
fail are available from ``failures(...)`` and can be stored per check.  The
suite is a union of check rows; only the gate decision (a handful of rows,
one per check) is read on the driver.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REPORT = ("check string, table string, column string, severity string, n_rows long, n_failed long, "
          "status string")
RESULT_COLUMNS = ["check", "table", "column", "severity", "n_rows", "n_failed", "status"]


def _result(counts: DataFrame, check: str, table: str, column: str, severity: str) -> DataFrame:
    """Wrap a one-row (n_rows, n_failed) frame into the uniform result row."""
    failed = F.col("n_failed") > 0
    status = F.when(~failed, "pass").otherwise("warn" if severity == "warn" else "fail")
    return counts.select(F.lit(check).alias("check"), F.lit(table).alias("table"),
                         F.lit(column).alias("column"), F.lit(severity).alias("severity"),
                         F.col("n_rows").cast("long").alias("n_rows"),
                         F.coalesce(F.col("n_failed"), F.lit(0)).cast("long").alias("n_failed"),
                         status.alias("status"))


def _count_failing(df: DataFrame, bad: Column) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count(F.when(bad, 1)).alias("n_failed"))


@dataclass
class Check:
    """A named row predicate (True = failing row) over one table."""
    name: str
    table: str
    column: str
    bad: Column
    severity: str = "error"

    def run(self, df: DataFrame) -> DataFrame:
        return _result(_count_failing(df, self.bad), self.name, self.table, self.column,
                       self.severity)

    def failures(self, df: DataFrame) -> DataFrame:
        """The offending rows of this check."""
        return df.filter(self.bad)


def run_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """Several predicate checks over one table in a single scan and aggregation."""
    aggs = [F.count(F.lit(1)).alias("n_rows")] + [
        F.count(F.when(ch.bad, 1)).alias(f"_f{i}") for i, ch in enumerate(checks)]
    row = df.agg(*aggs)
    recs = F.array(*[F.struct(F.lit(ch.name).alias("check"), F.lit(table).alias("table"),
                              F.lit(ch.column).alias("column"),
                              F.lit(ch.severity).alias("severity"),
                              F.col("n_rows").cast("long").alias("n_rows"),
                              F.col(f"_f{i}").cast("long").alias("n_failed"))
                     for i, ch in enumerate(checks)])
    out = row.select(F.explode(recs).alias("r")).select("r.*")
    status = (F.when(F.col("n_failed") == 0, "pass")
              .when(F.col("severity") == "warn", "warn").otherwise("fail"))
    return out.withColumn("status", status).select(*RESULT_COLUMNS)


class Watch:
    """Row predicates, column profiles and totals of a table, measured while it is written.

    ``on`` attaches them to the frame (``DataFrame.observe``), so the one pass that writes
    the table also checks it: no further scan.  They are final once the write has ended;
    put the frame into one action only.
    """

    def __init__(self, table: str, checks: Sequence[Check] = (), profile: Sequence[str] = (),
                 where: Column | None = None, totals: dict[str, Column] | None = None):
        self.table, self.checks, self.columns, self.totals = table, list(checks), list(profile), dict(totals or {})
        self.where = F.lit(True) if where is None else where
        self._seen = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        aggs = [F.count(F.lit(1)).alias("n"), F.count(F.when(self.where, 1)).alias("n_where")]
        aggs += [F.count(F.when(ch.bad, 1)).alias(f"bad_{i}") for i, ch in enumerate(self.checks)]
        for i, c in enumerate(self.columns):
            v = F.when(self.where, F.col(c).cast("double"))
            aggs += [F.count(v).alias(f"nn_{i}"), F.min(v).alias(f"min_{i}"), F.max(v).alias(f"max_{i}"),
                     F.avg(v).alias(f"mean_{i}")]
        aggs += [F.sum(v.cast("decimal(18,2)")).alias(f"total_{name}") for name, v in self.totals.items()]
        return df.observe(self._seen, *aggs)

    def report(self, spark: SparkSession) -> DataFrame:
        """One row a check, as ``run_checks`` gives them."""
        seen, rows = self._seen.get, []
        for i, ch in enumerate(self.checks):
            bad = seen[f"bad_{i}"]
            status = "pass" if bad == 0 else "warn" if ch.severity == "warn" else "fail"
            rows.append((ch.name, self.table, ch.column, ch.severity, seen["n"], bad, status))
        return spark.createDataFrame(rows, REPORT)

    def profiled(self, spark: SparkSession) -> DataFrame:
        """C14: one row a column, as ``profile`` gives them."""
        seen = self._seen.get
        n = seen["n_where"]
        rows = [(c, 1 - seen[f"nn_{i}"] / n if n else None, seen[f"min_{i}"], seen[f"max_{i}"],
                 None if seen[f"mean_{i}"] is None else round(seen[f"mean_{i}"], 9)) for i, c in enumerate(self.columns)]
        return spark.createDataFrame(rows, "column string, null_rate double, min double, max double, mean double")

    def total(self, name: str) -> Decimal:
        return self._seen.get[f"total_{name}"] or Decimal(0)


def reconciled(spark: SparkSession, a: Decimal, b: Decimal, name: str, columns: str, tol: str = "0.01",
               severity: str = "error") -> DataFrame:
    """C12 of two totals that have been measured."""
    counts = spark.createDataFrame([(1, int(abs(a - b) > Decimal(tol)))], "n_rows int, n_failed int")
    return _result(counts, "reconcile", name, columns, severity)


# ------------------------------------------------------------ C1 – C11 ----
def not_null(df: DataFrame, table: str, col: str, severity: str = "error") -> DataFrame:
    """C1."""
    return Check("not_null", table, col, F.col(col).isNull(), severity).run(df)


def unique(df: DataFrame, table: str, cols: Sequence[str] | str,
           severity: str = "error") -> DataFrame:
    """Keys (non-NULL) that occur more than once; counted per key, map-side combined."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    name = "unique" if len(cols) == 1 else "unique_combination"
    per = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    nonnull = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    counts = per.agg(F.sum("_n").alias("n_rows"),
                     F.count(F.when(nonnull & (F.col("_n") > 1), 1)).alias("n_failed"))
    return _result(counts, name, table, ",".join(cols), severity)


def unique_failures(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """S15 for C2/C3: the duplicated key values with their counts."""
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def accepted(df: DataFrame, table: str, col: str, values: Sequence[str],
             severity: str = "error") -> DataFrame:
    """C4: non-NULL values outside the accepted list."""
    bad = F.col(col).isNotNull() & ~F.col(col).isin(list(values))
    return Check("accepted_values", table, col, bad, severity).run(df)


def relationship(child: DataFrame, parent: DataFrame, table: str, child_col: str,
                 parent_col: str, severity: str = "error") -> DataFrame:
    """C5 (J10): child keys with no parent row; parent keys deduplicated first."""
    keys = parent.select(F.col(parent_col).alias("_pk")).distinct()
    # Children are counted per key before the join: a hot or NULL key is one row.
    per = child.groupBy(F.col(child_col).alias("_ck")).agg(F.count(F.lit(1)).alias("_n"))
    j = per.join(keys, F.col("_ck") == F.col("_pk"), "left")
    counts = j.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
                   F.coalesce(F.sum(F.when(F.col("_ck").isNotNull() & F.col("_pk").isNull(), F.col("_n"))),
                              F.lit(0)).alias("n_failed"))
    return _result(counts, "relationships", table, child_col, severity)


def has_type(df: DataFrame, table: str, col: str, type_name: str,
             severity: str = "error") -> DataFrame:
    """Rows whose value is not of the type (a constant per column, so the check
    folds into its table's pass)."""
    return type_check(table, col, type_name, severity).run(df)


def type_check(table: str, col: str, type_name: str, severity: str = "error") -> Check:
    """C6 as a row predicate."""
    return Check(f"type_{type_name}", table, col, F.typeof(F.col(col)) != type_name, severity)


def between(df: DataFrame, table: str, col: str, lo: float | None = None,
            hi: float | None = None, where: Column | None = None,
            severity: str = "error") -> DataFrame:
    """Values outside [lo, hi] among rows meeting ``where`` (NULLs pass)."""
    out = F.lit(False)
    if lo is not None:
        out = out | (F.col(col) < lo)
    if hi is not None:
        out = out | (F.col(col) > hi)
    bad = F.coalesce(out, F.lit(False))
    if where is not None:
        bad = bad & F.coalesce(where, F.lit(False))
    return Check("between", table, col, bad, severity).run(df)


def pair_greater(df: DataFrame, table: str, a: str, b: str, or_equal: bool = False,
                 where: Column | None = None, severity: str = "error") -> DataFrame:
    """A > B (or ≥) must hold on rows meeting ``where``; unknown counts as failing."""
    ok = (F.col(a) >= F.col(b)) if or_equal else (F.col(a) > F.col(b))
    bad = ~F.coalesce(ok, F.lit(False))
    if where is not None:
        bad = bad & F.coalesce(where, F.lit(False))
    return Check("pair_greater", table, f"{a},{b}", bad, severity).run(df)


def assert_empty(df: DataFrame, name: str, table: str, bad: Column,
                 severity: str = "error") -> DataFrame:
    """A singular test: rows matching ``bad`` must not exist."""
    return Check(name, table, "", bad, severity).run(df)


# ------------------------------------------------------------ C12 – C15 ----
def reconcile(a: DataFrame, a_col: str, b: DataFrame, b_col: str, name: str,
              tol: float = 0.01, severity: str = "error") -> DataFrame:
    """Two totals (exact decimal sums) must agree within ``tol``."""
    ta = a.agg(F.sum(F.col(a_col).cast("decimal(18,2)")).alias("_a"))
    tb = b.agg(F.sum(F.col(b_col).cast("decimal(18,2)")).alias("_b"))
    j = ta.withColumn("_b", tb.select("_b").scalar())
    counts = j.select(F.lit(1).alias("n_rows"),
                      F.when(F.abs(F.coalesce("_a", F.lit(0)) - F.coalesce("_b", F.lit(0)))
                             > tol, 1).otherwise(0).alias("n_failed"))
    return _result(counts, "reconcile", name, f"{a_col}={b_col}", severity)


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """C14: null rate, min, max and mean per numeric column, one pass, long form."""
    aggs = []
    for c in cols:
        aggs += [F.count(F.lit(1)).alias(f"{c}__n"), F.count(c).alias(f"{c}__nn"),
                 F.min(F.col(c).cast("double")).alias(f"{c}__min"),
                 F.max(F.col(c).cast("double")).alias(f"{c}__max"),
                 F.round(F.avg(F.col(c).cast("double")), 9).alias(f"{c}__mean")]
    row = df.agg(*aggs)
    recs = F.array(*[F.struct(F.lit(c).alias("column"),
                              (1 - F.col(f"{c}__nn") / F.col(f"{c}__n")).alias("null_rate"),
                              F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"),
                              F.col(f"{c}__mean").alias("mean")) for c in cols])
    return row.select(F.explode(recs).alias("r")).select("r.*")


def envelope(prof: DataFrame, table: str, max_null_rate: float = 0.1,
             mean_bounds: dict[str, tuple[float, float]] | None = None,
             severity: str = "warn",
             ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """C14: statistical envelopes over a profile: null rate, mean and range (least and
    greatest value) within bounds.  A time window is a filter before the profile."""
    bad = F.col("null_rate") > max_null_rate
    for col, (lo, hi) in (ranges or {}).items():
        bad = bad | ((F.col("column") == col) & ((F.col("min") < lo) | (F.col("max") > hi)))
    for col, (lo, hi) in (mean_bounds or {}).items():
        bad = bad | ((F.col("column") == col) & ~F.col("mean").between(lo, hi))
    counts = prof.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.count(F.when(F.coalesce(bad, F.lit(True)), 1)).alias("n_failed"))
    return _result(counts, "envelope", table, "*", severity)


def run_suite(results: Sequence[DataFrame]) -> DataFrame:
    """One report of all check rows."""
    return reduce(lambda a, b: a.unionByName(b), results)


def gate(report: DataFrame) -> bool:
    """C15 gate: False when any error-level check failed (reads one row per check)."""
    return report.filter(F.col("status") == "fail").limit(1).count() == 0


def store_failures(df: DataFrame, base_path: str, check: str) -> DataFrame:
    """Write a check's failing rows to ``base_path/audit/<check>``; returns them as stored."""
    path = f"{base_path.rstrip('/')}/audit/{check}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
