"""Pipeline monitoring (O1–O5) over run logs and job logs.

Run logs hold one row per run (small); windows over them are partitioned by
pipeline, never over raw data.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporium.functions.expr import epoch_micros


def freshness(loads: DataFrame, as_of: str, max_hours: float = 26.0,
              table_col: str = "table", loaded_col: str = "loaded_at") -> DataFrame:
    """O1: newest load per table; stale when older than ``max_hours`` at ``as_of``."""
    clock = F.lit(as_of).cast("timestamp_ntz")
    age = (epoch_micros(clock) - epoch_micros("last_loaded_at")) / F.lit(3600 * 1_000_000)
    return (loads.groupBy(table_col).agg(F.max(loaded_col).alias("last_loaded_at"))
            .withColumn("age_hours", age)
            .withColumn("is_stale", F.col("age_hours") > max_hours))


def volume_anomalies(runs: DataFrame, k: int = 3, drop: float = 0.2,
                     pipeline_col: str = "pipeline", run_col: str = "run_id",
                     n_col: str = "rows") -> DataFrame:
    """O2: a run whose row count is more than ``drop`` below the trailing average of k runs."""
    w = Window.partitionBy(pipeline_col).orderBy(run_col).rowsBetween(-k, -1)
    avg = F.avg(F.col(n_col).cast("double")).over(w)
    return (runs.withColumn("trailing_avg", avg)
            .withColumn("is_anomaly", F.coalesce(F.col(n_col) < (1 - drop) * F.col("trailing_avg"),
                                                 F.lit(False))))


def failing_checks(results: DataFrame, run_col: str = "run_id") -> DataFrame:
    """O3: failing (and warning) checks per run."""
    return results.groupBy(run_col).agg(
        F.count(F.when(F.col("status") == "fail", 1)).alias("failing"),
        F.count(F.when(F.col("status") == "warn", 1)).alias("warning"),
        F.count(F.lit(1)).alias("checks"))


def top_jobs(log: DataFrame, as_of: str, n: int = 20, hours: int = 24) -> DataFrame:
    """Top-n jobs by bytes billed in the last ``hours`` before ``as_of``."""
    clock = F.lit(as_of).cast("timestamp_ntz")
    start = F.timestamp_add("HOUR", F.lit(-hours), clock)
    recent = log.filter((F.col("creation_time") >= start) & (F.col("creation_time") <= clock))
    return (recent.select("job_id", "user_email", "statement_type", "total_bytes_billed",
                          F.date_trunc("minute", "creation_time").alias("minute"))
            .orderBy(F.col("total_bytes_billed").desc(), F.col("job_id")).limit(n))


def run_stats(runs: DataFrame, pipeline_col: str = "pipeline") -> DataFrame:
    """Duration per run, plus success ratio and mean duration per pipeline."""
    dur = (epoch_micros("ended") - epoch_micros("started")) / F.lit(1_000_000)
    per = runs.withColumn("duration_s", dur)
    w = Window.partitionBy(pipeline_col)   # one row per run: a small partition
    return per.select(
        "*", F.count(F.lit(1)).over(w).alias("runs"),
        (F.count(F.when(F.col("status") == "success", 1)).over(w) / F.count(F.lit(1)).over(w))
        .alias("success_ratio"),
        F.avg("duration_s").over(w).alias("avg_duration_s"))
