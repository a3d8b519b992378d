"""Scans, loads and sinks.

Paths are folders on shared storage (the session's ``spark.checkpoint.dir``
on a cluster).  Writes go to a new folder and are read back from there;
nothing is collected to the driver except counts and schemas.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporium.operators.staging import dedupe_latest
from emporium.sources import versioned


# ---------------------------------------------------------------- S1, S2 ----
def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             multi_line: bool = True) -> DataFrame:
    """Header CSV with UTF-8 BOM, quoted embedded newlines and doubled quotes.

    A file with ``multi_line`` is read by one task; pass False for large files
    without newlines in fields, which are then split.
    """
    r = (spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
         .option("quote", '"').option("encoding", "UTF-8"))
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", True).csv(path)


def infer_schema(spark: SparkSession, path: str) -> T.StructType:
    """Inferred schema; a file whose values are all text keeps its header names as STRING."""
    return read_csv(spark, path).schema


def write_csv(df: DataFrame, path: str) -> str:
    """Truncate-and-load CSV sink (header, quoted)."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


# ---------------------------------------------------------------- S3 ----
def jdbc_options(url: str, table: str, props: Mapping[str, str] | None = None,
                 partition_col: str | None = None, bounds: tuple[int, int] | None = None,
                 num_partitions: int = 8) -> dict[str, str]:
    """S3: options for a parallel JDBC scan (range-partitioned on a numeric column)."""
    opts = {"url": url, "dbtable": table, **(props or {})}
    if partition_col is not None:
        if bounds is None:
            raise ValueError("bounds are required with a partition column")
        opts.update({"partitionColumn": partition_col, "lowerBound": str(bounds[0]),
                     "upperBound": str(bounds[1]), "numPartitions": str(num_partitions)})
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, **kw) -> DataFrame:
    """S3: JDBC table scan (needs a reachable database)."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kw)).load()


# ---------------------------------------------------------------- S4 – S6 ----
def incremental_read(df: DataFrame, key: str, state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Rows with ``key >= last max`` (inclusive; duplicates are absorbed by S5),
    and the new one-row state ``(max_key)``."""
    if state is None:
        delta = df
    else:
        # the state is one row: a scalar subquery, pushed into the scan as a filter
        delta = df.filter(F.col(key) >= state.agg(F.max("max_key")).scalar())
    prev = state.select("max_key") if state is not None else None
    new = delta.agg(F.max(key).alias("max_key"))
    if prev is not None:
        new = new.unionByName(prev).agg(F.max("max_key").alias("max_key"))
    return delta, new


def upsert(target: DataFrame, delta: DataFrame, keys: Sequence[str],
           order_by: Sequence[str | tuple[str, bool]] | None = None,
           descending: bool = True) -> DataFrame:
    """Merge a delta by key: of a key's rows in both, the first by ``order_by``
    stays, so a late older row never replaces a newer one; of equal ones, that of
    the delta.  Without ``order_by`` the delta wins.  Idempotent; keys may be
    composite, and a NULL key is a key like any other.
    """
    both = (target.withColumn("_new", F.lit(0)).unionByName(delta.withColumn("_new", F.lit(1))))
    order = [*(order_by or []), ("_new", True)]
    return dedupe_latest(both, keys, order, descending=descending).drop("_new")


def append_history(df: DataFrame, batch_ts: str, path: str, col: str = "batched_at") -> DataFrame:
    """Append the rows, stamped with their load time, to the history at ``path``."""
    stamped = df.withColumn(col, F.lit(batch_ts).cast("timestamp_ntz"))
    stamped.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(stamped.schema).parquet(path)


# ---------------------------------------------------------------- S7 – S11 ----
def load_all(tables: Mapping[str, DataFrame], base: str, fmt: str = "parquet",
             max_records_per_file: int = 0, keep: int = 2) -> dict[str, str]:
    """S7 + S9: write each source as the next version of ``base/<bronze name>`` (one job
    per table) and return the versions' folders.

    ``max_records_per_file`` cuts files at so many rows (0: only by partition).  A failed
    load leaves the table as it was; versions beyond the newest ``keep`` are removed.
    """
    out = {}
    for name, df in tables.items():
        target = f"{base.rstrip('/')}/{name}"
        out[name] = versioned.write_version(df, target, fmt=fmt, options={"maxRecordsPerFile": max_records_per_file})
        versioned.drop_versions(df.sparkSession, target, keep)
    return out


def flatten(df: DataFrame, depth: int = 1, sep: str = "__") -> DataFrame:
    """Flatten struct columns to ``depth`` levels (``a.b`` → ``a__b``)."""
    def cols(schema: T.StructType, prefix: list[str], level: int):
        out = []
        for f in schema.fields:
            path = prefix + [f.name]
            if isinstance(f.dataType, T.StructType) and level < depth:
                out += cols(f.dataType, path, level + 1)
            else:
                ref = F.col(".".join(f"`{p}`" for p in path))
                out.append(ref.alias(sep.join(path)))
        return out
    return df.select(*cols(df.schema, [], 0))


def reconcile_counts(sources: Mapping[str, DataFrame], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table source rows vs loaded rows: exact / appended / missing."""
    def counts(frames, col):
        parts = [df.agg(F.count(F.lit(1)).alias(col)).withColumn("table", F.lit(name))
                 for name, df in frames.items()]
        return reduce(lambda a, b: a.unionByName(b), parts)
    j = counts(sources, "src_n").join(counts(tables, "tgt_n"), "table", "full_outer")
    status = (F.when(F.col("tgt_n").isNull(), "missing")
              .when(F.col("tgt_n") == F.col("src_n"), "exact")
              .when(F.col("tgt_n") > F.col("src_n"), "appended").otherwise("missing"))
    return j.select("table", "src_n", "tgt_n", status.alias("status"))


def materialize(df: DataFrame, name: str, layer: str, base: str | None = None, keep: int = 2) -> DataFrame:
    """Stage → temp view (lazy); gold → written as the table's next version and read back.

    Readers of an earlier version go on with it; those beyond the newest ``keep`` are removed."""
    if layer == "stage":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if base is None:
        raise ValueError("a base path is required for materialised layers")
    target = f"{base.rstrip('/')}/{layer}/{name}"
    path = versioned.write_version(df, target)
    versioned.drop_versions(df.sparkSession, target, keep)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- S12 – S16 ----
def cached(spark: SparkSession, name: str, build, base: str, ttl_seconds: float = 3600.0,
           force: bool = False, offline: bool = False) -> DataFrame:
    """Named result cache as parquet with a time-to-live and a force switch; a build
    that fails leaves the last result.

    ``offline`` never builds: it reads what is cached, however old, and raises if
    there is nothing.
    """
    target = f"{base.rstrip('/')}/cache/{name}"
    last = versioned.newest(spark, target)
    fresh = last is not None and not force and versioned.age_seconds(spark, last) <= ttl_seconds
    if offline:
        if last is None:
            raise FileNotFoundError(f"nothing cached under {target}")
    elif not fresh:
        last = versioned.write_version(build(), target)
        versioned.drop_versions(spark, target, 2)
    return spark.read.parquet(last)


def seed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Static reference table; the planner broadcasts it if it is small."""
    return read_csv(spark, path, schema)


def log_run(spark: SparkSession, path: str, run_id: str, status: str, started: str,
            ended: str, rows: int) -> DataFrame:
    """Append one run record to the run log and return the log."""
    rec = spark.createDataFrame(
        [(run_id, status, started, ended, int(rows))],
        "run_id string, status string, started string, ended string, rows long") \
        .select("run_id", "status", F.col("started").cast("timestamp_ntz").alias("started"),
                F.col("ended").cast("timestamp_ntz").alias("ended"), "rows")
    rec.write.mode("append").parquet(path)
    return spark.read.parquet(path)
