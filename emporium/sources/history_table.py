"""H1, H2 as a table: type-2 history in open rows and append-only closed rows.

The open rows lie in key buckets (``KeyedTable``), the closed ones in folders that each
run adds to.  A run compares the current rows with the open ones, which gives the
versions that end and those that begin; the ended ones are appended, and only the
buckets of changed or new keys are written anew.  So a run reads and writes nothing of
the closed history, and a run without a change writes no data at all.
"""
from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporium.operators import scd2
from emporium.session import scratch_path
from emporium.sources.keyed_table import KeyedTable

CLOSED = "closed"


class HistoryTable:
    """History of the rows of ``schema`` by ``key`` at ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str],
                 valid_type: T.DataType | None = None, buckets: int = 64):
        stamp = valid_type or T.TimestampNTZType()
        self.spark, self.key, self.columns = spark, list(key), schema.names
        self.schema = T.StructType([*schema.fields, T.StructField("valid_from", stamp), T.StructField("valid_to", stamp),
                                    T.StructField("scd_id", T.StringType())])
        self.table = KeyedTable(spark, path, self.schema, key, buckets)

    def open_rows(self, number: int | None = None) -> DataFrame:
        """The versions that are current."""
        return self.table.read(number)

    def read(self, number: int | None = None) -> DataFrame:
        """All versions."""
        return self.open_rows(number).unionByName(self.table.read_part(CLOSED, self.schema, number))

    def run_timestamp(self, current: DataFrame, updated_at: str, writer: str | None = None) -> bool:
        """H1: a new version when ``updated_at`` is later than that of the open row."""
        return self._run(current, F.col(f"c.{updated_at}") > F.col(f"h.{updated_at}"), F.col(f"c.{updated_at}"), writer)

    def run_check(self, current: DataFrame, check_cols: Sequence[str], as_of: str, writer: str | None = None) -> bool:
        """H2: a new version, from ``as_of`` on, when any of ``check_cols`` differs."""
        stamp = self.schema["valid_from"].dataType
        return self._run(current, ~scd2.null_safe_equal(check_cols, "h", "c"), F.lit(as_of).cast(stamp), writer)

    def _run(self, current: DataFrame, changed: Column, valid_from: Column, writer: str | None) -> bool:
        """False if nothing changed or ``writer`` had been committed before."""
        writer, table = writer or uuid.uuid4().hex[:12], self.table
        if table.committed(writer):
            return False
        found = scd2.changed_versions(self.open_rows(), current, self.key, changed, valid_from, self.columns,
                                      self.schema)
        path = scratch_path(self.spark, "changes")
        found.write.parquet(path)
        delta = self.spark.read.schema(self.schema).parquet(path)
        buckets = table.touched(delta)
        if not buckets:
            return False
        ended, begun = delta.where("valid_to IS NOT NULL"), delta.where("valid_to IS NULL")
        appended = [] if ended.isEmpty() else [table.append(ended, CLOSED)]
        # Open rows of the touched buckets stay unless their key has a new version.
        keys = begun.select(*[F.col(k).alias(f"_{k}") for k in self.key])
        old = table.read(buckets=buckets)
        same = [old[k].eqNullSafe(keys[f"_{k}"]) for k in self.key]
        kept = old.join(keys, scd2.all_of(same), "left_anti")
        table.commit(writer, table.stage(kept.unionByName(begun)), buckets, appended)
        return True
