"""Incremental keyed load as a Structured Streaming job.

New files in a source folder are read as a stream (``availableNow``: process what
is there, then stop — the nightly-batch shape), and every micro-batch is merged by
key into a ``KeyedTable``: only the key buckets that the batch meets are read and
written anew, and a manifest version commits them.

A version names its writer, ``q=<query id>,b=<batch id>``.  A batch that is replayed
after a crash either finds its own committed version and does nothing, or writes anew
what was not committed.  A stream with a reset checkpoint has a new query id and goes on
from the newest version: merging the same rows again changes nothing.  After each batch
the versions beyond the newest ``keep`` go, with the data that only they list.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from emporium.sources.keyed_table import KeyedTable


def read_target(spark: SparkSession, target: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The newest committed version."""
    return KeyedTable(spark, target, schema, keys).read()


def apply_batch(batch: DataFrame, target: str, writer: str, schema: T.StructType, keys: Sequence[str],
                order_by: Sequence[str | tuple[str, bool]] | None = None, buckets: int = 64, keep: int = 2) -> bool:
    """Merge one micro-batch; ``writer`` names the stream and the batch.  False if it
    had been committed before."""
    table = KeyedTable(batch.sparkSession, target, schema, keys, buckets)
    if not table.upsert(batch, writer, order_by):
        return False
    table.vacuum(keep)
    return True


def stream_upsert(spark: SparkSession, source_dir: str, target: str, checkpoint: str,
                  schema: T.StructType, keys: Sequence[str],
                  order_by: Sequence[str | tuple[str, bool]] | None = None,
                  max_files_per_trigger: int | None = None, buckets: int = 64, keep: int = 2) -> DataFrame:
    """Run the stream to completion and return the current target table."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        apply_batch(batch, target, f"q={query},b={batch_id}", schema, keys, order_by, buckets, keep)

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.parquet(source_dir).writeStream
         .foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return read_target(spark, target, schema, keys)
