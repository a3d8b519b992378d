"""Versioned folders: a table whose state is a numbered folder, replaced as a whole.

A version is a folder ``v=<number>,<writer>`` of its target.  It counts once Spark has
written its ``_SUCCESS`` file, so a failed or running write is invisible, readers keep
the version that they began with, and the last good one is never touched.  One writer
at a time is assumed for a target; ``writer`` names it and its batch, so a replay can
see that its batch has been committed.
"""
from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def hadoop_path(spark: SparkSession, path: str):
    """(path, file system) objects of Hadoop for a path on any store that Spark reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    p, fs = hadoop_path(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files in a folder; 0 if there is none."""
    p, fs = hadoop_path(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def remove(spark: SparkSession, path: str) -> None:
    p, fs = hadoop_path(spark, path)
    fs.delete(p, True)


def versions(spark: SparkSession, target: str) -> list[tuple[int, str, str]]:
    """(number, writer, folder) of the committed versions, oldest first."""
    out = []
    for name in children(spark, target):
        if not name.startswith("v="):
            continue
        p, fs = hadoop_path(spark, f"{target.rstrip('/')}/{name}/_SUCCESS")
        if fs.exists(p):
            number, writer = name[2:].split(",", 1)
            out.append((int(number), writer, f"{target.rstrip('/')}/{name}"))
    return sorted(out)


def age_seconds(spark: SparkSession, folder: str) -> float:
    """Seconds since a version was committed."""
    p, fs = hadoop_path(spark, f"{folder}/_SUCCESS")
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000.0


def write_version(df: DataFrame, target: str, writer: str | None = None, fmt: str = "parquet",
                  options: dict[str, object] | None = None, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as the next version and return its folder."""
    done = versions(df.sparkSession, target)
    number = done[-1][0] + 1 if done else 0
    folder = f"{target.rstrip('/')}/v={number},{writer or uuid.uuid4().hex[:12]}"
    writer_ = df.write.mode("overwrite").options(**(options or {})).format(fmt)  # what an attempt left goes
    (writer_.partitionBy(*partition_by) if partition_by else writer_).save(folder)
    return folder


def newest(spark: SparkSession, target: str) -> str | None:
    """Folder of the newest committed version."""
    done = versions(spark, target)
    return done[-1][2] if done else None


def read_newest(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    folder = newest(spark, target)
    return spark.read.schema(schema).parquet(folder) if folder else spark.createDataFrame([], schema)


def drop_versions(spark: SparkSession, target: str, keep: int) -> list[str]:
    """Remove all versions but the newest ``keep`` committed ones, and return their folders.

    What was begun after the newest commit is left: its writer may be at work."""
    if keep < 1:
        raise ValueError("at least one version stays")
    done = versions(spark, target)
    if not done:
        return []
    kept = {folder for _, _, folder in done[-keep:]}
    gone = []
    for name in children(spark, target):
        folder = f"{target.rstrip('/')}/{name}"
        if name.startswith("v=") and folder not in kept and int(name[2:].split(",", 1)[0]) <= done[-1][0]:
            remove(spark, folder)
            gone.append(folder)
    return gone
