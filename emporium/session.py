"""Spark session defaults and shared-storage helpers.

Cluster jobs read every tuning knob from the session they are given (``fit_shuffles``
makes three of them finer by the size of the input); the builder here is for tests,
the bench and local runs only.
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "emporium") -> SparkSession:
    """A local session tuned like the cluster profile (AQE on, UTC, no UI)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("EMPORIUM_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only when it is unset (tests, local runs) do we set one of our
    own under a fresh scratch folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="emporium-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


#: Source bytes for each shuffle partition that adaptive execution starts from, and scanned or
#: shuffled bytes that one task takes: rows of the fact hold some twelve times that in memory.
SOURCE_BYTES, TASK_BYTES = 4 << 20, 16 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_PER_TASK = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions that a shuffle begins with."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(n, int(spark.conf.get(_INITIAL, None) or n))


def fit_shuffles(spark: SparkSession, source_bytes: int) -> None:
    """Let the number of shuffle partitions follow the input, so that a task's memory doesn't.

    Adaptive execution joins small partitions but never cuts one (but for skewed joins): it
    has to begin with enough of them.  The session's own values are only ever made finer.
    """
    spark.conf.set(_INITIAL, max(shuffle_partitions(spark), -(-source_bytes // SOURCE_BYTES)))
    as_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for conf in _PER_TASK:
        if as_bytes(spark.conf.get(conf)) > TASK_BYTES:
            spark.conf.set(conf, str(TASK_BYTES))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
