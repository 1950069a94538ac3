"""Session settings and the shared working folder.

Intermediate tables (stream staging, versioned upsert tables, stream checkpoints)
live under the folder the cluster names in ``spark.checkpoint.dir``, which is
shared storage on a real cluster.  Only a local session without that setting (unit
tests) gets a local one; on a cluster its absence is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the library relies on, applied to an existing session.  The time
# zone decides how instants are written as text; the others don't change a result.
SQL_DEFAULTS = {
    # Wall-clock semantics: all formatting of ad-log instants uses UTC, like the
    # reference formats in one fixed JVM zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffles, split skewed join partitions,
    # turn a join side into a broadcast only after its real size is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcasts are Spark's own choice by bytes (spark.sql.autoBroadcastJoinThreshold of the
    # session); hints stand only on lists bounded by a literal top-n.
}


# Settings for a large cluster (hundreds of executors, ~100 TB inputs).  Applied by
# ``configure_session(spark, large=True)``; sizes are per task, so they do not
# change with the data volume — the number of tasks does.
LARGE_SCALE = {
    # ~256 MB scan splits and post-shuffle partitions keep tasks short and in memory
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # enough initial shuffle partitions for AQE to coalesce down from
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    # a partition is skewed when > 5x the median and > 256 MB: split it
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    # split a skewed join also where that costs a further shuffle for the aggregate above it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # large streaming state (per-key totals, minute windows) off the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure_session(spark: SparkSession, large: bool = False) -> SparkSession:
    """Apply :data:`SQL_DEFAULTS` (and :data:`LARGE_SCALE` with ``large=True``)
    to ``spark`` (idempotent) and return it."""
    settings = dict(SQL_DEFAULTS, **(LARGE_SCALE if large else {}))
    for key, value in settings.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster; a local session may do without."""
    root = spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="clickflow-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the checkpoint root for one job's tables.

    It is removed when the driver's JVM ends; :func:`remove_dir` removes it earlier."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/clickflow/{name}-{uuid.uuid4().hex[:12]}"
    fs, p = _hadoop(spark, path)
    fs.deleteOnExit(p)
    return path


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder of :func:`work_dir` with all it holds."""
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)
    fs.cancelDeleteOnExit(p)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (used only by the local file-stream test harness)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
