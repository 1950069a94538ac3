"""Replay a table as a stream, one arrival batch at a time (for the registered queries and tests).

Rows are written by executors into a staging folder partitioned by arrival batch,
and each batch is then published into the source folder with one directory rename
(atomic on HDFS and local file systems).  The driver only lists folder names.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# start(stream_df, trigger) -> StreamingQuery, started with that processing-time trigger
Starter = Callable[[DataFrame, str], StreamingQuery]


def _rename(spark: SparkSession, src: str, dst: str) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    s, d = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    fs = d.getFileSystem(conf)
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise OSError(f"could not publish {src} as {dst}")


def _staged_batches(spark: SparkSession, staging: str, part: str) -> list[tuple[str, str]]:
    """(value, folder) of each ``part=value`` folder written under ``staging``."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(staging)
    out = []
    for st in p.getFileSystem(conf).listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(part + "="):
            out.append((name[len(part) + 1:], st.getPath().toString()))
    return out


def replay(
    spark: SparkSession,
    rows: DataFrame,
    batch_col: str,
    source_dir: str,
    start: Starter,
    trigger: str = "200 milliseconds",
) -> None:
    """Stage ``rows`` batch by batch under ``source_dir`` and drive one running query.

    All arrival batches are staged by one partitioned write (the rows keep their
    own ``batch_col``; a copy is the partition column).  The query is started once
    (``start(stream, trigger)``); then, in batch order, each staged folder is
    published into the source folder by one rename and ``processAllAvailable``
    waits until the query has committed it.  A rename is atomic, so each arrival
    batch becomes exactly one micro-batch, in order.
    """
    schema = rows.schema
    staging = source_dir.rstrip("/") + "_staging"
    part = "_arrival"
    rows.withColumn(part, F.col(batch_col)).write.mode("overwrite").partitionBy(part).parquet(staging)
    staged = _staged_batches(spark, staging, part)
    dtype = schema[batch_col].dataType.simpleString()
    numeric = dtype in ("tinyint", "smallint", "int", "bigint")
    staged.sort(key=lambda x: int(x[0]) if numeric else x[0])
    q = None
    try:
        for i, (b, folder) in enumerate(staged):
            _rename(spark, folder, f"{source_dir}/b{i:06d}")
            if q is None:
                # one sub-folder per arrival batch; the glob is re-listed on every trigger
                q = start(spark.readStream.schema(schema).parquet(f"{source_dir}/*"), trigger)
            q.processAllAvailable()
            if q.exception() is not None:
                raise RuntimeError(f"stream failed on batch {b}: {q.exception()}")
    finally:
        if q is not None:
            q.stop()


class LogProducer:
    """Publishes rows as a line log (:mod:`clickflow.sources.line_log`), one arrival batch at a time.

    Executors write all lines into a staging folder at once; publishing renames each
    partition's share of a batch to that partition's next segment."""

    def __init__(self, rows: DataFrame, partition: str, batch: str, path: str):
        self.spark, self.path, self.staging = rows.sparkSession, path.rstrip("/"), path.rstrip("/") + "_staging"
        staged = rows.select("value", F.col(partition).alias("partition"), F.col(batch).alias("batch"))
        staged.write.mode("overwrite").partitionBy("batch", "partition").text(self.staging)
        self.segments: dict[str, int] = {}

    def batches(self) -> list[int]:
        return sorted(int(b) for b, _ in _staged_batches(self.spark, self.staging, "batch"))

    def publish(self, batch: int) -> None:
        for p, folder in sorted(_staged_batches(self.spark, f"{self.staging}/batch={batch}", "partition")):
            segment = self.segments.get(p, 0)
            _rename(self.spark, folder, f"{self.path}/partition={p}/segment={segment}")
            self.segments[p] = segment + 1
