"""Stored layouts of the action table that save work on every later read.

* :func:`bucketed`: a table bucketed and sorted by ``session_id``.  Building it is one shuffle; then joins on the
  session (J-2, J-3, J-6) read matching buckets side by side and shuffle neither table.
* :func:`dated` and :func:`actions_of_task`: a table with a folder per ``date`` (S1, K9), and a scan
  of the range that a task row names.  The row is read inside the query, as scalar subqueries
  that are known before folders are listed: dynamic partition pruning, without the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.config import work_dir
from clickflow.params import task_param_columns


def bucketed(df: DataFrame, name: str, key: str = "session_id", buckets: int | None = None, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table bucketed and sorted by ``key`` and read it back.

    Without ``path`` the files lie in the shared work folder and go when the driver ends; the
    table is then known to this session's catalog only.  Tables to be joined need the same ``buckets`` (by default
    the session's shuffle partitions).  A key that holds many rows makes its bucket larger; a bucket is
    read by one task, so give the table more buckets than a task's memory needs."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex[:12]}".replace("-", "_")
    dealt = df.repartition(n, key)  # a file a bucket
    writer = dealt.write.format("parquet").bucketBy(n, key).sortBy(key)
    writer.option("path", path or work_dir(spark, name)).saveAsTable(table)
    return spark.table(table)


def with_bucket(rows: DataFrame, keys: DataFrame, key: str = "session_id", how: str = "left_semi") -> DataFrame:
    """Join two bucketed tables on their bucket key: a merge join of sorted buckets, no shuffle."""
    return rows.join(keys.hint("merge"), key, how)


def dated(actions: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write actions with a folder per ``date`` and read them back."""
    actions.write.mode(mode).partitionBy("date").parquet(path)
    return actions.sparkSession.read.schema(actions.schema).parquet(path)


def _task_value(tasks: DataFrame, task_id: int, value: Column) -> Column:
    return tasks.filter(F.col("task_id") == F.lit(task_id)).agg(F.min(value)).scalar()


def actions_of_task(actions: DataFrame, tasks: DataFrame, task_id: int) -> DataFrame:
    """Actions in the date range of a task row; a missing bound is open, an unknown task has no actions."""
    parsed = tasks.select("task_id", *task_param_columns(F.col("task_param")))
    start = _task_value(parsed, task_id, F.to_date("startDate"))
    end = _task_value(parsed, task_id, F.to_date("endDate"))
    known = _task_value(parsed, task_id, F.col("task_id")).isNotNull()
    low = start.isNull() | (F.col("date") >= start)
    high = end.isNull() | (F.col("date") <= end)
    return actions.filter(known & low & high)
