"""Sources: table scans, JDBC and Kafka builders, and the ad-log parser.

Scans stay declarative so Catalyst pushes the date predicate to the reader (and
prunes partitions when the action table is partitioned by ``date``).
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.functions.scalars import millis_to_time

AD_LOG_COLUMNS = ("ts_ms", "province", "city", "user_id", "ad_id")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Generic batch table source (parquet by default)."""
    return spark.read.format(fmt).options(**options).load(path)


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """A JDBC table (e.g. ``city_info``, ``task``, ``ad_blacklist``).

    With ``partition_column`` and bounds Spark reads it in parallel ranges; the
    driver class must be on the cluster classpath (not bundled here).
    """
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column is not None:
        r = (
            r.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions or 8))
        )
    return r.load()


def kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topics: str,
    starting_offsets: str = "latest",
    **options: str,
) -> DataFrame:
    """Kafka source, comma-separated topic list; yields a string ``value`` column."""
    r = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topics)
        .option("startingOffsets", starting_offsets)
    )
    for k, v in options.items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"))


def scan_actions_by_date(actions: DataFrame, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """Actions with ``start_date <= date <= end_date``; a missing bound is open."""
    out = actions
    if start_date is not None:
        out = out.filter(F.col("date") >= F.lit(start_date).cast("date"))
    if end_date is not None:
        out = out.filter(F.col("date") <= F.lit(end_date).cast("date"))
    return out


def scan_click_actions(actions: DataFrame, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """S2 (D13): click actions in the date range → (city_id, product_id)."""
    return (
        scan_actions_by_date(actions, start_date, end_date)
        .filter(F.col("click_product_id").isNotNull())
        .select("city_id", F.col("click_product_id").alias("product_id"))
    )


# Epoch milliseconds of the years 1 to 9999: beyond them a time has no text form.
FIRST_MS, LAST_MS = -62135596800000, 253402300799999


def parse_ad_log(lines: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``"<epoch ms> <province> <city> <user_id> <ad_id>"`` → typed columns, once.

    Adds ``ts`` (timestamp instant) and ``date``.  No line fails the batch: a missing
    field, a malformed number and a time out of range become NULL.  :func:`good_ad_lines`
    and :func:`rejected_ad_lines` split such rows off.
    """
    parts = F.split(F.col(value_col), " ")
    raw = F.get(parts, 0).try_cast("bigint")
    ms = F.when(raw.between(FIRST_MS, LAST_MS), raw)
    return lines.select(
        *keep,
        ms.alias("ts_ms"),
        millis_to_time(ms).alias("ts"),
        F.to_date(millis_to_time(ms)).alias("date"),
        F.get(parts, 1).alias("province"),
        F.get(parts, 2).alias("city"),
        F.get(parts, 3).try_cast("bigint").alias("user_id"),
        F.get(parts, 4).try_cast("bigint").alias("ad_id"),
    )


def good_ad_lines(log: DataFrame) -> DataFrame:
    """Parsed rows with every field."""
    return log.filter(~_missing_field())


def rejected_ad_lines(log: DataFrame) -> DataFrame:
    """Parsed rows that lack a field, with ``missing``: the first field that is NULL."""
    return log.filter(_missing_field()).withColumn("missing", first_missing_field())


def first_missing_field():
    """The name of a parsed line's first NULL field; NULL for a good line."""
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in AD_LOG_COLUMNS])


def _missing_field():
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in AD_LOG_COLUMNS])
