"""TESTDATA tables → the reference's input tables (mapping in FIXTURES.md §3).

The driver's parquet tables (``events``, ``customer``, ``nation``, ``region``,
``part``) are reshaped with column expressions only, so every derived table is a
lazy projection of a parquet scan: filters on ``ts`` and column pruning still reach
the scan.  The oracle SQL in :mod:`clickflow.plans.oracle` writes the same mapping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.config import configure_session

EPOCH_NTZ = "1970-01-01 00:00:00"


#: The schemas of the TESTDATA tables read here.  Naming them saves a job per table and call.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    read = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    # `props` is {"k": 0..99}
    return F.get_json_object("props", "$.k").cast("bigint")


def _events_in_range(spark: SparkSession, sf_dir: str, start_date: str | None, end_date: str | None) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    # Bounds on the raw timestamp column, so the parquet reader can skip row groups
    # (PushedFilters); a real action table would be partitioned by date instead.
    if start_date is not None:
        ev = ev.filter(F.col("ts") >= F.lit(start_date).cast("date").cast("timestamp_ntz"))
    if end_date is not None:
        ev = ev.filter(F.col("ts") < F.date_add(F.lit(end_date).cast("date"), 1).cast("timestamp_ntz"))
    return ev


def user_visit_action(
    spark: SparkSession, sf_dir: str, start_date: str | None = None, end_date: str | None = None
) -> DataFrame:
    """One action per event (13 columns, FIXTURES.md §3)."""
    configure_session(spark)
    ev = _events_in_range(spark, sf_dir, start_date, end_date).withColumn("k", _k())
    t = F.col("event_type")
    k = F.col("k")
    return ev.select(
        F.to_date("ts").alias("date"),
        F.col("user_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("_"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        (k % 10).alias("page_id"),
        F.date_trunc("second", F.col("ts")).cast("timestamp_ntz").alias("action_time"),
        F.when(t == "view", F.concat(F.lit("kw"), (k % 10).cast("string"))).alias("search_keyword"),
        F.when(t == "click", k).alias("click_category_id"),
        F.when(t == "click", k % 50).alias("click_product_id"),
        F.when(t == "signup", F.concat(k.cast("string"), F.lit(","), ((k + 1) % 100).cast("string"))).alias(
            "order_category_ids"
        ),
        F.when(t == "signup", (k % 50).cast("string")).alias("order_product_ids"),
        F.when(t == "purchase", k.cast("string")).alias("pay_category_ids"),
        F.when(t == "purchase", (k % 50).cast("string")).alias("pay_product_ids"),
        ((F.col("user_id") + F.col("event_id")) % 25).alias("city_id"),
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer ⋈ nation (nation is the fixed 25-row dimension)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey, "inner").select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lit("user"), F.col("c_custkey").cast("string")).alias("username"),
        F.col("c_name").alias("name"),
        (F.col("c_custkey") % 60).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.col("n_name").alias("city"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("male")).otherwise(F.lit("female")).alias("sex"),
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), (F.col("p_partkey") % 2).cast("string"), F.lit("}")).alias(
            "extend_info"
        ),
    )


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⋈ region: 25 cities in 5 areas (both fixed-size dimensions)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "inner").select(
        F.col("n_nationkey").cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


# Area → level mapping used with TESTDATA (FIXTURES.md §3).
TEST_AREA_LEVELS = {"ASIA": "A level", "EUROPE": "A level", "AMERICA": "B level", "AFRICA": "B level"}


def ad_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad click log as Kafka-like text lines plus the arrival batch number.

    ``value = "<epoch ms> <province> <city> <user_id> <ad_id>"``;
    ``batch_no = hour(ts) div 6`` (0-3).
    """
    configure_session(spark)
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "click").withColumn("k", _k())
    ev = ev.withColumn("city_id", (F.col("user_id") + F.col("event_id")) % 25)
    cities = city_info(spark, sf_dir)
    j = ev.join(cities, "city_id", "inner")
    micros = F.timestamp_diff("MICROSECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), F.col("ts"))
    ms = F.floor(micros / F.lit(1000)).cast("bigint")
    value = F.concat_ws(
        " ",
        ms.cast("string"),
        F.regexp_replace("area", " ", "_"),
        F.col("city_name"),
        F.col("user_id").cast("string"),
        (F.col("k") % 5).cast("string"),
    )
    return j.select(
        F.col("event_id"),
        value.alias("value"),
        (F.hour("ts") / 6).cast("int").alias("batch_no"),
    )


def cut_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the ad log that end after the second field, one per signup event."""
    configure_session(spark)
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    micros = F.timestamp_diff("MICROSECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), F.col("ts"))
    ms = F.floor(micros / F.lit(1000)).cast("bigint")
    return ev.select(
        F.col("event_id"),
        F.concat_ws(" ", ms.cast("string"), F.lit("NOWHERE")).alias("value"),
        (F.hour("ts") / 6).cast("int").alias("batch_no"),
    )


def ad_log_lines_by_time(spark: SparkSession, sf_dir: str, batches: int = 4) -> DataFrame:
    """:func:`ad_log_lines`, arriving in the order of their times: ``batch_no`` is the equal part of the log's
    time range that a line lies in."""
    lines = ad_log_lines(spark, sf_dir)
    ms = F.split("value", " ")[0].cast("bigint")
    first, last = lines.agg(F.min(ms)).scalar(), lines.agg(F.max(ms)).scalar()
    part = F.floor((ms - first) * F.lit(batches) / (last - first + F.lit(1))).cast("int")
    return lines.withColumn("batch_no", part)
