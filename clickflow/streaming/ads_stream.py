"""J4 as Structured Streaming jobs.

Source: Kafka text lines (:func:`clickflow.sources.readers.kafka_stream`) or, in
tests, a file stream with the same ``value`` column.  Each job parses once (P3)
and writes through ``foreachBatch`` into a :class:`BatchTable`: micro-batch
``b`` writes only its changes, into a folder named by ``b``, so a batch replayed
after a failure overwrites itself and totals are never added twice (D14); merges rewrite
only the dates or key parts that changed.

:class:`AdPipeline` is the whole job in one query: all its tables are written from the
same micro-batch under the same batch id, so a batch that fails between two writes and
is replayed leaves every table as if it had run once.  The single-table jobs keep
running totals and minute counts in Spark's checkpointed state store.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from clickflow.operators import ads
from clickflow.operators.tables import BatchTable
from clickflow.params import AdParams
from clickflow.sources.readers import first_missing_field

DATE_T = T.DateType()
USER_COUNT_SCHEMA = T.StructType(
    [
        T.StructField("date", DATE_T),
        T.StructField("user_id", T.LongType()),
        T.StructField("ad_id", T.LongType()),
        T.StructField("click_count", T.LongType()),
    ]
)
BLACKLIST_SCHEMA = T.StructType([T.StructField("user_id", T.LongType())])
STAT_SCHEMA = T.StructType(
    [
        T.StructField("date", DATE_T),
        T.StructField("province", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("ad_id", T.LongType()),
        T.StructField("click_count", T.LongType()),
    ]
)
TOP_SCHEMA = T.StructType(
    [
        T.StructField("date", DATE_T),
        T.StructField("province", T.StringType()),
        T.StructField("ad_id", T.LongType()),
        T.StructField("click_count", T.LongType()),
    ]
)
TREND_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("hour", T.StringType()),
        T.StructField("minute", T.StringType()),
        T.StructField("ad_id", T.LongType()),
        T.StructField("click_count", T.LongType()),
    ]
)
BUCKET_SCHEMA = T.StructType(
    [
        T.StructField("bucket", T.TimestampType()),
        T.StructField("ad_id", T.LongType()),
        T.StructField("click_count", T.LongType()),
    ]
)
FACT_SCHEMA = T.StructType(
    [
        T.StructField("result", T.StringType()),
        T.StructField("date", DATE_T),
        T.StructField("province", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("ad_id", T.LongType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("missing", T.StringType()),
        T.StructField("click_count", T.LongType()),
    ]
)
FACT_KEYS = tuple(f.name for f in FACT_SCHEMA.fields[:-1])


def _trigger(w: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """``'5 seconds'`` → processing-time micro-batches; ``None`` → availableNow."""
    return w.trigger(availableNow=True) if trigger is None else w.trigger(processingTime=trigger)


def _foreach(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, trigger: str | None,
             mode: str = "append", name: str | None = None) -> StreamingQuery:
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(fn)
    if name:
        w = w.queryName(name)
    return _trigger(w, trigger).start()


def start_log_sink(log: DataFrame, path: str, checkpoint: str, trigger: str | None = "5 seconds") -> StreamingQuery:
    """Parsed log → parquet (append; the file sink's own log makes it exactly-once)."""
    w = log.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return _trigger(w.outputMode("append"), trigger).start()


#: Parts of a table without a date in its keys, by a hash of the key.
KEY_PARTS = 8


def sink_table(spark: SparkSession, path: str, kind: str, merge_every: int = 20) -> BatchTable:
    """The sink table of one ad result.  ``counts`` adds; ``blacklist`` is a set; ``ad_stat``,
    ``click_trend`` and ``buckets`` take running totals and replace; ``ad_stat_delta`` takes a batch's own
    counts and adds; ``province_top`` replaces (date, province) groups; ``facts`` adds the counts of
    :func:`batch_facts`, a part per day; ``newest`` holds the newest minute of each batch."""
    spec = {
        "counts": (USER_COUNT_SCHEMA, ads.USER_AD_KEYS, "add", "date"),
        "blacklist": (BLACKLIST_SCHEMA, ("user_id",), "set", f"pmod(xxhash64(user_id), {KEY_PARTS})"),
        "ad_stat": (STAT_SCHEMA, ads.STAT_KEYS, "replace", "date"),
        "ad_stat_delta": (STAT_SCHEMA, ads.STAT_KEYS, "add", "date"),
        "province_top": (TOP_SCHEMA, ("date", "province"), "replace_groups", "date"),
        "click_trend": (TREND_SCHEMA, ads.TREND_KEYS, "replace", "date"),
        "buckets": (BUCKET_SCHEMA, ("bucket", "ad_id"), "replace", "to_date(bucket)"),
        "newest": (T.StructType([T.StructField("at", T.TimestampType())]), ("at",), "set", "'all'"),
        "facts": (FACT_SCHEMA, FACT_KEYS, "add", "coalesce(date, to_date(at))"),
    }[kind]
    schema, keys, mode, part = spec
    sort = ("result",) if kind == "facts" else ()
    return BatchTable(spark, path, schema, keys, mode, "click_count", part=part, merge_every=merge_every, sort=sort)


def start_user_click_count(
    log: DataFrame, table: BatchTable, checkpoint: str, trigger: str | None = "5 seconds"
) -> StreamingQuery:
    """A15 + K4: per-batch (date, user, ad) counts added into the accumulated table."""

    def batch(df: DataFrame, batch_id: int) -> None:
        table.write_batch(ads.user_click_counts(df), batch_id)

    return _foreach(log, batch, checkpoint, trigger)


def start_blacklist(
    log: DataFrame,
    kept_path: str,
    counts: BatchTable,
    blacklist: BatchTable,
    checkpoint: str,
    threshold: int = 100,
    trigger: str | None = "5 seconds",
) -> StreamingQuery:
    """Z2 + Z3: filter by the current blacklist, then count → upsert-add → lookup →
    threshold → new blacklisted users, effective from the next micro-batch.

    The kept clicks of batch ``b`` are written to ``kept_path/b<b>`` (overwrite:
    idempotent on replay) and counted from that written copy, so the source is read
    once per batch.  The lookup reads accumulated counts only for the batch's keys
    (semi join; other dates are not opened).  Both later steps read the
    written counts of the batch, so each is computed once.
    """
    spark = log.sparkSession

    def batch(df: DataFrame, batch_id: int) -> None:
        current = blacklist.read(batch_id - 1)
        kept_dir = f"{kept_path}/b{batch_id:012d}"
        ads.blacklist_filter(df, current).write.mode("overwrite").parquet(kept_dir)
        counts.write_batch(ads.user_click_counts(spark.read.parquet(kept_dir)), batch_id)
        batch_counts = counts.changes(batch_id)
        totals = counts.read(batch_id, keys=batch_counts.select(*ads.USER_AD_KEYS), touched_by=batch_id)
        blacklist.write_batch(ads.blacklist_lookup(batch_counts, totals, threshold), batch_id)

    return _foreach(log, batch, checkpoint, trigger)


def start_ad_stat(
    log: DataFrame, table: BatchTable, checkpoint: str, trigger: str | None = "5 seconds",
    date_watermark: str | None = None,
) -> StreamingQuery:
    """Z4 + K5: running totals per (date, province, city, ad) in the state store; each
    micro-batch emits the changed keys (update mode) and replaces them in the table.

    Z9: state never expires by default.  With ``date_watermark`` the day is an
    event-time window (``window(ts, '1 day')``), so Spark drops a day's totals once
    the watermark passes its end (late clicks for it are then ignored).
    """
    if date_watermark:
        totals = (
            log.withWatermark("ts", date_watermark)
            .groupBy(F.window("ts", "1 day").alias("d"), "province", "city", "ad_id")
            .agg(F.count(F.lit(1)).alias("click_count"))
            .select(F.to_date(F.col("d.start")).alias("date"), "province", "city", "ad_id", "click_count")
        )
    else:
        totals = ads.ad_stat(log)

    def batch(df: DataFrame, batch_id: int) -> None:
        table.write_batch(df, batch_id)

    return _foreach(totals, batch, checkpoint, trigger, mode="update")


def start_province_top(
    log: DataFrame, table: BatchTable, checkpoint: str, n: int = 3, trigger: str | None = "5 seconds"
) -> StreamingQuery:
    """Z5 + W2 + K7: top-n ads per (date, province), refreshed each micro-batch.

    A batch's own counts are added to a ``totals`` table next to this one; only the
    (date, province) groups it touched are ranked again, from those dates' totals, and
    replaced.  ``row_number`` is not allowed on a stream, so ranking runs inside
    ``foreachBatch``.
    """
    totals = sink_table(log.sparkSession, f"{table.path}/totals", "ad_stat_delta", table.merge_every)

    def batch(df: DataFrame, batch_id: int) -> None:
        totals.write_batch(ads.ad_stat(df), batch_id)
        groups = totals.changes(batch_id).select("date", "province")
        table.write_batch(ads.province_top(totals.read(batch_id, keys=groups, touched_by=batch_id), n), batch_id)

    return _foreach(log, batch, checkpoint, trigger)


def start_click_trend(
    log: DataFrame, table: BatchTable, checkpoint: str, trigger: str | None = "5 seconds",
    watermark: str | None = None,
) -> StreamingQuery:
    """Z6 + Z8 (D8): full per-minute counts by event time, upserted per micro-batch.

    With ``watermark`` the per-minute state is dropped once the minute is older than
    the watermark; the last hour is selected when the table is read.
    """
    src = log.withWatermark("ts", watermark) if watermark else log
    counts = src.groupBy(F.window("ts", "1 minute").alias("w"), "ad_id").agg(F.count(F.lit(1)).alias("click_count"))

    def batch(df: DataFrame, batch_id: int) -> None:
        table.write_batch(df.select(*ads.minute_key_columns(F.col("w.start")), "ad_id", "click_count"), batch_id)

    return _foreach(counts, batch, checkpoint, trigger, mode="update")


def start_sliding_count(
    log: DataFrame, table: BatchTable, checkpoint: str, slide: str = "10 seconds",
    trigger: str | None = "5 seconds", watermark: str | None = None,
) -> StreamingQuery:
    """One count per (bucket of a slide, ad) in the state store, upserted per batch into a
    ``buckets`` table; :func:`clickflow.operators.ads.spread_buckets` makes the sliding
    windows when it is read."""
    src = log.withWatermark("ts", watermark) if watermark else log

    def batch(df: DataFrame, batch_id: int) -> None:
        table.write_batch(df, batch_id)

    return _foreach(ads.bucket_counts(src, slide), batch, checkpoint, trigger, mode="update")


def batch_facts(
    df: DataFrame, blacklist: DataFrame, slide: str = "10 seconds", watermark: Column | None = None
) -> DataFrame:
    """Every count of a parsed micro-batch in one pass (grouping sets): clicks per (date, user, ad), per (date,
    province, city, ad), per (minute, ad) and per (bucket of a slide, ad), and rejected lines by
    their first missing field.  Good lines of blacklisted users are left out.

    Z8: with ``watermark`` (a time) the minutes that ended by then take no more clicks: those are
    counted per (minute, ad) as ``late_clicks`` instead, so trend and late clicks add up to all."""
    minute = F.date_trunc("minute", "ts")
    ended = F.lit(False) if watermark is None else F.coalesce(minute + F.expr("INTERVAL 1 MINUTE") <= watermark, F.lit(False))
    lines = df.select(
        "date", "province", "city", "user_id", "ad_id", first_missing_field().alias("missing"),
        minute.alias("minute"), ads.bucket_start(F.col("ts"), slide).alias("bucket"), ended.alias("late"),
    )
    listed = blacklist.select(F.col("user_id").alias("_listed")).distinct()
    kept = lines.join(listed, F.col("missing").isNull() & (F.col("user_id") == F.col("_listed")), "left_anti")
    every = [F.col(c) for c in lines.columns]
    date, province, city, user, ad, missing, minute, bucket, late = every
    sets = [[date, user, ad, missing], [date, province, city, ad, missing], [minute, ad, missing, late], [bucket, ad, missing]]
    sets.append([missing])
    has = lambda c: F.grouping(c) == 0
    result = (
        F.when(has("user_id"), F.lit("user_click_count"))
        .when(has("city"), F.lit("ad_stat"))
        .when(has("minute"), F.when(F.col("late"), F.lit("late_clicks")).otherwise(F.lit("click_trend")))
        .when(has("bucket"), F.lit("sliding_count"))
        .otherwise(F.lit("rejects"))
    )
    counts = kept.groupingSets(sets, *every).agg(F.count(F.lit(1)).alias("click_count"), result.alias("result"))
    rejected = F.col("result") == F.lit("rejects")
    return counts.filter(rejected == F.col("missing").isNotNull()).select(
        "result", "date", "province", "city", "user_id", "ad_id", F.coalesce("minute", "bucket").alias("at"), "missing", "click_count"
    )


class AdPipeline:
    """The whole J4 job as one micro-batch function over tables under ``base`` (shared storage).

    Each micro-batch is read and parsed once: :func:`batch_facts` filters the good lines by the current
    blacklist and yields the counts of every result in one aggregate, which is one write into
    ``facts``.  New blacklisted users (effective from the next batch) and the top-n of the
    touched (date, province) groups follow from the totals of the parts the batch touched.  All
    writes carry the batch id and reads go up to it, so a batch may fail between any two writes
    and be replayed, and nothing is counted twice.
    """

    def __init__(self, spark: SparkSession, base: str, params: AdParams = AdParams(), merge_every: int = 20):
        self.spark, self.base, self.params = spark, base.rstrip("/"), params
        self.facts, self.blacklist, self.province_top, self.newest = (
            sink_table(spark, f"{self.base}/{kind}", kind, merge_every)
            for kind in ("facts", "blacklist", "province_top", "newest")
        )

    def _watermark(self, batch_id: int) -> Column | None:
        """``lateness`` before the newest minute of earlier batches (a scalar subquery)."""
        if self.params.lateness is None:
            return None
        return self.newest.read(batch_id - 1).agg(F.max("at")).scalar() - F.expr(f"INTERVAL {self.params.lateness}")

    def process(self, df: DataFrame, batch_id: int) -> None:
        facts = batch_facts(df, self.blacklist.read(batch_id - 1), self.params.slide, self._watermark(batch_id))
        self.facts.write_batch(facts, batch_id)
        own = self.facts.changes(batch_id)
        if self.params.lateness is not None:
            minutes = own.filter(F.col("result").isin("click_trend", "late_clicks"))
            self.newest.write_batch(minutes.agg(F.max("at").alias("at")).filter("at IS NOT NULL"), batch_id)
        counts = own.filter("result = 'user_click_count'").select(*ads.USER_AD_KEYS, "click_count")
        totals = self._result("user_click_count", batch_id, counts.select(*ads.USER_AD_KEYS))
        self.blacklist.write_batch(ads.blacklist_lookup(counts, totals, self.params.blacklist_threshold), batch_id)
        groups = own.filter("result = 'ad_stat'").select("date", "province")
        top = ads.province_top(self._result("ad_stat", batch_id, groups), self.params.top_n)
        self.province_top.write_batch(top, batch_id)

    def _result(self, result: str, batch_id: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """The totals of one result, after a batch in the parts it touched for some keys."""
        return self.facts.read(batch_id, keys, batch_id, where=f"result = '{result}'")

    def buckets(self) -> DataFrame:
        return self._result("sliding_count").select(F.col("at").alias("bucket"), "ad_id", "click_count")

    def results(self) -> dict[str, DataFrame]:
        """The current state of every result."""
        trend = self._result("click_trend").select(*ads.minute_key_columns(F.col("at")), "ad_id", "click_count")
        return {
            "user_click_count": self._result("user_click_count").select(*ads.USER_AD_KEYS, "click_count"),
            "blacklist": self.blacklist.read(),
            "ad_stat": self._result("ad_stat").select(*ads.STAT_KEYS, "click_count"),
            "province_top": self.province_top.read(),
            "click_trend": trend,
            "click_trend_last_hour": ads.last_of_trend(trend),
            "sliding_count": ads.spread_buckets(self.buckets(), self.params.window, self.params.slide),
            "late_clicks": self._result("late_clicks").select(
                *ads.minute_key_columns(F.col("at")), "ad_id", "click_count"
            ),
            "rejects": self._result("rejects").select("missing", F.col("click_count").alias("n_lines")),
        }


def start_ad_pipeline(log: DataFrame, base: str, params: AdParams = AdParams()) -> tuple[StreamingQuery, AdPipeline]:
    """Start :class:`AdPipeline` on a parsed log."""
    pipeline = AdPipeline(log.sparkSession, base, params)
    query = _foreach(log, pipeline.process, f"{pipeline.base}/ckpt", params.trigger, name=None)
    return query, pipeline
