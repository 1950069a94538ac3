"""Registered stream queries: the ad log replayed in its four arrival batches.

Each query runs the real Structured Streaming job (file-stream source standing in
for Kafka, one micro-batch per arrival batch) and returns the final state of its
sink as a batch DataFrame; the oracle is the same SQL as the batch form.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.config import work_dir
from clickflow.operators import ads
from clickflow.plans.output import to_output
from clickflow.plans.registry import AD_PARAMS, BLACKLIST_THRESHOLD, LOG_COLS, query
from clickflow.plans.replay import LogProducer, replay
from clickflow.sources import fixtures as fx
from clickflow.sources.line_log import line_log_stream
from clickflow.sources.readers import good_ad_lines, parse_ad_log
from clickflow.streaming import ads_stream as st
from clickflow.streaming import click_runs


def _run(spark: SparkSession, sf: str, name: str, starter, lines: DataFrame | None = None) -> str:
    base = work_dir(spark, name)
    lines = fx.ad_log_lines(spark, sf) if lines is None else lines

    def start(stream: DataFrame, trigger: str):
        log = parse_ad_log(stream, keep=("event_id", "batch_no"))
        return starter(log, base, trigger)

    replay(spark, lines, "batch_no", f"{base}/source", start)
    return base


@query("stream_ad_log_parse")
def q_stream_ad_log_parse(spark, sf):
    def starter(log, base, trigger):
        return st.start_log_sink(log, f"{base}/out", f"{base}/ckpt", trigger=trigger)

    base = _run(spark, sf, "stream_ad_log_parse", starter)
    return to_output(spark.read.parquet(f"{base}/out").select("event_id", "batch_no", *LOG_COLS))


@query("stream_ad_user_click_count")
def q_stream_ad_user_click_count(spark, sf):
    holder = {}

    def starter(log, base, trigger):
        holder["t"] = t = st.sink_table(spark, f"{base}/table", "counts")
        return st.start_user_click_count(log, t, f"{base}/ckpt", trigger=trigger)

    _run(spark, sf, "stream_ad_user_click_count", starter)
    return to_output(holder["t"].read())


@query("stream_ad_blacklist")
def q_stream_ad_blacklist(spark, sf):
    def starter(log, base, trigger):
        counts = st.sink_table(spark, f"{base}/counts", "counts")
        bl = st.sink_table(spark, f"{base}/blacklist", "blacklist")
        return st.start_blacklist(
            log, f"{base}/kept", counts, bl, f"{base}/ckpt", threshold=BLACKLIST_THRESHOLD, trigger=trigger
        )

    base = _run(spark, sf, "stream_ad_blacklist", starter)
    kept = spark.read.parquet(f"{base}/kept/*")
    return to_output(kept.select("event_id", "batch_no", *LOG_COLS))


def _table_query(spark, sf, name, kind, start_fn, **kw):
    holder = {}

    def starter(log, base, trigger):
        holder["t"] = t = st.sink_table(spark, f"{base}/table", kind)
        return start_fn(log, t, f"{base}/ckpt", trigger=trigger, **kw)

    _run(spark, sf, name, starter)
    return holder["t"].read()


@query("stream_ad_stat")
def q_stream_ad_stat(spark, sf):
    return to_output(_table_query(spark, sf, "stream_ad_stat", "ad_stat", st.start_ad_stat))


@query("stream_ad_province_top3")
def q_stream_ad_province_top3(spark, sf):
    return to_output(_table_query(spark, sf, "stream_ad_province_top3", "province_top", st.start_province_top))


@query("stream_ad_click_trend")
def q_stream_ad_click_trend(spark, sf):
    return to_output(_table_query(spark, sf, "stream_ad_click_trend", "click_trend", st.start_click_trend))


@query("stream_ad_click_trend_last_hour")
def q_stream_ad_click_trend_last_hour(spark, sf):
    """The last hour, read back from the trend table of the stream."""
    trend = _table_query(spark, sf, "stream_ad_click_trend_last_hour", "click_trend", st.start_click_trend)
    return to_output(ads.last_of_trend(trend, "60 minutes"))


@query("stream_ad_click_trend_watermark")
def q_stream_ad_click_trend_watermark(spark, sf):
    """A click whose minute has ended before the watermark (ten days behind the newest
    click of the batches before) is dropped and its state is gone."""
    return to_output(
        _table_query(
            spark, sf, "stream_ad_click_trend_watermark", "click_trend", st.start_click_trend, watermark="10 days"
        )
    )


@query("stream_ad_sliding_count")
def q_stream_ad_sliding_count(spark, sf):
    buckets = _table_query(
        spark, sf, "stream_ad_sliding_count", "buckets", st.start_sliding_count, slide=AD_PARAMS.slide
    )
    return to_output(ads.spread_buckets(buckets, AD_PARAMS.window, AD_PARAMS.slide))


@query("stream_ad_pipeline")
def q_stream_ad_pipeline(spark, sf):
    """The whole job in one stream; every result table as rows of (result, date, key, n).  Among the clicks
    arrive lines that were cut short, one per signup."""
    holder = {}

    def starter(log, base, trigger):
        params = replace(AD_PARAMS, trigger=trigger)
        q, holder["p"] = st.start_ad_pipeline(log, f"{base}/out", params)
        return q

    lines = fx.ad_log_lines(spark, sf).unionByName(fx.cut_log_lines(spark, sf))
    _run(spark, sf, "stream_ad_pipeline", starter, lines)
    r = holder["p"].results()
    day = F.date_format("date", "yyyy-MM-dd")
    start = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")
    clicks = F.col("click_count")
    parts = [
        ("user_click_count", day, ("user_id", "ad_id"), clicks),
        ("blacklist", F.lit(""), ("user_id",), F.lit(1)),
        ("ad_stat", day, ("province", "city", "ad_id"), clicks),
        ("province_top", day, ("province", "ad_id"), clicks),
        ("click_trend", F.col("date"), ("hour", "minute", "ad_id"), clicks),
        ("click_trend_last_hour", F.col("date"), ("hour", "minute", "ad_id"), clicks),
        ("sliding_count", start, ("ad_id",), clicks),
        ("rejects", F.lit(""), ("missing",), F.col("n_lines")),
    ]
    rows = [
        r[name].select(F.lit(name).alias("result"), d.alias("date"), F.concat_ws("|", *keys).alias("key"), n.cast("bigint").alias("n"))
        for name, d, keys, n in parts
    ]
    return reduce(DataFrame.unionByName, rows)


@query("stream_ad_click_trend_late")
def q_stream_ad_click_trend_late(spark, sf):
    """The minute trend with an account of its late clicks: a click whose minute ended ten days or more
    before the newest click of earlier batches is counted as late, and both add up to all clicks."""
    holder = {}

    def starter(log, base, trigger):
        params = replace(AD_PARAMS, trigger=trigger, lateness="10 days", blacklist_threshold=1 << 62)
        q, holder["p"] = st.start_ad_pipeline(log, f"{base}/out", params)
        return q

    _run(spark, sf, "stream_ad_click_trend_late", starter)
    r = holder["p"].results()
    kinds = [("on time", r["click_trend"]), ("late", r["late_clicks"])]
    return to_output(reduce(DataFrame.unionByName, [df.withColumn("arrival", F.lit(name)) for name, df in kinds]))


IDLE_MS = 2 * 86_400_000


@query("stream_ad_click_runs")
def q_stream_ad_click_runs(spark, sf):
    """Z4 / Z9 with expiry: the runs of clicks per (user, ad), two days idle ending one.  Clicks arrive
    in four batches by time; runs that ended were emitted, the others are what the state store still holds."""

    def starter(log, base, trigger):
        return click_runs.start_click_runs(
            good_ad_lines(log), f"{base}/out", f"{base}/ckpt", IDLE_MS, delay="1 hour", trigger=trigger
        )

    base = _run(spark, sf, "stream_ad_click_runs", starter, fx.ad_log_lines_by_time(spark, sf))
    ended = spark.read.schema(click_runs.RUN_SCHEMA).parquet(f"{base}/out").withColumn("state", F.lit("ended"))
    still = click_runs.open_runs(spark, f"{base}/ckpt").withColumn("state", F.lit("open"))
    return ended.unionByName(still)


@query("stream_line_log_restart")
def q_stream_line_log_restart(spark, sf):
    """The log from a source with partitions and offsets.  The query is stopped after two arrival
    batches and started again from its checkpoint: every line is read once."""
    base = work_dir(spark, "stream_line_log_restart")
    lines = fx.ad_log_lines(spark, sf)
    user = F.split("value", " ")[3].cast("bigint")
    log = LogProducer(lines.withColumn("partition", F.pmod(user, F.lit(3)).cast("int")), "partition", "batch_no", f"{base}/log")
    arrived = log.batches()
    for part in (arrived[:2], arrived[2:]):
        q = None
        try:
            for batch in part:
                log.publish(batch)
                if q is None:
                    parsed = parse_ad_log(line_log_stream(spark, f"{base}/log"), keep=("partition", "segment"))
                    q = st.start_log_sink(parsed, f"{base}/out", f"{base}/ckpt", trigger="200 milliseconds")
                q.processAllAvailable()
        finally:
            if q is not None:
                q.stop()
    return to_output(spark.read.parquet(f"{base}/out").select("partition", *LOG_COLS))
