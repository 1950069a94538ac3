"""J4 ad-click analyses in batch form (the streaming jobs reuse these per micro-batch).

Input is the parsed ad log (:func:`clickflow.sources.readers.parse_ad_log`):
``ts`` (instant), ``date``, ``province``, ``city``, ``user_id``, ``ad_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.operators.tables import upsert_add

USER_AD_KEYS = ("date", "user_id", "ad_id")
STAT_KEYS = ("date", "province", "city", "ad_id")
TREND_KEYS = ("date", "hour", "minute", "ad_id")


def blacklist_filter(log: DataFrame, blacklist: DataFrame) -> DataFrame:
    """J-9/X2: drop clicks of blacklisted users (anti join; AQE broadcasts a small list)."""
    return log.join(blacklist.select("user_id").distinct(), "user_id", "left_anti")


def user_click_counts(log: DataFrame) -> DataFrame:
    """Clicks per (date, user, ad)."""
    return log.groupBy(*USER_AD_KEYS).agg(F.count(F.lit(1)).alias("click_count"))


def blacklist_lookup(batch_counts: DataFrame, totals: DataFrame, threshold: int = 100) -> DataFrame:
    """S8/J-10/P13/A17: users with a batch key whose accumulated count ``>= threshold``.

    Only keys present in this batch are looked up (absent total → 0).
    """
    keys = list(USER_AD_KEYS)
    hits = batch_counts.select(*keys).join(totals.select(*keys, "click_count"), keys, "left")
    return hits.filter(F.coalesce(F.col("click_count"), F.lit(0)) >= F.lit(threshold)).select("user_id").distinct()


def generate_blacklist(
    batch_counts: DataFrame, accumulated: DataFrame, threshold: int = 100
) -> tuple[DataFrame, DataFrame]:
    """Z3 core for one batch: (new accumulated counts, newly blacklisted users)."""
    totals = upsert_add(accumulated, batch_counts, USER_AD_KEYS)
    return totals, blacklist_lookup(batch_counts, totals, threshold)


def blacklist_feedback(log: DataFrame, threshold: int = 100, batch_col: str = "batch_no") -> DataFrame:
    """Z3 as one batch plan: the clicks a self-updating blacklist lets through.

    A user's breach batch is the first batch in which some (date, ad) count of the
    user, accumulated over batches, reaches ``threshold``; that user's clicks are
    kept up to and including the breach batch.  Exact when the count table and the
    blacklist start empty, since nothing of a user is dropped before the breach.
    """
    keys = list(USER_AD_KEYS)
    per_batch = log.groupBy(*keys, batch_col).agg(F.count(F.lit(1)).alias("n"))
    cum = F.sum("n").over(
        Window.partitionBy(*keys).orderBy(batch_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    breach = (
        per_batch.withColumn("cum", cum)
        .filter(F.col("cum") >= F.lit(threshold))
        .groupBy("user_id")
        .agg(F.min(batch_col).alias("breach_batch"))
    )
    return (
        log.join(breach, "user_id", "left")
        .filter(F.col("breach_batch").isNull() | (F.col(batch_col) <= F.col("breach_batch")))
        .drop("breach_batch")
    )


def ad_stat(log: DataFrame) -> DataFrame:
    """Z4 (batch): running total per (date, province, city, ad)."""
    return log.groupBy(*STAT_KEYS).agg(F.count(F.lit(1)).alias("click_count"))


def province_click_count(stat: DataFrame) -> DataFrame:
    """Drop the city from the key and sum."""
    return stat.groupBy("date", "province", "ad_id").agg(F.sum("click_count").cast("bigint").alias("click_count"))


def province_top(stat: DataFrame, n: int = 3) -> DataFrame:
    """W2/P14 (D9): top-n ads per (date, province); ties by ad_id ascending."""
    w = Window.partitionBy("date", "province").orderBy(F.col("click_count").desc(), F.col("ad_id").asc())
    return (
        province_click_count(stat)
        .withColumn("rn", F.row_number().over(w))
        .filter(F.col("rn") <= F.lit(n))
        .select("date", "province", "ad_id", "click_count")
    )


def minute_key_columns(minute_ts) -> list:
    """date / hour / minute text of a minute bucket."""
    return [
        F.date_format(minute_ts, "yyyy-MM-dd").alias("date"),
        F.date_format(minute_ts, "HH").alias("hour"),
        F.date_format(minute_ts, "mm").alias("minute"),
    ]


def click_trend(log: DataFrame, last: str | None = None) -> DataFrame:
    """Z6 (D8): full clicks per (event minute, ad).

    ``last='60 minutes'`` keeps the minute buckets of the last hour before the
    newest event (a scalar subquery, no driver round trip).
    """
    m = log.select(F.date_trunc("minute", F.col("ts")).alias("minute_ts"), "ad_id")
    if last is not None:
        newest = log.select(F.date_trunc("minute", F.max("ts"))).scalar()
        m = m.filter(F.col("minute_ts") > newest - F.expr(f"INTERVAL {last}"))
    counts = m.groupBy("minute_ts", "ad_id").agg(F.count(F.lit(1)).alias("click_count"))
    return counts.select(*minute_key_columns(F.col("minute_ts")), "ad_id", "click_count")


def last_of_trend(trend: DataFrame, last: str = "60 minutes") -> DataFrame:
    """The rows of a trend table (batch result or stream sink) whose minute lies in the last
    ``last`` before its newest minute."""
    minute = F.to_timestamp(F.concat_ws(" ", "date", F.concat_ws(":", "hour", "minute")), "yyyy-MM-dd HH:mm")
    newest = trend.agg(F.max(minute)).scalar()
    return trend.filter(minute > newest - F.expr(f"INTERVAL {last}"))


def bucket_counts(log: DataFrame, slide: str = "10 seconds") -> DataFrame:
    """Z7, first step: clicks per ad in tumbling buckets of one slide."""
    counts = log.groupBy(F.window("ts", slide).alias("b"), "ad_id").agg(F.count(F.lit(1)).alias("click_count"))
    return counts.select(F.col("b.start").alias("bucket"), "ad_id", "click_count")


def bucket_start(ts, slide: str = "10 seconds"):
    """The start of the tumbling bucket that holds ``ts``; unlike ``window()`` it keeps rows without a time."""
    s_s = _seconds(slide)
    if not s_s:
        raise ValueError(f"{slide} is not a fixed number of seconds")
    seconds = F.unix_seconds(ts)
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(s_s)))


def spread_buckets(
    buckets: DataFrame, window: str = "60 minutes", slide: str = "10 seconds", chunk: str = "1 day"
) -> DataFrame:
    """Z7, second step: bucket counts summed over every window that holds the bucket, by an
    inverse function: a count enters the sum at its first window and leaves after its last.

    Each bucket becomes two difference marks (+n, -n) instead of a row a window (360 for
    60 min / 10 s).  Marks are summed per ad and start, and a running sum gives the count of
    every window up to the next mark.  A hot ad is no hot task: the running sum stays inside a
    ``chunk`` of an ad's time and takes the total of the chunks before as carry, from one row
    a chunk.  A bucket whose marks lie in two chunks adds a third mark of nothing, where
    the second begins, so that a sum carried over starts there.

    Exact when the window is a whole number of slides, since all events of a bucket lie in
    the same windows."""
    w_s, s_s = _seconds(window), _seconds(slide)
    if not w_s or not s_s or w_s % s_s:
        raise ValueError(f"{window} is not a whole number of {slide}")
    c_s = -(-max(_seconds(chunk) or 0, w_s) // s_s) * s_s  # at least a window, a whole number of slides
    bs, n = F.unix_seconds("bucket"), F.col("click_count")
    enters, leaves = bs - F.lit(w_s - s_s), bs + F.lit(s_s)
    begin = leaves - F.pmod(leaves, F.lit(c_s))  # of the chunk in which the count leaves
    entered, left = F.struct(enters.alias("s"), n.alias("n")), F.struct(leaves.alias("s"), (-n).alias("n"))
    carried = F.struct(begin.alias("s"), F.lit(0).cast("bigint").alias("n"))
    marks = F.when(enters < begin, F.array(entered, left, carried)).otherwise(F.array(entered, left))
    mark = buckets.select("ad_id", F.explode(marks).alias("m")).select("ad_id", "m.s", "m.n")
    chunk_of = F.floor(F.col("s") / F.lit(c_s))
    sums = mark.groupBy("ad_id", "s").agg(F.sum("n").alias("n")).withColumn("c", chunk_of)
    totals = mark.groupBy("ad_id", chunk_of.alias("c")).agg(F.sum("n").alias("n"))
    before = Window.partitionBy("ad_id").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        F.col("ad_id").alias("_ad"), F.col("c").alias("_c"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("carry")
    )
    inside = Window.partitionBy("ad_id", "c").orderBy("s")
    running = sums.select(
        "ad_id",
        "c",
        "s",
        F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("sum"),
        F.coalesce(F.lead("s").over(inside), (F.col("c") + 1) * F.lit(c_s)).alias("next"),
    )
    whole = running.join(carry, F.col("ad_id").eqNullSafe(F.col("_ad")) & (F.col("c") == F.col("_c"))).select(
        "ad_id", "s", "next", (F.col("sum") + F.col("carry")).cast("bigint").alias("click_count")
    )
    starts = F.explode(F.sequence(F.col("s"), F.col("next") - F.lit(s_s), F.lit(s_s))).alias("start")
    return (
        whole.filter("click_count > 0")
        .select("ad_id", "click_count", starts)
        .select(
            F.timestamp_seconds("start").alias("window_start"),
            F.timestamp_seconds(F.col("start") + F.lit(w_s)).alias("window_end"),
            "ad_id",
            "click_count",
        )
    )


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _seconds(interval: str) -> int | None:
    """``'60 minutes'`` → 3600; None for anything but ``<n> <unit>``."""
    parts = interval.split()
    if len(parts) != 2 or not parts[0].isdigit():
        return None
    unit = parts[1].lower().rstrip("s")
    return int(parts[0]) * _UNIT_SECONDS[unit] if unit in _UNIT_SECONDS else None


def sliding_count(
    log: DataFrame, window: str = "60 minutes", slide: str = "10 seconds", preaggregate: bool = True
) -> DataFrame:
    """Clicks per ad in every sliding window.

    ``window()`` would copy each click into window/slide windows (360 for 60 min / 10 s)
    before aggregating.  Clicks are counted per bucket of one slide first, and
    :func:`spread_buckets` sums those counts over the windows.  A window that is no whole number of
    slides, or ``preaggregate=False``, takes ``window()``.
    """
    w_s, s_s = _seconds(window), _seconds(slide)
    if preaggregate and w_s and s_s and w_s % s_s == 0:
        return spread_buckets(bucket_counts(log, slide), window, slide)
    return (
        log.groupBy(F.window("ts", window, slide).alias("w"), "ad_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "ad_id", "click_count")
    )
