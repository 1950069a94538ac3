"""J1 time-proportional session sampling (A7, A8, R1, R2, R3, W6, J-11, J-3).

Per day, ``E = total div days`` sessions are drawn, spread over the hours of that
day in proportion to each hour's session count.  The draw is a seeded hash order
(``md5(seed‖session_id)``), so it is repeatable and identical in any engine.

Scale: the quota table has one row per (date, hour); the only global values
(number of days) come from a scalar subquery.  Each hour keeps at most
``total + 1`` sessions, a literal bound, so the ranking is cut by a
``WindowGroupLimit`` on every task before the shuffle — a hot hour never ships
more than ``total + 1`` rows per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.functions.scalars import idiv


def _with_date_hour(sessions: DataFrame) -> DataFrame:
    return sessions.withColumn("date", F.to_date("start_time")).withColumn("hour", F.date_format("start_time", "HH"))


def session_hour_counts(sessions: DataFrame) -> DataFrame:
    """Sessions per (date, hour of start_time)."""
    return _with_date_hour(sessions).groupBy("date", "hour").agg(F.count(F.lit(1)).alias("session_count"))


def sample_quota(sessions: DataFrame, total: int = 100, strict: bool = False) -> DataFrame:
    """A8 + R1 (D6): per (date, hour): ``n = floor(count / day_total · E)``,
    quota ``least(n + 1, count)`` (``strict=True``: ``least(n, count)``)."""
    hours = session_hour_counts(sessions)
    days = hours.select(F.count_distinct("date")).scalar()
    e = idiv(F.lit(total), days).cast("bigint")
    day_total = F.sum("session_count").over(Window.partitionBy("date"))
    n = F.floor(F.col("session_count").cast("double") / F.col("day_total").cast("double") * e.cast("double"))
    draws = n if strict else n + F.lit(1)
    return (
        hours.withColumn("day_total", day_total)
        .withColumn("extract_number", e)
        .withColumn("quota", F.least(draws.cast("bigint"), F.col("session_count")))
    )


def sample(sessions: DataFrame, total: int = 100, seed: str = "0", strict: bool = False) -> DataFrame:
    """R2/W6/J-11: the sampled sessions (at most ``quota`` per hour)."""
    quota = sample_quota(sessions, total, strict).select("date", "hour", "quota")
    s = _with_date_hour(sessions)
    w = Window.partitionBy("date", "hour").orderBy(
        F.md5(F.concat(F.lit(seed + "|"), F.col("session_id"))), F.col("session_id")
    )
    ranked = s.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= F.lit(total + 1))
    return (
        ranked.join(quota, ["date", "hour"], "inner")
        .filter(F.col("rn") <= F.col("quota"))
        .drop("rn", "quota")
    )


def sample_detail(detail: DataFrame, sampled: DataFrame) -> DataFrame:
    """R3/J-3: actions of the sampled sessions (ids are unique → semi join)."""
    return detail.join(sampled.select("session_id"), "session_id", "left_semi")
