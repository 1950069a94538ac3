"""J1 core: per-session aggregates, user join, filter, length histograms and ratios.

``session_aggr`` is one shuffle on ``session_id`` with partial aggregation: min/max/
count and the distinct keyword/category sets combine map-side, so a session holding
a large share of all actions is reduced before it is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clickflow.functions.scalars import ratio, seconds_between
from clickflow.params import SessionParams

# Visit-length buckets in seconds, [low, high] inclusive; None = open.
VISIT_BUCKETS = (
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 29),
    ("30s_60s", 30, 59),
    ("1m_3m", 60, 179),
    ("3m_10m", 180, 599),
    ("10m_30m", 600, 1799),
    ("30m", 1800, None),
)
# Step-length buckets (actions per session), inclusive.
STEP_BUCKETS = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 29),
    ("30_60", 30, 59),
    ("60", 60, None),
)


def session_aggr(actions: DataFrame) -> DataFrame:
    """A1: one row per session.

    ``search_keywords`` / ``click_category_ids`` are sorted arrays of distinct
    non-empty values (D3); nulls are skipped (D2).  ``visit_length`` is whole
    seconds between first and last action, ``step_length`` the number of actions.
    """
    kw = F.when(F.col("search_keyword") != F.lit(""), F.col("search_keyword"))
    agg = actions.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.array_sort(F.collect_set(kw)).alias("search_keywords"),
        F.array_sort(F.collect_set("click_category_id")).alias("click_category_ids"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
    )
    return agg.select(
        "session_id",
        "user_id",
        "search_keywords",
        "click_category_ids",
        "start_time",
        "end_time",
        seconds_between(F.col("end_time"), F.col("start_time")).alias("visit_length"),
        "step_length",
    )


def session_aggr_info(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """J-1: add the user's age, professional, city and sex (inner: unknown users drop)."""
    u = users.select("user_id", "age", "professional", "city", "sex")
    return sessions.join(u, "user_id", "inner")


def between_param(c: Column, low, high) -> Column:
    """Both bounds set → ``low <= c <= high`` (NULL data fails); a bound missing → pass."""
    if low is None or high is None:
        return F.lit(True)
    return F.coalesce(c.between(F.lit(low), F.lit(high)), F.lit(False))


def in_param(c: Column, values, is_array: bool = False, cast: str | None = None) -> Column:
    """Any overlap of the data value(s) with the parameter list; unset → pass."""
    if values is None:
        return F.lit(True)
    lits = [F.lit(v).cast(cast) if cast else F.lit(v) for v in values]
    if is_array:
        return F.coalesce(F.arrays_overlap(c, F.array(*lits)), F.lit(False))
    return F.coalesce(c.isin(*lits), F.lit(False))


def equal_param(c: Column, value) -> Column:
    """P10: ``c = value``; unset → pass; NULL data fails."""
    if value is None:
        return F.lit(True)
    return F.coalesce(c == F.lit(value), F.lit(False))


def session_filter_condition(p: SessionParams) -> Column:
    """AND of age (D1: startAge/endAge), professional, city, sex, keywords, categories."""
    conds = [
        between_param(F.col("age"), p.start_age, p.end_age),
        in_param(F.col("professional"), p.professionals),
        in_param(F.col("city"), p.cities),
        in_param(F.col("sex"), p.sex),
        in_param(F.col("search_keywords"), p.keywords, is_array=True),
        in_param(F.col("click_category_ids"), p.category_ids, is_array=True, cast="bigint"),
    ]
    return reduce(lambda a, b: a & b, conds)


def session_filter(info: DataFrame, p: SessionParams) -> DataFrame:
    """P11 applied (the date range is applied at the scan, S1)."""
    return info.filter(session_filter_condition(p))


def _bucket(c: Column, low: int, high: int | None) -> Column:
    cond = c >= F.lit(low) if high is None else c.between(F.lit(low), F.lit(high))
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def _length_counters() -> list[Column]:
    v, s = F.col("visit_length"), F.col("step_length")
    cols = [F.count(F.lit(1)).alias("session_count")]
    cols += [_bucket(v, lo, hi).alias(f"visit_{name}") for name, lo, hi in VISIT_BUCKETS]
    cols += [_bucket(s, lo, hi).alias(f"step_{name}") for name, lo, hi in STEP_BUCKETS]
    return cols


def length_stats(sessions: DataFrame) -> DataFrame:
    """A2-A4: one row: session_count and the 15 bucket counts (0 s / 0 steps fall in none).

    A plain global aggregate: partial sums per task, one tiny final merge.
    """
    return sessions.agg(*_length_counters())


class ObservedLengths:
    """A4: the counters of :func:`length_stats`, filled while the sessions are written.

    The reference's accumulator does this by side effect, where a task that runs twice counts
    twice.  ``watch`` marks the DataFrame that is written next; the counters lie in the write's own
    stage, of which Spark takes each task's figures once, however often it was tried.
    No second pass over the sessions is needed."""

    def __init__(self, name: str = "session_lengths"):
        self._seen = Observation(name)

    def watch(self, sessions: DataFrame) -> DataFrame:
        return sessions.observe(self._seen, *_length_counters())

    def stats(self, like: DataFrame) -> DataFrame:
        """One row as :func:`length_stats` of the written sessions; waits for the write."""
        found = self._seen.get
        schema = length_stats(like).schema
        # sums over no rows are NULL, here as there
        return like.sparkSession.createDataFrame([tuple(found.get(c) for c in schema.names)], schema)


def length_ratios(stats: DataFrame) -> DataFrame:
    """Each bucket / session_count by the D4 rule; no row when session_count = 0."""
    n = F.col("session_count")
    cols = [n]
    cols += [ratio(F.col(f"visit_{name}"), n).alias(f"visit_length_{name}_ratio") for name, _, _ in VISIT_BUCKETS]
    cols += [ratio(F.col(f"step_{name}"), n).alias(f"step_length_{name}_ratio") for name, _, _ in STEP_BUCKETS]
    return stats.filter(n > 0).select(*cols)


def session_detail(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """J-2: actions of the kept sessions (semi join; AQE splits a skewed session)."""
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")
