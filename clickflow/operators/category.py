"""J1 categories: click/order/pay counts, top-10 categories, top-10 sessions per category.

All counts are partial+final aggregates (map-side combine), so a hot category or
session is reduced before the shuffle.  The top-10 lists have a literal size bound,
so broadcasting them is safe at any data size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.functions.scalars import split_longs

KINDS = ("click", "order", "pay")


def _click_ids(detail: DataFrame) -> DataFrame:
    return detail.filter(F.col("click_category_id").isNotNull()).select(
        F.col("click_category_id").alias("category_id")
    )


def _list_ids(detail: DataFrame, col: str) -> DataFrame:
    return detail.filter(F.col(col).isNotNull()).select(F.explode(split_longs(col)).alias("category_id"))


def category_click_counts(detail: DataFrame) -> DataFrame:
    """A9 (click) + P7."""
    return _click_ids(detail).groupBy("category_id").agg(F.count(F.lit(1)).alias("click_count"))


def category_order_counts(detail: DataFrame) -> DataFrame:
    """A9 (order) + P7 + F15."""
    return _list_ids(detail, "order_category_ids").groupBy("category_id").agg(F.count(F.lit(1)).alias("order_count"))


def category_pay_counts(detail: DataFrame) -> DataFrame:
    """A9 (pay) + P7 + F15."""
    return _list_ids(detail, "pay_category_ids").groupBy("category_id").agg(F.count(F.lit(1)).alias("pay_count"))


def _all_ids(detail: DataFrame) -> Column:
    """Every category id an action mentions: click ∪ order list ∪ pay list."""
    empty = F.array().cast("array<bigint>")
    click = F.when(F.col("click_category_id").isNotNull(), F.array(F.col("click_category_id").cast("bigint")))
    return F.concat(
        F.coalesce(click, empty),
        F.coalesce(split_longs("order_category_ids"), empty),
        F.coalesce(split_longs("pay_category_ids"), empty),
    )


def category_ids(detail: DataFrame) -> DataFrame:
    """Distinct ids over click ∪ order ∪ pay, in one pass over the detail
    (one explode and one distinct instead of three scans and a union)."""
    return detail.select(F.explode(_all_ids(detail)).alias("category_id")).distinct()


def category_pairs(detail: DataFrame, *keep: str) -> DataFrame:
    """Each category an action clicks, orders or pays, with its kind: one row per pair."""
    def tagged(ids, kind):
        return F.transform(ids, lambda x: F.struct(x.alias("category_id"), F.lit(kind).alias("kind")))

    click = F.when(
        F.col("click_category_id").isNotNull(), F.array(F.col("click_category_id").cast("bigint"))
    ).otherwise(F.array().cast("array<bigint>"))
    order = F.coalesce(split_longs("order_category_ids"), F.array().cast("array<bigint>"))
    pay = F.coalesce(split_longs("pay_category_ids"), F.array().cast("array<bigint>"))
    pairs = F.concat(tagged(click, "click"), tagged(order, "order"), tagged(pay, "pay"))
    return detail.select(*keep, F.explode(pairs).alias("p")).select(*keep, "p.category_id", "p.kind")


def _by_kind() -> list:
    return [F.count(F.when(F.col("kind") == F.lit(k), F.lit(1))).alias(f"{k}_count") for k in KINDS]


def category_session_totals(detail: DataFrame) -> DataFrame:
    """The three counts per (category, session): all that the top categories and their top
    sessions need of the detail, in five narrow columns."""
    return category_pairs(detail, "session_id").groupBy("category_id", "session_id").agg(*_by_kind())


def sum_categories(totals: DataFrame) -> DataFrame:
    """:func:`category_counts` from :func:`category_session_totals`."""
    return totals.groupBy("category_id").agg(*[F.sum(f"{k}_count").cast("bigint").alias(f"{k}_count") for k in KINDS])


def category_counts(detail: DataFrame) -> DataFrame:
    """J-4: every category with its click/order/pay counts, missing → 0.

    Instead of three aggregates and three outer joins this is one pass: each action
    emits (category, kind) pairs and one aggregate counts per kind.  Same rows as
    ``ids ⟕ click ⟕ order ⟕ pay`` with ``coalesce(.., 0)``, one shuffle instead of six.
    """
    return category_pairs(detail).groupBy("category_id").agg(*_by_kind())


def top_categories(counts: DataFrame, n: int = 10) -> DataFrame:
    """Order by click, order, pay (all desc), id asc (D16); keep n.

    ``orderBy().limit(n)`` plans as ``TakeOrderedAndProject``: each task keeps its
    own top n, only n rows per task reach the final merge.
    """
    return counts.orderBy(
        F.col("click_count").desc(),
        F.col("order_count").desc(),
        F.col("pay_count").desc(),
        F.col("category_id").asc(),
    ).limit(n)


def category_session_counts(detail: DataFrame) -> DataFrame:
    """Clicks per (category, session)."""
    return (
        detail.filter(F.col("click_category_id").isNotNull())
        .groupBy(F.col("click_category_id").alias("category_id"), "session_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
    )


def top_sessions(counts: DataFrame, top_cats: DataFrame, n: int = 10) -> DataFrame:
    """J-5 + W3: the n sessions with most clicks in each top category, from counts per
    (category, session) (:func:`category_session_counts` or :func:`category_session_totals`).

    ``top_cats`` has at most 10 rows (a literal bound), so it is broadcast.  The
    ``row_number <= n`` filter becomes a ``WindowGroupLimit`` before the shuffle.
    """
    counts = counts.filter(F.col("click_count") > 0).join(
        F.broadcast(top_cats.select("category_id")), "category_id", "left_semi"
    )
    w = Window.partitionBy("category_id").orderBy(F.col("click_count").desc(), F.col("session_id").asc())
    return (
        counts.withColumn("rn", F.row_number().over(w))
        .filter(F.col("rn") <= F.lit(n))
        .select("category_id", "session_id", "click_count")
    )


def top_session_detail(detail: DataFrame, top: DataFrame, distinct: bool = False) -> DataFrame:
    """J-6: detail of the top sessions, once per category a session leads.

    ``top`` holds at most 10 × 10 rows, so it is broadcast.  ``distinct=True`` keeps
    each action once.
    """
    keys = top.select("session_id", "category_id")
    if distinct:
        return detail.join(F.broadcast(keys.select("session_id").distinct()), "session_id", "left_semi")
    return detail.join(F.broadcast(keys), "session_id", "inner")
