"""Whole jobs, as the reference runs them: one call computes every result of a job
and appends it, tagged with the task id, to the result tables (K1-K3, K9).

Intermediate results read by several outputs (the kept sessions, the counts per category
and session) are written once as narrow parquet tables into the cluster's shared work
folder (``spark.checkpoint.dir``): that cuts their lineage, so a lost executor re-reads
the table instead of recomputing from the raw actions.  The ``run_*`` calls remove them.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.config import configure_session, remove_dir
from clickflow.operators import area, category, funnel, sampling, session, tables
from clickflow.params import AreaParams, FunnelParams, SessionParams
from clickflow.sources.readers import scan_actions_by_date


def session_job_results(
    actions: DataFrame,
    users: DataFrame,
    params: SessionParams,
    sample_total: int = 100,
    seed: str = "0",
    top_categories: int = 10,
    top_sessions: int = 10,
    intermediates: list[str] | None = None,
) -> dict[str, DataFrame]:
    """Every result of the session-analysis job, keyed by result table name.

    The folders of its intermediates are added to ``intermediates``, for the caller to remove
    once the results are written (:func:`run_session_job` does)."""
    spark = actions.sparkSession
    configure_session(spark)
    acts = scan_actions_by_date(actions, params.start_date, params.end_date)
    info = session.session_aggr_info(session.session_aggr(acts), users)
    kept = tables.materialize(
        session.session_filter(info, params).select(
            "session_id", "start_time", "visit_length", "step_length", "search_keywords", "click_category_ids"
        ),
        "kept-sessions",
        intermediates,
    )
    detail = session.session_detail(acts, kept)
    totals = tables.materialize(category.category_session_totals(detail), "category-sessions", intermediates)
    sampled = sampling.sample(kept, sample_total, seed)
    top = category.top_categories(category.sum_categories(totals), top_categories)
    top_sess = category.top_sessions(totals, top, top_sessions)
    return {
        "session_aggr_stat": session.length_ratios(session.length_stats(kept)),
        "session_random_extract": sampled.select(
            "session_id",
            F.date_format("start_time", "yyyy-MM-dd HH:mm:ss").alias("start_time"),
            F.array_join("search_keywords", ",").alias("search_keywords"),
            F.array_join("click_category_ids", ",").alias("click_category_ids"),
        ),
        "session_detail": sampling.sample_detail(acts, sampled),
        "top10_category": top,
        "top10_category_session": top_sess,
        "top10_session_detail": category.top_session_detail(detail, top_sess),
    }


def page_job_results(actions: DataFrame, params: FunnelParams, chunk: str | None = "hour") -> dict[str, DataFrame]:
    """The encoded conversion rates (and the per-step table)."""
    configure_session(actions.sparkSession)
    acts = scan_actions_by_date(actions, params.start_date, params.end_date)
    rates = funnel.page_convert_rate(acts, params, chunk)
    return {"page_split_convert_rate": funnel.encode_convert_rate(rates), "page_split_rates": rates}


def area_job_results(
    actions: DataFrame, cities: DataFrame, products: DataFrame, params: AreaParams = AreaParams()
) -> dict[str, DataFrame]:
    """Top-N products per area."""
    configure_session(actions.sparkSession)
    return {"area_top3_product": area.area_top_products(actions, cities, products, params)}


def write_results(results: Mapping[str, DataFrame], base: str, task_id: int, fmt: str = "parquet",
                  **options: str) -> dict[str, str]:
    """Append each result with the task id (executors write): to ``base/<name>``, or with
    ``fmt="jdbc"`` to the database table ``base + name`` (``base`` may be empty or a schema
    prefix), each result to a table of its own.  Returns where each went."""
    out = {}
    for name, df in results.items():
        target = f"{base}{name}" if fmt == "jdbc" else f"{base.rstrip('/')}/{name}"
        out[name] = tables.append(df, target, task_id=task_id, fmt=fmt, **options)
    return out


def run_session_job(tasks: DataFrame, task_id: int, actions: DataFrame, users: DataFrame, base: str,
                    fmt: str = "parquet", options: Mapping[str, str] | None = None, **kw) -> dict[str, str]:
    """J1 from a row of the task table to stored results; intermediates are removed at the end."""
    spark, made = actions.sparkSession, []
    try:
        params = SessionParams.from_task(tasks, task_id)
        results = session_job_results(actions, users, params, intermediates=made, **kw)
        return write_results(results, base, task_id, fmt, **(options or {}))
    finally:
        for path in made:
            remove_dir(spark, path)


def run_page_job(tasks: DataFrame, task_id: int, actions: DataFrame, base: str, fmt: str = "parquet",
                 options: Mapping[str, str] | None = None) -> dict[str, str]:
    """J2 from a row of the task table to stored results."""
    results = page_job_results(actions, FunnelParams.from_task(tasks, task_id))
    return write_results(results, base, task_id, fmt, **(options or {}))


def run_area_job(tasks: DataFrame, task_id: int, actions: DataFrame, cities: DataFrame, products: DataFrame,
                 base: str, fmt: str = "parquet", options: Mapping[str, str] | None = None) -> dict[str, str]:
    """J3 from a row of the task table to stored results."""
    results = area_job_results(actions, cities, products, AreaParams.from_task(tasks, task_id))
    return write_results(results, base, task_id, fmt, **(options or {}))
