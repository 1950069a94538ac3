"""Plan-shape checks: the properties that matter at scale, asserted on physical plans."""

import pytest

import __spark_entry__ as E
from clickflow import plans
from tests.conftest import SF01

BATCH = sorted(n for n in plans.queries() if not n.startswith("stream_") and n != "append_results")


def _plan(spark, name) -> str:
    """The plan as compiled before running, without Spark's own choice of broadcasts by size: the
    test tables are small enough for any, so what is left is what a hint forces."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    own = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        return E.queries()[name](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, own)


def _subtrees(plan: str, marker: str) -> list[str]:
    """Text of every subtree rooted at a line containing ``marker``."""
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if marker not in line:
            continue
        depth = len(line) - len(line.lstrip(" :+-"))
        sub = [line]
        for nxt in lines[i + 1:]:
            if len(nxt) - len(nxt.lstrip(" :+-")) <= depth:
                break
            sub.append(nxt)
        out.append("\n".join(sub))
    return out


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_no_python_no_fact_broadcast(spark, name):
    plan = _plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, (name, bad)
    for sub in _subtrees(plan, "BroadcastExchange"):
        bounded = "TakeOrderedAndProject" in sub or "GlobalLimit" in sub  # top-n lists: literal bound
        assert bounded or "events.parquet" not in sub, (name, "fact table broadcast")


@pytest.mark.parametrize(
    "name", ["area_top3_product", "top10_category_session", "ad_province_top3", "session_sample"]
)
def test_topk_is_limited_before_the_shuffle(spark, name):
    plan = _plan(spark, name)
    assert "WindowGroupLimit" in plan, name


@pytest.mark.parametrize("name", ["area_top3_product", "session_aggr", "page_convert_rate"])
def test_date_range_reaches_the_scan(spark, name):
    text = _plan(spark, name)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-05T00:00)" in text or (
        "GreaterThanOrEqual(ts,2024-01-05T00:00)" in text
    ), name


def test_top10_categories_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(spark, "top10_category")


def test_aggregates_are_partial(spark):
    plan = _plan(spark, "session_aggr")
    assert "partial_min" in plan and "partial_collect_set" in plan


def test_funnel_window_is_chunked_and_copies_collapse_first(spark):
    import re

    plan = _plan(spark, "page_convert_rate")
    windows = re.findall(r"Window \[[^\n]*", plan)
    # the row-level window is partitioned by (session, chunk); the only window over
    # session_id alone runs on one row per chunk
    assert any(re.search(r"\[session_id#\d+, chunk#\d+\]", w) for w in windows), windows
    # identical actions are collapsed by a partial aggregate before any window
    assert re.search(r"HashAggregate\(keys=\[session_id#\d+, action_time#\d+, page_id#\d+L?\], functions=\[partial_count", plan)


def test_a_dimension_that_grows_is_not_broadcast_by_force(spark, tmp_path):
    """The same dimension path, first tiny and then large: no hint stays behind from the first look."""
    from clickflow.operators import area

    clicks = spark.read.schema("date date, city_id bigint, click_product_id bigint").parquet(_empty_clicks(spark, tmp_path))
    path = str(tmp_path / "cities")
    for rows in (10, 500_000):
        ids = spark.range(rows)
        ids.selectExpr("id AS city_id", "concat('c', id) AS city_name", "'a' AS area").write.mode("overwrite").parquet(path)
        plan = area.area_product_click_count(clicks, spark.read.parquet(path))._jdf.queryExecution()
        assert "broadcast" not in plan.optimizedPlan().toString().lower()


def _empty_clicks(spark, tmp_path):
    path = str(tmp_path / "clicks")
    rows = spark.range(20).selectExpr("DATE'2024-01-06' AS date", "id AS city_id", "id % 3 AS click_product_id")
    rows.write.parquet(path)
    return path


def test_no_shared_folder_on_a_cluster_is_an_error(spark, monkeypatch):
    from clickflow import config

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        config.checkpoint_root(Session())
