"""Whole-job entry points and the ad streaming pipeline."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from clickflow.config import work_dir
from clickflow.operators import ads, tables
from clickflow.operators.tables import BatchTable
from clickflow.params import AdParams
from clickflow.plans import jobs
from clickflow.plans import registry as Q
from clickflow.plans.replay import replay
from clickflow.sources import fixtures as fx
from clickflow.sources.readers import good_ad_lines, parse_ad_log, rejected_ad_lines
from clickflow.streaming import ads_stream as st
from tests.conftest import SF001


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_session_job_writes_every_result(spark):
    a = fx.user_visit_action(spark, SF001)
    res = jobs.session_job_results(a, fx.user_info(spark, SF001), Q.SESSION_PARAMS, seed=Q.SAMPLE_SEED)
    assert set(res) == {
        "session_aggr_stat", "session_random_extract", "session_detail", "top10_category",
        "top10_category_session", "top10_session_detail",
    }
    base = work_dir(spark, "test-jobs")
    paths = jobs.write_results(res, base, task_id=3)
    for name, path in paths.items():
        written = spark.read.parquet(path)
        assert written.columns[0] == "task_id", name
        assert written.count() == res[name].count(), name
    top = spark.read.parquet(paths["top10_category"])
    assert top.columns[0] == "task_id" and top.filter(F.col("task_id") == 3).count() == top.count()
    assert _rows(top.drop("task_id")) == _rows(Q.REGISTRY["top10_category"](spark, SF001))


def test_page_and_area_jobs(spark):
    a = fx.user_visit_action(spark, SF001)
    enc = jobs.page_job_results(a, Q.FUNNEL_PARAMS)["page_split_convert_rate"].collect()
    assert enc[0][0] == Q.REGISTRY["page_convert_rate_encoded"](spark, SF001).collect()[0][0]
    top = jobs.area_job_results(a, fx.city_info(spark, SF001), fx.product_info(spark, SF001), Q.AREA_PARAMS)
    assert top["area_top3_product"].count() == Q.REGISTRY["area_top3_product"](spark, SF001).count()


def test_ad_stat_with_date_watermark_matches_batch(spark):
    base = work_dir(spark, "test-ad-stat-wm")
    lines = fx.ad_log_lines(spark, SF001)
    table = st.sink_table(spark, f"{base}/table", "ad_stat")

    def start(stream, trigger):
        log = parse_ad_log(stream, keep=("event_id", "batch_no"))
        return st.start_ad_stat(log, table, f"{base}/ckpt", trigger=trigger, date_watermark="400 days")

    replay(spark, lines, "batch_no", f"{base}/source", start)
    log = parse_ad_log(lines, keep=("event_id", "batch_no"))
    assert _rows(table.read()) == _rows(ads.ad_stat(log))


def _check_pipeline(p, kept, n_rejected=0):
    """Every table of the pipeline equals its batch result over the kept clicks."""
    r = p.results()
    assert _rows(r["user_click_count"]) == _rows(ads.user_click_counts(kept))
    assert _rows(r["ad_stat"]) == _rows(ads.ad_stat(kept))
    assert _rows(r["province_top"]) == _rows(ads.province_top(ads.ad_stat(kept), 3))
    assert _rows(r["click_trend"]) == _rows(ads.click_trend(kept))
    assert _rows(r["click_trend_last_hour"]) == _rows(ads.click_trend(kept, last="60 minutes"))
    assert _rows(p.buckets()) == _rows(ads.bucket_counts(kept, p.params.slide))
    assert _rows(r["sliding_count"]) == _rows(ads.sliding_count(kept, p.params.window, p.params.slide))
    assert sum(x["n_lines"] for x in r["rejects"].collect()) == n_rejected


def test_start_ad_pipeline_end_to_end(spark):
    """The live pipeline with processing-time triggers, one query for all tables."""
    base = work_dir(spark, "test-live-pipeline")
    lines = fx.ad_log_lines(spark, SF001)
    holder = {}

    def start(stream, trigger):
        log = parse_ad_log(stream, keep=("event_id", "batch_no"))
        q, holder["p"] = st.start_ad_pipeline(log, f"{base}/out", AdParams(blacklist_threshold=2, trigger="0 seconds"))
        return q

    replay(spark, lines, "batch_no", f"{base}/source", start)
    kept = ads.blacklist_feedback(parse_ad_log(lines, keep=("event_id", "batch_no")), 2)
    _check_pipeline(holder["p"], kept)
    assert holder["p"].blacklist.read().count() > 0


@pytest.mark.parametrize("fail_at", range(7))
def test_a_batch_that_fails_between_writes_is_replayed_exactly_once(spark, monkeypatch, fail_at):
    """Fail every batch after its n-th table write, replay it twice, and compare."""
    rows = [(f"{1704067200000 + 1000 * i} p{i % 2} c {i % 5} {i % 3}", i // 10) for i in range(40)]
    rows += [("", 1), ("short line", 2), ("99999999999999999999 p c 1 1", 2), (None, 3)]
    log = parse_ad_log(spark.createDataFrame(rows, "value string, batch_no int"), keep=("batch_no",))
    p = st.AdPipeline(spark, work_dir(spark, "test-replay"), AdParams(blacklist_threshold=3), merge_every=2)
    real, left = BatchTable._write, [0]

    def write(self, df, path, by, **options):
        real(self, df, path, by, **options)
        left[0] -= 1
        if left[0] == 0:
            raise OSError("lost")

    monkeypatch.setattr(BatchTable, "_write", write)
    failed = 0
    for b in range(4):
        batch = log.filter(F.col("batch_no") == b)
        left[0] = fail_at
        if fail_at:  # three writes a batch, up to six where parts are merged
            try:
                p.process(batch, b)
            except OSError:
                failed += 1
        left[0] = 0
        p.process(batch, b)
        if fail_at % 2:
            p.process(batch, b)  # replayed although it had ended well
    assert failed >= (0 if not fail_at else 4 if fail_at <= 3 else 1)
    _check_pipeline(p, ads.blacklist_feedback(good_ad_lines(log), 3), n_rejected=4)


def test_bad_lines_and_null_keys_agree_in_batch_and_stream(spark):
    lines = ["1704067200000 p c 1 1", "", "x", "1704067200000 p c", "1704067200000 p c u 1", "-99999999999999999 p c 1 1",
             "1704067200000  c 1 1", "9223372036854775807 p c 1 1", "253402300799999 p c 1 1"]
    log = parse_ad_log(spark.createDataFrame([(x, i % 2) for i, x in enumerate(lines)], "value string, b int"), keep=("b",))
    assert log.count() == len(lines)
    assert [r.ts_ms for r in good_ad_lines(log).collect()] == [1704067200000, 1704067200000, 253402300799999]
    missing = {r.missing: r.n for r in rejected_ad_lines(log).groupBy("missing").agg(F.count("*").alias("n")).collect()}
    assert missing == {"ts_ms": 4, "user_id": 2}
    # rows with NULL keys, taken through the tables as they are
    target, updates = ads.ad_stat(log.filter("b = 0")), ads.ad_stat(log.filter("b = 1"))
    add = tables.upsert_add(target, updates, ads.STAT_KEYS)
    assert _rows_n(add) == _rows_n(ads.ad_stat(log))
    t = st.sink_table(spark, work_dir(spark, "test-null-keys"), "ad_stat_delta")
    t.write_batch(target, 0)
    t.write_batch(updates, 1)
    assert _rows_n(t.read()) == _rows_n(add)
    keys = updates.select(*ads.STAT_KEYS)
    assert _rows_n(t.read(keys=keys)) == _rows_n(tables.by_key(add, keys, ads.STAT_KEYS, "left_semi"))


def _rows_n(df):
    return sorted((tuple(str(x) for x in r) for r in df.collect()))


def test_stream_trend_drops_late_clicks_behind_the_watermark(spark):
    base = work_dir(spark, "test-trend-wm")
    at = lambda s: int(dt.datetime.fromisoformat(s).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    rows = [(f"{at('2024-01-01T10:00:05')} p c 1 1", 0), (f"{at('2024-01-01T12:00:00')} p c 1 1", 0),
            (f"{at('2024-01-01T10:00:30')} p c 1 1", 1), (f"{at('2024-01-01T11:30:00')} p c 1 1", 1)]
    table = st.sink_table(spark, f"{base}/table", "click_trend")

    def start(stream, trigger):
        return st.start_click_trend(parse_ad_log(stream), table, f"{base}/ckpt", trigger, watermark="1 hour")

    replay(spark, spark.createDataFrame(rows, "value string, batch_no int"), "batch_no", f"{base}/source", start)
    got = {(r.hour, r.minute): r.click_count for r in table.read().collect()}
    assert got == {("10", "00"): 1, ("11", "30"): 1, ("12", "00"): 1}


def test_stream_totals_of_an_ended_day_take_no_late_clicks(spark):
    base = work_dir(spark, "test-stat-wm")
    at = lambda s: int(dt.datetime.fromisoformat(s).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    rows = [(f"{at('2024-01-01T10:00:00')} p c 1 1", 0), (f"{at('2024-01-03T12:00:00')} p c 1 1", 0),
            (f"{at('2024-01-01T11:00:00')} p c 2 1", 1), (f"{at('2024-01-02T11:00:00')} p c 2 1", 1)]
    table = st.sink_table(spark, f"{base}/table", "ad_stat")

    def start(stream, trigger):
        return st.start_ad_stat(parse_ad_log(stream), table, f"{base}/ckpt", trigger, date_watermark="1 day")

    replay(spark, spark.createDataFrame(rows, "value string, batch_no int"), "batch_no", f"{base}/source", start)
    got = {(str(r.date), r.click_count) for r in table.read().collect()}
    assert got == {("2024-01-01", 1), ("2024-01-02", 1), ("2024-01-03", 1)}


def _tasks(spark):
    param = ('{"startDate": ["2024-01-05"], "endDate": ["2024-01-20"], "startAge": ["10"], "endAge": ["50"],'
             ' "sex": ["male"], "targetPageFlow": ["1,2,3,4"]}')
    return spark.createDataFrame([(7, param)], "task_id bigint, task_param string")


def test_jobs_from_task_row_to_tables(spark):
    base, tasks, a = work_dir(spark, "test-task-jobs"), _tasks(spark), fx.user_visit_action(spark, SF001)
    before = _work_folders(spark)
    paths = jobs.run_session_job(tasks, 7, a, fx.user_info(spark, SF001), base, seed=Q.SAMPLE_SEED)
    assert _work_folders(spark) == before  # intermediates are gone
    paths |= jobs.run_page_job(tasks, 7, a, base)
    paths |= jobs.run_area_job(tasks, 7, a, fx.city_info(spark, SF001), fx.product_info(spark, SF001), base)
    assert set(paths) == {
        "session_aggr_stat", "session_random_extract", "session_detail", "top10_category", "top10_category_session",
        "top10_session_detail", "page_split_convert_rate", "page_split_rates", "area_top3_product",
    }
    for name, path in paths.items():
        rows = spark.read.parquet(path)
        assert rows.columns[0] == "task_id" and {r[0] for r in rows.select("task_id").collect()} == {7}, name
    got = spark.read.parquet(paths["top10_category_session"]).drop("task_id")
    assert _rows(got) == _rows(Q.REGISTRY["top10_category_session"](spark, SF001))
    detail = spark.read.parquet(paths["session_detail"])
    assert detail.count() == Q.REGISTRY["session_sample_detail"](spark, SF001).count()


def _work_folders(spark):
    from clickflow.config import checkpoint_root, local_path

    folder = os.path.join(local_path(checkpoint_root(spark)), "clickflow")
    return {x for x in os.listdir(folder) if x.startswith(("kept-sessions", "category-sessions"))} if os.path.isdir(folder) else set()


def test_every_result_has_a_database_table_of_its_own(spark, monkeypatch):
    """No database runs here: only what the JDBC writer would be told is checked."""
    told = []

    class Writer:
        def __init__(self, **o):
            self.o = o

        def mode(self, m):
            return Writer(**self.o, mode=m)

        def format(self, f):
            return Writer(**self.o, format=f)

        def options(self, **o):
            return Writer(**self.o, **o)

        def save(self, *path):
            told.append((self.o, path))

    df = spark.range(1).toDF("x")
    monkeypatch.setattr(type(df), "write", property(lambda self: Writer()))
    jobs.write_results({"a": df, "b": df}, "shop.", 1, fmt="jdbc", url="jdbc:x", user="u")
    tables.append(df, "ad_stat", fmt="jdbc", mode="overwrite", url="jdbc:x")
    common = {"format": "jdbc", "url": "jdbc:x"}
    assert told == [
        ({**common, "mode": "append", "user": "u", "dbtable": "shop.a"}, ()),
        ({**common, "mode": "append", "user": "u", "dbtable": "shop.b"}, ()),
        ({**common, "mode": "overwrite", "dbtable": "ad_stat"}, ()),
    ]
