"""The registered queries: each ``(spark, sf_dir) -> DataFrame`` over the TESTDATA tables.

Parameters are the fixed test parameters of FIXTURES.md §3.  The job queries read the
actions of their date range (S1, the feature); all others read the whole given tables
(through the fixture mapping).  A call builds its plan anew and returns a lazy DataFrame;
the queries that write an intermediate, append results or replay a stream run jobs when
called.  The matching DuckDB SQL lives in :mod:`clickflow.plans.oracle`.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.config import configure_session, work_dir
from clickflow.functions import scalars as S
from clickflow.functions.udfs import concat_long_string, group_concat_distinct, json_field
from clickflow.operators import ads, area, category, funnel, membership, sampling, session, tables
from clickflow.params import AdParams, AreaParams, FunnelParams, SessionParams, task_param_columns
from clickflow.plans.output import to_output
from clickflow.sources import fixtures as fx
from clickflow.sources import layout
from clickflow.sources.readers import parse_ad_log, scan_actions_by_date, scan_click_actions

# Test parameters (FIXTURES.md §3).
START_DATE = "2024-01-05"
END_DATE = "2024-01-20"
SESSION_PARAMS = SessionParams(start_date=START_DATE, end_date=END_DATE, start_age=10, end_age=50, sex=("male",))
SESSION_PARAMS_ALL = SessionParams(
    start_date=START_DATE,
    end_date=END_DATE,
    start_age=10,
    end_age=50,
    professionals=("BUILDING", "MACHINERY", "HOUSEHOLD"),
    cities=tuple(f"NATION_{i}" for i in range(0, 25, 2)),
    sex=("male",),
    keywords=("kw1", "kw3", "kw5", "kw7"),
    category_ids=tuple(range(0, 100, 3)),
)
FUNNEL_PARAMS = FunnelParams(flow=(1, 2, 3, 4), start_date=START_DATE, end_date=END_DATE)
AREA_PARAMS = AreaParams(start_date=START_DATE, end_date=END_DATE, levels=fx.TEST_AREA_LEVELS, level_else="D level")
BLACKLIST_THRESHOLD = 2
AD_PARAMS = AdParams(blacklist_threshold=BLACKLIST_THRESHOLD)
SAMPLE_TOTAL = 100
SAMPLE_SEED = "42"
TOP_N_CATEGORIES = 10
TOP_N_SESSIONS = 10

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    """Register ``fn`` under ``name``."""

    def deco(fn):
        REGISTRY[name] = fn
        return fn

    return deco


def out(df: DataFrame) -> DataFrame:
    return to_output(df)


# ------------------------------------------------------------------ inputs

def actions(spark, sf, params: SessionParams | FunnelParams | AreaParams = SESSION_PARAMS) -> DataFrame:
    """The action table restricted to the parameter date range."""
    a = fx.user_visit_action(spark, sf, params.start_date, params.end_date)
    return scan_actions_by_date(a, params.start_date, params.end_date)


def all_actions(spark, sf) -> DataFrame:
    return fx.user_visit_action(spark, sf)


def sessions_info(spark, sf) -> DataFrame:
    return session.session_aggr_info(session.session_aggr(actions(spark, sf)), fx.user_info(spark, sf))


def filtered_sessions(spark, sf) -> DataFrame:
    return session.session_filter(sessions_info(spark, sf), SESSION_PARAMS)


def detail(spark, sf) -> DataFrame:
    return session.session_detail(actions(spark, sf), filtered_sessions(spark, sf))


def ad_log(spark, sf) -> DataFrame:
    """The ad log text lines parsed once (keeps the arrival batch number)."""
    return parse_ad_log(fx.ad_log_lines(spark, sf), keep=("event_id", "batch_no"))


LOG_COLS = ("ts_ms", "ts", "date", "province", "city", "user_id", "ad_id")

# ------------------------------------------------------------------ J3 area top-3


@query("scan_actions_of_task")
def q_scan_actions_of_task(spark, sf):
    """The date range of a task row, read inside the query, prunes the folders of a table partitioned by date."""
    stored = layout.dated(all_actions(spark, sf), work_dir(spark, "dated-actions"))
    # a task per region, each a day later than the one before; task 1 has the test range
    later = (F.col("r_regionkey") - 1).cast("int")
    day = lambda d: F.array(F.date_format(F.date_add(F.lit(d).cast("date"), later), "yyyy-MM-dd"))
    param = F.to_json(F.create_map(F.lit("startDate"), day(START_DATE), F.lit("endDate"), day(END_DATE)))
    tasks = fx.table(spark, sf, "region").select(F.col("r_regionkey").cast("bigint").alias("task_id"), param.alias("task_param"))
    return out(layout.actions_of_task(stored, tasks, 1))


@query("scan_click_actions")
def q_scan_click_actions(spark, sf):
    a = fx.user_visit_action(spark, sf, START_DATE, END_DATE)
    return out(scan_click_actions(a, START_DATE, END_DATE))


@query("click_product_basic")
def q_click_product_basic(spark, sf):
    return out(area.click_product_basic(actions(spark, sf, AREA_PARAMS), fx.city_info(spark, sf), AREA_PARAMS))


@query("area_product_click_count")
def q_area_product_click_count(spark, sf):
    return out(area.area_product_click_count(actions(spark, sf, AREA_PARAMS), fx.city_info(spark, sf), AREA_PARAMS))


@query("area_full_product_click_count")
def q_area_full_product_click_count(spark, sf):
    counts = area.area_product_click_count(actions(spark, sf, AREA_PARAMS), fx.city_info(spark, sf), AREA_PARAMS)
    return out(area.area_full_product_click_count(counts, fx.product_info(spark, sf)))


@query("area_top3_product")
def q_area_top3_product(spark, sf):
    return out(
        area.area_top_products(
            actions(spark, sf, AREA_PARAMS), fx.city_info(spark, sf), fx.product_info(spark, sf), AREA_PARAMS
        )
    )


@query("area_top3_product_sql")
def q_area_top3_product_sql(spark, sf):
    """The same job through Spark SQL text (frames as arguments, registered SQL functions)."""
    from clickflow.plans.sql import area_top_products_sql

    return out(
        area_top_products_sql(
            spark, actions(spark, sf, AREA_PARAMS), fx.city_info(spark, sf), fx.product_info(spark, sf), AREA_PARAMS
        )
    )


@query("udf_concat_long_string")
def q_udf_concat_long_string(spark, sf):
    basic = area.click_product_basic(all_actions(spark, sf), fx.city_info(spark, sf))
    return out(basic.select("product_id", concat_long_string("city_id", "city_name", ":").alias("city_info")))


@query("udf_json_field")
def q_udf_json_field(spark, sf):
    p = fx.product_info(spark, sf)
    return out(
        p.select(
            "product_id",
            json_field(F.col("extend_info"), "product_status").alias("product_status"),
            json_field(F.col("extend_info"), "missing_field").alias("missing_field"),
        )
    )


@query("udaf_group_concat_distinct")
def q_udaf_group_concat_distinct(spark, sf):
    basic = area.click_product_basic(all_actions(spark, sf), fx.city_info(spark, sf))
    return out(basic.groupBy("product_id").agg(group_concat_distinct("city_name").alias("city_names")))


# ------------------------------------------------------------------ J1 sessions


@query("scan_actions_by_date")
def q_scan_actions_by_date(spark, sf):
    return out(actions(spark, sf))


@query("session_aggr")
def q_session_aggr(spark, sf):
    return out(session.session_aggr(actions(spark, sf)))


@query("session_aggr_info")
def q_session_aggr_info(spark, sf):
    return out(sessions_info(spark, sf))


@query("session_filter")
def q_session_filter(spark, sf):
    return out(filtered_sessions(spark, sf))


@query("session_filter_all")
def q_session_filter_all(spark, sf):
    return out(session.session_filter(sessions_info(spark, sf), SESSION_PARAMS_ALL))


@query("session_filter_equal")
def q_session_filter_equal(spark, sf):
    info = sessions_info(spark, sf)
    return out(info.filter(session.equal_param(F.col("professional"), "BUILDING")))


@query("session_length_stats")
def q_session_length_stats(spark, sf):
    return out(session.length_stats(filtered_sessions(spark, sf)))


@query("session_length_ratios")
def q_session_length_ratios(spark, sf):
    return out(session.length_ratios(session.length_stats(filtered_sessions(spark, sf))))


@query("session_detail")
def q_session_detail(spark, sf):
    return out(detail(spark, sf))


def session_tables(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Actions of the date range and the kept sessions, as tables bucketed by session."""
    acts = layout.bucketed(actions(spark, sf), "actions_by_session")
    kept = session.session_filter(
        session.session_aggr_info(session.session_aggr(acts), fx.user_info(spark, sf)), SESSION_PARAMS
    )
    return acts, layout.bucketed(kept.select("session_id", "start_time"), "kept_by_session")


@query("session_detail_bucketed")
def q_session_detail_bucketed(spark, sf):
    """J-2 over tables bucketed by session: no shuffle of either."""
    acts, kept = session_tables(spark, sf)
    return out(layout.with_bucket(acts, kept.select("session_id")))


@query("session_sample_detail_bucketed")
def q_session_sample_detail_bucketed(spark, sf):
    """J-3 over the same tables: the sample is drawn from the kept sessions and meets the actions in their buckets."""
    acts, kept = session_tables(spark, sf)
    sampled = layout.bucketed(sampling.sample(kept, SAMPLE_TOTAL, SAMPLE_SEED).select("session_id"), "sampled_by_session")
    return out(layout.with_bucket(acts, sampled))


@query("top10_session_detail_bucketed")
def q_top10_session_detail_bucketed(spark, sf):
    """J-6 over the same tables: counts per (category, session) need no shuffle of the detail either, as
    a session lies in one bucket."""
    acts, kept = session_tables(spark, sf)
    kept_detail = layout.with_bucket(acts, kept.select("session_id"))
    totals = tables.materialize(category.category_session_totals(kept_detail), "category-sessions")
    top = category.top_categories(category.sum_categories(totals), TOP_N_CATEGORIES)
    leaders = category.top_sessions(totals, top, TOP_N_SESSIONS)
    return out(category.top_session_detail(kept_detail, leaders))


@query("session_length_stats_observed")
def q_session_length_stats_observed(spark, sf):
    """A4: the counters filled while the kept sessions are written."""
    seen = session.ObservedLengths()
    kept = filtered_sessions(spark, sf)
    tables.materialize(seen.watch(kept), "kept-sessions-observed")
    return out(seen.stats(kept))


@query("category_click_counts")
def q_category_click_counts(spark, sf):
    return out(category.category_click_counts(detail(spark, sf)))


@query("category_order_counts")
def q_category_order_counts(spark, sf):
    return out(category.category_order_counts(detail(spark, sf)))


@query("category_pay_counts")
def q_category_pay_counts(spark, sf):
    return out(category.category_pay_counts(detail(spark, sf)))


@query("category_ids")
def q_category_ids(spark, sf):
    return out(category.category_ids(detail(spark, sf)))


@query("category_counts")
def q_category_counts(spark, sf):
    return out(category.category_counts(detail(spark, sf)))


def materialize(df: DataFrame) -> DataFrame:
    """Run an intermediate that one query reads several times once: column pruning gives every
    branch its own projection, so Spark can't reuse one exchange across them.  It holds
    only the columns that are read, and is removed when the driver ends."""
    return tables.materialize(df, "query-intermediate")


def kept_for_sampling(spark, sf) -> DataFrame:
    return materialize(
        filtered_sessions(spark, sf).select("session_id", "start_time", "search_keywords", "click_category_ids")
    )


def _top10(d: DataFrame) -> DataFrame:
    return category.top_categories(category.category_counts(d), TOP_N_CATEGORIES)


@query("top10_category")
def q_top10_category(spark, sf):
    return out(_top10(detail(spark, sf)))


@query("category_session_counts")
def q_category_session_counts(spark, sf):
    return out(category.category_session_counts(detail(spark, sf)))


def _top_sessions(spark, sf) -> DataFrame:
    """The top sessions of the top categories, from one narrow aggregate."""
    totals = materialize(category.category_session_totals(detail(spark, sf)))
    top = category.top_categories(category.sum_categories(totals), TOP_N_CATEGORIES)
    return category.top_sessions(totals, top, TOP_N_SESSIONS)


@query("top10_category_session")
def q_top10_category_session(spark, sf):
    return out(_top_sessions(spark, sf))


@query("top10_session_detail")
def q_top10_session_detail(spark, sf):
    return out(category.top_session_detail(detail(spark, sf), _top_sessions(spark, sf)))


@query("session_hour_counts")
def q_session_hour_counts(spark, sf):
    return out(sampling.session_hour_counts(filtered_sessions(spark, sf)))


@query("session_sample_quota")
def q_session_sample_quota(spark, sf):
    return out(sampling.sample_quota(kept_for_sampling(spark, sf), SAMPLE_TOTAL))


@query("session_sample")
def q_session_sample(spark, sf):
    sampled = sampling.sample(kept_for_sampling(spark, sf), SAMPLE_TOTAL, SAMPLE_SEED)
    return out(sampled.select("session_id", "date", "hour", "start_time", "search_keywords", "click_category_ids"))


@query("session_sample_detail")
def q_session_sample_detail(spark, sf):
    # a sampled session is a kept one, so its actions are its detail
    sampled = sampling.sample(kept_for_sampling(spark, sf), SAMPLE_TOTAL, SAMPLE_SEED)
    return out(sampling.sample_detail(actions(spark, sf), sampled))


# ------------------------------------------------------------------ J2 funnel


def funnel_actions(spark, sf) -> DataFrame:
    return actions(spark, sf, FUNNEL_PARAMS)


@query("page_splits")
def q_page_splits(spark, sf):
    return out(funnel.page_splits(funnel_actions(spark, sf), FUNNEL_PARAMS.flow))


@query("page_split_pv")
def q_page_split_pv(spark, sf):
    return out(funnel.page_split_pv(funnel.page_splits(funnel_actions(spark, sf), FUNNEL_PARAMS.flow)))


@query("start_page_pv")
def q_start_page_pv(spark, sf):
    return out(funnel.start_page_pv(funnel_actions(spark, sf), FUNNEL_PARAMS.flow))


@query("page_convert_rate")
def q_page_convert_rate(spark, sf):
    return out(funnel.page_convert_rate(funnel_actions(spark, sf), FUNNEL_PARAMS))


@query("page_convert_rate_encoded")
def q_page_convert_rate_encoded(spark, sf):
    return out(funnel.encode_convert_rate(funnel.page_convert_rate(funnel_actions(spark, sf), FUNNEL_PARAMS)))


# ------------------------------------------------------------------ scalar functions


def _session_kv(spark, sf) -> DataFrame:
    s = session.session_aggr(all_actions(spark, sf))
    enc = S.kv_encode(
        [
            ("sessionid", F.col("session_id")),
            ("searchKeywords", F.array_join("search_keywords", ",")),
            ("clickCategoryIds", F.array_join("click_category_ids", ",")),
            ("visitLength", F.col("visit_length")),
            ("stepLength", F.col("step_length")),
            ("startTime", S.format_time("start_time")),
        ]
    )
    return s.select("session_id", "step_length", enc.alias("aggr_info"))


@query("kv_get")
def q_kv_get(spark, sf):
    s = _session_kv(spark, sf)
    return out(
        s.select(
            "session_id",
            S.kv_get("aggr_info", "searchKeywords").alias("search_keywords"),
            S.kv_get("aggr_info", "clickCategoryIds").alias("click_category_ids"),
            S.kv_get("aggr_info", "visitLength").alias("visit_length"),
            S.kv_get("aggr_info", "startTime").alias("start_time"),
            S.kv_get("aggr_info", "noSuchField").alias("missing"),
        )
    )


@query("kv_set")
def q_kv_set(spark, sf):
    s = _session_kv(spark, sf)
    return out(
        s.select(
            "session_id",
            S.kv_set("aggr_info", "visitLength", F.col("step_length").cast("string")).alias("aggr_info"),
            S.kv_set("aggr_info", "noSuchField", F.lit("x")).alias("unchanged"),
        )
    )


@query("scalar_strings")
def q_scalar_strings(spark, sf):
    s = session.session_aggr(all_actions(spark, sf))
    kw = F.array_join("search_keywords", ",")
    hour = F.hour("start_time").cast("string")
    return out(
        s.select(
            "session_id",
            S.trim_comma(F.concat(F.lit(","), kw, F.lit(","))).alias("trimmed"),
            S.zero_pad2(hour).alias("hour_padded"),
            S.zero_pad2(F.concat(hour, F.lit("0"))).alias("padded_3"),
            S.is_empty(kw).alias("kw_empty"),
            S.is_not_empty(kw).alias("kw_not_empty"),
        )
    )


@query("scalar_dates")
def q_scalar_dates(spark, sf):
    a = all_actions(spark, sf)
    text = S.format_time("action_time")
    return out(
        a.select(
            "session_id",
            text.alias("action_time"),
            S.date_hour("action_time").alias("date_hour"),
            S.format_date("action_time").alias("date"),
            S.format_date_key("action_time").alias("date_key"),
            S.format_time_minute("action_time").alias("minute_key"),
            S.parse_time(text).alias("parsed_time"),
            S.parse_date_key(S.format_date_key("action_time")).alias("parsed_date"),
            S.parse_time(F.lit("not a time")).alias("bad_time"),
            S.time_before(text, F.lit("2024-01-12 12:00:00")).alias("before_noon_12"),
            S.time_after(text, F.lit("2024-01-12 12:00:00")).alias("after_noon_12"),
            S.time_minus(text, F.lit("2024-01-01 00:00:00")).alias("seconds_since_jan1"),
            S.time_minus(text, F.lit("garbage")).alias("minus_bad"),
        )
    )


@query("scalar_round")
def q_scalar_round(spark, sf):
    a = all_actions(spark, sf)
    g = a.groupBy("user_id").agg(
        F.count(F.col("click_category_id")).alias("clicks"), F.count(F.lit(1)).alias("actions")
    )
    return out(g.select("user_id", "clicks", "actions", S.ratio("clicks", "actions").alias("click_ratio")))


@query("task_params")
def q_task_params(spark, sf):
    """One task per event date, its parameters written as the reference's
    JSON object of arrays, then parsed back (element 1 of each array)."""
    days = fx.table(spark, sf, "events").select(F.to_date("ts").alias("d")).distinct()
    d = F.date_format("d", "yyyy-MM-dd")
    param = F.to_json(
        F.create_map(
            F.lit("startDate"), F.array(d),
            F.lit("endDate"), F.array(F.date_format(F.date_add("d", 6), "yyyy-MM-dd")),
            F.lit("targetPageFlow"), F.array(F.lit("1,2,3,4")),
            F.lit("sex"), F.array(F.when(F.dayofmonth("d") % 2 == 0, F.lit("male")).otherwise(F.lit("female"))),
        )
    )
    tasks = days.select(F.date_format("d", "yyyyMMdd").cast("bigint").alias("task_id"), param.alias("task_param"))
    return out(tasks.select("task_id", *task_param_columns(F.col("task_param"))))


@query("scalar_today")
def q_scalar_today(spark, sf):
    day = F.to_date("ts")
    return out(
        fx.table(spark, sf, "events").select(
            "event_id",
            S.today().alias("today"),
            S.yesterday().alias("yesterday"),
            F.date_diff(S.today(), day).alias("days_ago"),
            (day <= S.yesterday()).alias("by_yesterday"),
        )
    )


# ------------------------------------------------------------------ J4 ads (batch form)


@query("ad_log_parse")
def q_ad_log_parse(spark, sf):
    return out(ad_log(spark, sf).select("event_id", "batch_no", *LOG_COLS))


@query("ad_user_click_count")
def q_ad_user_click_count(spark, sf):
    return out(ads.user_click_counts(ad_log(spark, sf)))


def _blacklist(spark, sf) -> DataFrame:
    """Users of the late batches whose accumulated count reaches the threshold: early and late
    counts come from one aggregate, so the log is read once."""
    late = F.col("batch_no") >= 2
    counts = ad_log(spark, sf).groupBy(*ads.USER_AD_KEYS).agg(
        F.count(F.when(~late, F.lit(1))).alias("early"), F.count(F.when(late, F.lit(1))).alias("late")
    )
    keys = list(ads.USER_AD_KEYS)
    batch = counts.filter("late > 0").select(*keys, (F.col("early") + F.col("late")).alias("click_count"))
    return batch.filter(F.col("click_count") >= BLACKLIST_THRESHOLD).select("user_id").distinct()


@query("ad_blacklist_generate")
def q_ad_blacklist_generate(spark, sf):
    accumulated, batch = _early_late(spark, sf, ads.user_click_counts)
    _, users = ads.generate_blacklist(batch, accumulated, BLACKLIST_THRESHOLD)
    return out(users)


@query("ad_blacklist_filter")
def q_ad_blacklist_filter(spark, sf):
    return out(ads.blacklist_filter(ad_log(spark, sf), _blacklist(spark, sf)).select("event_id", *LOG_COLS))


@query("ad_blacklist_filter_bloom")
def q_ad_blacklist_filter_bloom(spark, sf):
    """J-9 / X2 for a list too long to broadcast: a Bloom filter of the list splits the log while it is scanned, and only
    the rows that may be on the list reach the exact anti join."""
    kept = membership.anti_join_long(ad_log(spark, sf), _blacklist(spark, sf), "user_id")
    return out(kept.select("event_id", *LOG_COLS))


@query("ad_blacklist_feedback")
def q_ad_blacklist_feedback(spark, sf):
    kept = ads.blacklist_feedback(ad_log(spark, sf), BLACKLIST_THRESHOLD)
    return out(kept.select("event_id", "batch_no", *LOG_COLS))


@query("ad_stat")
def q_ad_stat(spark, sf):
    return out(ads.ad_stat(ad_log(spark, sf)))


@query("ad_province_click_count")
def q_ad_province_click_count(spark, sf):
    return out(ads.province_click_count(ads.ad_stat(ad_log(spark, sf))))


@query("ad_province_top3")
def q_ad_province_top3(spark, sf):
    return out(ads.province_top(ads.ad_stat(ad_log(spark, sf)), 3))


@query("ad_click_trend")
def q_ad_click_trend(spark, sf):
    return out(ads.click_trend(ad_log(spark, sf)))


@query("ad_click_trend_last_hour")
def q_ad_click_trend_last_hour(spark, sf):
    return out(ads.click_trend(ad_log(spark, sf), last="60 minutes"))


@query("ad_sliding_count")
def q_ad_sliding_count(spark, sf):
    return out(ads.sliding_count(ad_log(spark, sf), AD_PARAMS.window, AD_PARAMS.slide))


# ------------------------------------------------------------------ result-table semantics


def _early_late(spark, sf, fn) -> tuple[DataFrame, DataFrame]:
    log = ad_log(spark, sf)
    return fn(log.filter(F.col("batch_no") < 2)), fn(log.filter(F.col("batch_no") >= 2))


@query("upsert_add")
def q_upsert_add(spark, sf):
    target, updates = _early_late(spark, sf, ads.user_click_counts)
    return out(tables.upsert(target, updates, ads.USER_AD_KEYS, mode="add"))


@query("upsert_replace")
def q_upsert_replace(spark, sf):
    target, updates = _early_late(spark, sf, ads.ad_stat)
    return out(tables.upsert(target, updates, ads.STAT_KEYS, mode="replace"))


@query("upsert_split")
def q_upsert_split(spark, sf):
    target, updates = _early_late(spark, sf, ads.ad_stat)
    ins, upd = tables.upsert_split(target, updates, ads.STAT_KEYS)
    return out(ins.withColumn("action", F.lit("insert")).unionByName(upd.withColumn("action", F.lit("update"))))


@query("replace_groups")
def q_replace_groups(spark, sf):
    target, updates = _early_late(spark, sf, lambda log: ads.province_top(ads.ad_stat(log), 3))
    return out(tables.replace_groups(target, updates, ("date", "province")))


def _stored(spark, name, steps, keys, mode) -> DataFrame:
    """The state of a table by day after some batches of updates; each merges the days it touches only."""
    table = tables.BatchTable(spark, work_dir(spark, name), steps[0].schema, keys, mode, part="date", merge_every=1)
    for batch, updates in enumerate(steps):
        table.write_batch(updates, batch)
    return table.read()


@query("stored_upsert_add")
def q_stored_upsert_add(spark, sf):
    """K4 in a stored table: early counts, then late ones added."""
    return out(_stored(spark, "stored-add", _early_late(spark, sf, ads.user_click_counts), ads.USER_AD_KEYS, "add"))


@query("stored_upsert_replace")
def q_stored_upsert_replace(spark, sf):
    """K5 in a stored table: late rows replace those of their keys."""
    return out(_stored(spark, "stored-replace", _early_late(spark, sf, ads.ad_stat), ads.STAT_KEYS, "replace"))


@query("stored_replace_groups")
def q_stored_replace_groups(spark, sf):
    """K7 in a stored table: late top-n rows replace their (date, province) groups."""
    steps = _early_late(spark, sf, lambda log: ads.province_top(ads.ad_stat(log), 3))
    return out(_stored(spark, "stored-groups", steps, ("date", "province"), "replace_groups"))


@query("append_results")
def q_append_results(spark, sf):
    path = work_dir(spark, "append_results")
    tables.append(_top10(detail(spark, sf)), path, task_id=1)
    tables.append(_top10(detail(spark, sf)), path, task_id=2)
    return out(spark.read.parquet(path))


def queries() -> dict[str, Query]:
    from clickflow.plans import stream_queries  # noqa: F401  (registers the stream queries)

    return dict(REGISTRY)


def run(spark: SparkSession, name: str, sf: str) -> DataFrame:
    configure_session(spark)
    return queries()[name](spark, sf)
