"""Hand-made edge frames (FIXTURES.md §4) and semantic decisions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.functions import scalars as S
from clickflow.functions.udfs import concat_long_string, group_concat_distinct, json_field, register_sql_functions
from clickflow.operators import area, category, funnel, sampling, session, tables
from clickflow.params import FunnelParams, SessionParams, load_task, task_param_columns

ACTION_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("action_time", T.TimestampNTZType()),
        T.StructField("search_keyword", T.StringType()),
        T.StructField("click_category_id", T.LongType()),
        T.StructField("click_product_id", T.LongType()),
        T.StructField("order_category_ids", T.StringType()),
        T.StructField("order_product_ids", T.StringType()),
        T.StructField("pay_category_ids", T.StringType()),
        T.StructField("pay_product_ids", T.StringType()),
        T.StructField("city_id", T.LongType()),
    ]
)


def ts(s):
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S")


def act(session_id, time, page=0, user=1, kw=None, click=None, order=None, pay=None, city=0):
    t = ts(time)
    return (t.date(), user, session_id, page, t, kw, click, None, order, None, pay, None, city)


def actions_df(spark, rows):
    return spark.createDataFrame(rows, ACTION_SCHEMA)


USERS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("username", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("professional", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("sex", T.StringType()),
    ]
)


def users_df(spark, ids=(1, 2, 3)):
    return spark.createDataFrame(
        [(i, f"u{i}", f"n{i}", 20 + i, "p", "c", "male" if i % 2 else "female") for i in ids], USERS
    )


# ---------------------------------------------------------------- sessions


def test_single_action_session_is_in_no_visit_bucket(spark):
    a = actions_df(spark, [act("s1", "2024-01-01 10:00:00")])
    stats = session.length_stats(session.session_aggr(a)).collect()[0].asDict()
    assert stats["session_count"] == 1
    assert all(stats[f"visit_{n}"] == 0 for n, _, _ in session.VISIT_BUCKETS)
    assert stats["step_1_3"] == 1


def test_bucket_counts_never_exceed_session_count(spark):
    rows = []
    for i in range(40):
        for j in range(i % 7 + 1):
            rows.append(act(f"s{i}", f"2024-01-01 10:{(j * 7 + i) % 60:02d}:{j:02d}"))
    stats = session.length_stats(session.session_aggr(actions_df(spark, rows))).collect()[0].asDict()
    visit = sum(stats[f"visit_{n}"] for n, _, _ in session.VISIT_BUCKETS)
    step = sum(stats[f"step_{n}"] for n, _, _ in session.STEP_BUCKETS)
    assert visit <= stats["session_count"] and step == stats["session_count"]


def test_category_12_then_1_keeps_both(spark):
    a = actions_df(
        spark,
        [act("s1", "2024-01-01 10:00:00", click=12), act("s1", "2024-01-01 10:00:05", click=1),
         act("s1", "2024-01-01 10:00:06", kw="kw12"), act("s1", "2024-01-01 10:00:07", kw="kw1"),
         act("s1", "2024-01-01 10:00:08", kw="")],
    )
    r = session.session_aggr(a).collect()[0]
    assert r["click_category_ids"] == [1, 12]
    assert r["search_keywords"] == ["kw1", "kw12"]
    assert r["visit_length"] == 8 and r["step_length"] == 5


def test_user_missing_from_user_info_drops_session(spark):
    a = actions_df(spark, [act("s1", "2024-01-01 10:00:00", user=1), act("s9", "2024-01-01 10:00:00", user=9)])
    info = session.session_aggr_info(session.session_aggr(a), users_df(spark))
    assert [r["session_id"] for r in info.collect()] == ["s1"]


def test_filter_semantics(spark):
    a = actions_df(
        spark,
        [act("s1", "2024-01-01 10:00:00", user=1, kw="kw1", click=5),
         act("s2", "2024-01-01 10:00:00", user=2, kw="kw2"),
         act("s3", "2024-01-01 10:00:00", user=3)],
    )
    info = session.session_aggr_info(session.session_aggr(a), users_df(spark))

    def ids(p):
        return sorted(r["session_id"] for r in session.session_filter(info, p).collect())

    assert ids(SessionParams()) == ["s1", "s2", "s3"]
    assert ids(SessionParams(start_age=21, end_age=22)) == ["s1", "s2"]
    assert ids(SessionParams(start_age=21)) == ["s1", "s2", "s3"]  # one bound missing → pass
    assert ids(SessionParams(sex=("male",))) == ["s1", "s3"]
    assert ids(SessionParams(keywords=("kw2", "kw9"))) == ["s2"]
    assert ids(SessionParams(category_ids=(5,))) == ["s1"]
    assert ids(SessionParams(category_ids=(99,))) == []  # empty result, no error
    eq = info.filter(session.equal_param(F.col("sex"), "female"))
    assert [r["session_id"] for r in eq.collect()] == ["s2"]


def test_params_from_task_table(spark):
    tasks = spark.createDataFrame(
        [(1, '{"startDate": ["2024-01-05"], "endAge": ["50"], "startAge": ["10"], "cities": ["a,b"], '
             '"targetPageFlow": ["1,2,3"]}')],
        "task_id bigint, task_param string",
    )
    d = load_task(tasks, 1)
    p = SessionParams.from_dict(d)
    assert p.start_date == "2024-01-05" and p.start_age == 10 and p.end_age == 50 and p.cities == ("a", "b")
    assert FunnelParams.from_dict(d).flow == (1, 2, 3)
    assert SessionParams.from_task(tasks, 1) == p and FunnelParams.from_task(tasks, 1).flow == (1, 2, 3)
    from clickflow.params import AreaParams

    assert AreaParams.from_task(tasks, 1).start_date == "2024-01-05"
    with pytest.raises(ValueError):
        load_task(tasks, 2)
    row = tasks.select(*task_param_columns(F.col("task_param"))).collect()[0]
    assert row["startDate"] == "2024-01-05" and row["sex"] is None


def _set(df):
    return {tuple(r) for r in df.collect()}


def test_every_bucket_edge(spark):
    """Each visit and step length at and next to a bucket's bounds falls where the bounds say."""
    visits = [0, 1, 3, 4, 6, 7, 9, 10, 29, 30, 59, 60, 179, 180, 599, 600, 1799, 1800, 5000]
    steps = [1, 3, 4, 6, 7, 9, 10, 29, 30, 59, 60, 500]
    rows = [(f"v{v}", v, 0) for v in visits] + [(f"s{s}", 0, s) for s in steps]
    df = spark.createDataFrame(rows, "session_id string, visit_length bigint, step_length bigint")
    got = session.length_stats(df).collect()[0].asDict()
    want_v = {"1s_3s": 2, "4s_6s": 2, "7s_9s": 2, "10s_30s": 2, "30s_60s": 2, "1m_3m": 2, "3m_10m": 2, "10m_30m": 2, "30m": 2}
    want_s = {"1_3": 2, "4_6": 2, "7_9": 2, "10_30": 2, "30_60": 2, "60": 2}
    assert {k: got[f"visit_{k}"] for k in want_v} == want_v
    assert {k: got[f"step_{k}"] for k in want_s} == want_s
    for v in visits[1:]:
        one = session.length_stats(df.filter(F.col("session_id") == f"v{v}")).collect()[0].asDict()
        hit = [n for n, lo, hi in session.VISIT_BUCKETS if lo <= v and (hi is None or v <= hi)]
        assert [n for n, _, _ in session.VISIT_BUCKETS if one[f"visit_{n}"]] == hit


# ---------------------------------------------------------------- ratios, strings, dates


def test_ratio_rule(spark):
    df = spark.createDataFrame([(57, 200), (1, 3), (2, 3), (0, 5), (5, 0), (1, 8)], "n bigint, d bigint")
    got = [r[0] for r in df.select(S.ratio("n", "d")).collect()]
    assert got == [0.29, 0.33, 0.67, 0.0, None, 0.13]


def test_kv_codec(spark):
    df = spark.createDataFrame(
        [("a=1|b=|c=x=y|d=4|a=5",), ("b=2|",), ("",), (None,), ("a=b=|z=1",)], "s string"
    )
    rows = df.select(
        S.kv_get("s", "a").alias("a"), S.kv_get("s", "b").alias("b"), S.kv_get("s", "c").alias("c"),
        S.kv_set("s", "a", F.lit("9")).alias("set_a"), S.kv_set("s", "q", F.lit("9")).alias("set_q"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("1", None, None, "a=9|b=|c=x=y|d=4|a=5", "a=1|b=|c=x=y|d=4|a=5"),
        (None, "2", None, "b=2", "b=2"),
        (None, None, None, "", ""),
        (None, None, None, None, None),
        ("b", None, None, "a=9|z=1", "a=b=|z=1"),
    ]


def test_string_helpers(spark):
    df = spark.createDataFrame([(",a,b,",), (",",), ("a,,",), ("7",), ("12",), ("123",), ("",), (None,)], "s string")
    rows = df.select(S.trim_comma("s"), S.zero_pad2("s"), S.is_empty("s"), S.is_not_empty("s")).collect()
    assert [r[0] for r in rows][:3] == ["a,b", "", "a,"]
    assert [r[1] for r in rows][3:6] == ["07", "12", "0123"]
    assert [r[2] for r in rows] == [False, False, False, False, False, False, True, True]


def test_date_helpers(spark):
    df = spark.createDataFrame([("2024-01-02 3:04:05", "20240102"), ("bad", "x")], "t string, k string")
    r = df.select(
        S.date_hour(S.parse_time("t")).alias("dh"),
        S.parse_date_key("k").alias("d"),
        S.time_minus("t", F.lit("2024-01-02 03:00:00")).alias("m"),
        S.time_before("t", F.lit("2024-01-03 00:00:00")).alias("b"),
    ).collect()
    assert tuple(r[0]) == ("2024-01-02_03", dt.date(2024, 1, 2), 245, True)
    assert tuple(r[1]) == (None, None, 0, False)


def test_udfs_and_sql_registration(spark):
    df = spark.createDataFrame(
        [(1, "x", '{"product_status": 0}'), (2, None, None), (1, "x", '{"other": 1}'), (3, "y", "not json")],
        "id bigint, name string, j string",
    )
    rows = df.select(concat_long_string("id", "name", ":"), area.product_status(F.col("j"))).collect()
    assert [tuple(r) for r in rows] == [
        ("1:x", "self"), ("2:null", "third party"), ("1:x", "third party"), ("3:y", "third party")
    ]
    assert df.agg(group_concat_distinct(F.col("id").cast("string"))).collect()[0][0] == "1,2,3"
    assert df.select(json_field(F.col("j"), "product_status")).collect()[0][0] == "0"
    register_sql_functions(spark)
    df.createOrReplaceTempView("udf_t")
    r = spark.sql("SELECT concat_long_string(id, name, ':') AS c, json_field(j, 'product_status') AS s "
                  "FROM udf_t WHERE id = 1 ORDER BY s").collect()
    assert [tuple(x) for x in r] == [("1:x", None), ("1:x", "0")]


# ---------------------------------------------------------------- sampling


def _sessions(spark, starts):
    return spark.createDataFrame(
        [(f"s{i}", ts(t)) for i, t in enumerate(starts)], "session_id string, start_time timestamp_ntz"
    )


def test_small_day_takes_all_and_ends(spark):
    s = _sessions(spark, ["2024-01-01 10:00:00", "2024-01-01 11:00:00", "2024-01-01 11:30:00"])
    got = sampling.sample(s, total=100, seed="1").collect()
    assert len(got) == 3


def test_sample_respects_quota_per_hour(spark):
    starts = [f"2024-01-0{1 + d} {h:02d}:{m:02d}:00" for d in range(3) for h in range(0, 24, 3) for m in range(0, 60, 4)]
    s = _sessions(spark, starts)
    quota = {(r["date"], r["hour"]): r["quota"] for r in sampling.sample_quota(s, total=30).collect()}
    got = sampling.sample(s, total=30, seed="7")
    per = {(r["date"], r["hour"]): r["n"] for r in got.groupBy("date", "hour").agg(F.count("*").alias("n")).collect()}
    assert per and all(per[k] <= quota[k] for k in per)
    # seeded hash order: repeatable
    assert sorted(r["session_id"] for r in got.collect()) == sorted(
        r["session_id"] for r in sampling.sample(s, total=30, seed="7").collect()
    )


def test_empty_input_samples_nothing(spark):
    s = _sessions(spark, ["2024-01-01 10:00:00"]).filter(F.lit(False))
    assert sampling.sample(s).count() == 0


# ---------------------------------------------------------------- categories


def test_top_session_repeated_per_category(spark):
    a = actions_df(
        spark,
        [act("s1", "2024-01-01 10:00:00", click=1), act("s1", "2024-01-01 10:00:01", click=2),
         act("s2", "2024-01-01 10:00:00", order="1,2"), act("s2", "2024-01-01 10:00:01", pay="3")],
    )
    counts = category.category_counts(a)
    assert {r["category_id"]: (r["click_count"], r["order_count"], r["pay_count"]) for r in counts.collect()} == {
        1: (1, 1, 0), 2: (1, 1, 0), 3: (0, 0, 1)
    }
    top = category.top_categories(counts)
    totals = category.category_session_totals(a)
    assert _set(category.sum_categories(totals)) == _set(counts)
    ts_ = category.top_sessions(totals, top)
    assert _set(ts_) == _set(category.top_sessions(category.category_session_counts(a), top))
    d = category.top_session_detail(a, ts_)
    assert d.filter(F.col("session_id") == "s1").count() == 4  # 2 actions × 2 categories (D11)
    assert category.top_session_detail(a, ts_, distinct=True).count() == 2


# ---------------------------------------------------------------- funnel


def test_funnel_unseen_step_and_zero_denominator(spark):
    a = actions_df(
        spark,
        [act("s1", "2024-01-01 10:00:00", page=1), act("s1", "2024-01-01 10:00:01", page=2),
         act("s2", "2024-01-01 10:00:00", page=1), act("s2", "2024-01-01 10:00:00", page=2)],
    )
    rates = {r["page_split"]: r for r in funnel.page_convert_rate(a, FunnelParams(flow=(1, 2, 7, 8))).collect()}
    assert rates["1_2"]["split_pv"] == 2 and rates["1_2"]["convert_rate"] == 1.0
    assert rates["2_7"]["split_pv"] == 0 and rates["2_7"]["convert_rate"] == 0.0
    assert rates["7_8"]["prev_pv"] == 0 and rates["7_8"]["convert_rate"] is None
    enc = funnel.encode_convert_rate(funnel.page_convert_rate(a, FunnelParams(flow=(1, 2, 7, 8)))).collect()[0][0]
    assert enc == "1_2=1.0|2_7=0.0|7_8=null"


def test_funnel_repeated_split_keeps_last_position(spark):
    a = actions_df(spark, [act("s1", f"2024-01-01 10:00:0{i}", page=p) for i, p in enumerate([1, 2, 1, 2])])
    r = funnel.page_convert_rate(a, FunnelParams(flow=(1, 2, 1, 2))).orderBy("position").collect()
    assert [(x["position"], x["page_split"], x["split_pv"], x["prev_pv"]) for x in r] == [(2, "2_1", 1, 2), (3, "1_2", 2, 1)]


def test_chunked_lag_equals_plain_lag(spark):
    import random

    rnd = random.Random(3)
    rows = []
    for s in range(6):
        for _ in range(rnd.randint(1, 40)):
            rows.append(act(f"s{s}", f"2024-01-0{rnd.randint(1, 2)} {rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:"
                                      f"{rnd.randint(0, 59):02d}", page=rnd.randint(0, 4)))
    a = actions_df(spark, rows)
    cols = ["session_id", "action_time", "page_id", "prev_page_id"]
    for unit in ("hour", "minute", "day"):
        chunked = sorted(tuple(r) for r in funnel.previous_page(a, unit).select(*cols).collect())
        plain = sorted(tuple(r) for r in funnel.previous_page(a, None).select(*cols).collect())
        assert chunked == plain


# ---------------------------------------------------------------- table semantics


def test_upsert_add_replace_split_groups(spark):
    target = spark.createDataFrame([("a", 1, 5), ("b", 1, 2)], "k string, g bigint, click_count bigint")
    upd = spark.createDataFrame([("b", 1, 3), ("c", 2, 1)], "k string, g bigint, click_count bigint")
    add = {tuple(r) for r in tables.upsert(target, upd, ["k"], mode="add").collect()}
    assert add == {("a", 5), ("b", 5), ("c", 1)}
    rep = {tuple(r) for r in tables.upsert(target, upd, ["k"], mode="replace").collect()}
    assert rep == {("a", 1, 5), ("b", 1, 3), ("c", 2, 1)}
    ins, up = tables.upsert_split(target, upd, ["k"])
    assert [r["k"] for r in ins.collect()] == ["c"] and [r["k"] for r in up.collect()] == ["b"]
    grp = {tuple(r) for r in tables.replace_groups(target, upd, ["g"]).collect()}
    assert grp == {("b", 1, 3), ("c", 2, 1)}


def test_null_keys_merge_once(spark):
    schema = "k string, g bigint, click_count bigint"
    target = spark.createDataFrame([(None, 1, 1), ("b", None, 2), ("c", 3, 3)], schema)
    upd = spark.createDataFrame([(None, 1, 5), ("b", None, 6), ("d", None, 7)], schema)
    assert _set(tables.upsert_replace(target, upd, ["k", "g"])) == {
        (None, 1, 5), ("b", None, 6), ("c", 3, 3), ("d", None, 7)
    }
    assert _set(tables.upsert_add(target, upd, ["k", "g"])) == {(None, 1, 6), ("b", None, 8), ("c", 3, 3), ("d", None, 7)}
    ins, up = tables.upsert_split(target, upd, ["k", "g"])
    assert _set(ins) == {("d", None, 7)} and _set(up) == {(None, 1, 5), ("b", None, 6)}
    assert _set(tables.replace_groups(target, upd, ["g"])) == {(None, 1, 5), ("b", None, 6), ("d", None, 7), ("c", 3, 3)}


def test_string_ends_are_ends_of_text(spark):
    df = spark.createDataFrame([("a,\n",), (",a,",)], "s string")
    assert [r[0] for r in df.select(S.trim_comma("s")).collect()] == ["a,\n", "a"]


def test_upsert_add_of_split_batches_equals_one_batch(spark):
    b1 = spark.createDataFrame([("a", 1), ("b", 2)], "k string, click_count bigint")
    b2 = spark.createDataFrame([("a", 3), ("c", 1)], "k string, click_count bigint")
    empty = b1.filter(F.lit(False))
    two = tables.upsert_add(tables.upsert_add(empty, b1, ["k"]), b2, ["k"])
    one = tables.upsert_add(empty, b1.unionByName(b2), ["k"])
    assert sorted(map(tuple, two.collect())) == sorted(map(tuple, one.collect()))


def test_batch_table_replay_is_idempotent(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("click_count", T.LongType())])
    t = tables.BatchTable(spark, str(tmp_path / "cl"), schema, keys=["k"], mode="add", merge_every=3)
    batch = spark.createDataFrame([("a", 2)], schema)
    for _ in range(2):  # batch 0 applied twice (a replay)
        t.write_batch(batch, 0)
    assert [tuple(r) for r in t.read().collect()] == [("a", 2)]
    t.write_batch(spark.createDataFrame([("a", 1), ("b", 5)], schema), 1)
    t.write_batch(batch, 2)  # merge after batch 2
    t.write_batch(batch, 3)
    assert sorted(tuple(r) for r in t.read().collect()) == [("a", 7), ("b", 5)]
    assert sorted(tuple(r) for r in t.read(1).collect()) == [("a", 3), ("b", 5)]
    assert sorted(tuple(r) for r in t.read(3, keys=spark.createDataFrame([("b",)], "k string")).collect()) == [("b", 5)]
    assert t.batches() == [0, 1, 2, 3]


def test_batch_table_replace_and_groups(spark, tmp_path):
    schema = T.StructType([T.StructField("g", T.StringType()), T.StructField("k", T.StringType()),
                           T.StructField("click_count", T.LongType())])
    rep = tables.BatchTable(spark, str(tmp_path / "rep"), schema, keys=["g", "k"], mode="replace")
    grp = tables.BatchTable(spark, str(tmp_path / "grp"), schema, keys=["g"], mode="replace_groups")
    b0 = spark.createDataFrame([("x", "a", 1), ("x", "b", 2), ("y", "a", 3)], schema)
    b1 = spark.createDataFrame([("x", "a", 9)], schema)
    for t in (rep, grp):
        t.write_batch(b0, 0)
        t.write_batch(b1, 1)
    assert sorted(tuple(r) for r in rep.read().collect()) == [("x", "a", 9), ("x", "b", 2), ("y", "a", 3)]
    assert sorted(tuple(r) for r in grp.read().collect()) == [("x", "a", 9), ("y", "a", 3)]


def test_append_adds_task_id(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "x bigint")
    p = str(tmp_path / "app")
    tables.append(df, p, task_id=7)
    tables.append(df, p, task_id=8)
    assert sorted(tuple(r) for r in spark.read.parquet(p).collect()) == [(7, 1), (8, 1)]


def test_a_new_state_made_from_the_old_one_replaces_it(spark, tmp_path):
    """K4 stored whole: the target is read while it is replaced; a write that fails leaves it as it was."""
    path = str(tmp_path / "state")
    tables.append(spark.createDataFrame([("a", 1), ("b", 2)], "k string, click_count bigint"), path)
    updates = spark.createDataFrame([("a", 5), ("c", 1)], "k string, click_count bigint")
    for want in ([("a", 6), ("b", 2), ("c", 1)], [("a", 11), ("b", 2), ("c", 2)]):
        state = tables.upsert_add(spark.read.parquet(path), updates, ["k"])
        tables.append(state, path, mode="overwrite")
        assert sorted(map(tuple, spark.read.parquet(path).collect())) == want
    fails = spark.read.parquet(path).select("k", F.raise_error(F.lit("lost")).cast("bigint").alias("click_count"))
    with pytest.raises(Exception, match="lost"):
        tables.append(fails, path, mode="overwrite")
    assert spark.read.parquet(path).count() == 3


DAYS = T.StructType([T.StructField("date", T.DateType()), T.StructField("k", T.StringType()),
                     T.StructField("click_count", T.LongType())])


def _day(d):
    return dt.date(2024, 1, d)


def _files(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def test_batch_table_reads_only_touched_parts(spark, tmp_path):
    t = tables.BatchTable(spark, str(tmp_path / "p"), DAYS, keys=["date", "k"], mode="add", part="date")
    t.write_batch(spark.createDataFrame([(_day(d), f"u{d % 3}", 1) for d in range(1, 29)], DAYS), 0)
    t.write_batch(spark.createDataFrame([(_day(5), "u2", 4), (_day(6), "u9", 1)], DAYS), 1)
    keys = t.changes(1).select("date", "k")
    got = t.read(1, keys=keys, touched_by=1)
    assert {f.split("_part=")[1][:10] for f in got.inputFiles() if "_part=" in f} == {"2024-01-05", "2024-01-06"}
    assert sorted(map(tuple, got.collect())) == [(_day(5), "u2", 5), (_day(6), "u9", 1)]
    assert t.read(where="date >= '2024-01-20'").count() == 9


@pytest.mark.parametrize("mode", ["add", "replace", "replace_groups", "set"])
def test_batch_table_merge_rewrites_only_touched_days(spark, tmp_path, mode):
    """A batch on one day merges that day's part; files of all other days stay as they are."""
    keys = ["date"] if mode == "replace_groups" else ["date", "k"]
    t = tables.BatchTable(spark, str(tmp_path / "m"), DAYS, keys=keys, mode=mode, part="date", merge_every=1)
    whole = [(_day(d), k, d) for d in range(1, 11) for k in "ab"]
    t.write_batch(spark.createDataFrame(whole, DAYS), 0)
    before = _files(tmp_path / "m" / "base")
    t.write_batch(spark.createDataFrame([(_day(3), "a", 50), (None, "n", 7)], DAYS), 1)
    after = _files(tmp_path / "m" / "base")
    assert {f: m for f, m in after.items() if f in before} == before  # the last base stays for a replay
    new = {f.split("/")[0] for f in after.keys() - before.keys()}
    assert new == {"_part=2024-01-03", "_part=-"}
    rest = [r for r in whole if r[0] != _day(3)]
    third = {"add": [(_day(3), "a", 53), (_day(3), "b", 3)], "replace": [(_day(3), "a", 50), (_day(3), "b", 3)],
             "replace_groups": [(_day(3), "a", 50)],
             "set": [(_day(3), "a", 3), (_day(3), "a", 50), (_day(3), "b", 3)]}[mode]
    want = sorted(map(str, [*rest, *third, (None, "n", 7)]))
    assert sorted(str(tuple(r)) for r in t.read().collect()) == want
    t.write_batch(spark.createDataFrame([(_day(3), "a", 50), (None, "n", 7)], DAYS), 1)  # replayed
    assert sorted(str(tuple(r)) for r in t.read().collect()) == want


def test_batch_table_with_part_of_a_merge_lost(spark, tmp_path):
    """A merge that stored some of its parts only: reads are right before and after the replay."""
    import shutil

    t = tables.BatchTable(spark, str(tmp_path / "l"), DAYS, keys=["date", "k"], mode="add", part="date", merge_every=2)
    batch = spark.createDataFrame([(_day(d), "a", 1) for d in (1, 2, 3)], DAYS)
    for b in range(3):
        t.write_batch(batch, b)
    t._retire = lambda *a: None  # the job ended before old folders went
    t.write_batch(batch, 3)
    shutil.rmtree(tmp_path / "l/base/_part=2024-01-02/_batch=3")
    assert sorted(r.click_count for r in t.read().collect()) == [4, 4, 4]
    del t._retire
    t.write_batch(batch, 3)
    t.write_batch(batch, 4)
    assert sorted(r.click_count for r in t.read().collect()) == [5, 5, 5]
    assert sorted(r.click_count for r in t.read(2).collect()) == [3, 3, 3]


def test_preaggregated_sliding_count_equals_window(spark):
    from clickflow.operators import ads

    base = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [(base + dt.timedelta(seconds=7 * i + (i % 3) * 0.25), i % 3) for i in range(400)]
    log = spark.createDataFrame(rows, "ts timestamp, ad_id bigint")
    for window, slide in (("60 minutes", "10 seconds"), ("10 minutes", "1 minute"), ("30 seconds", "10 seconds")):
        a = sorted(map(tuple, ads.sliding_count(log, window, slide).collect()))
        b = sorted(map(tuple, ads.sliding_count(log, window, slide, preaggregate=False).collect()))
        assert a == b and a, (window, slide)


def _model_splits(rows, flow):
    """Brute force: sort each session by (time, page), pair neighbours."""
    from collections import Counter, defaultdict

    pairs = {f"{flow[i - 1]}_{flow[i]}" for i in range(1, len(flow))}
    by = defaultdict(list)
    for r in rows:
        by[r[2]].append((r[4], r[3]))
    c = Counter()
    for acts in by.values():
        acts.sort()
        for (_, a), (_, b) in zip(acts, acts[1:]):
            if f"{a}_{b}" in pairs:
                c[f"{a}_{b}"] += 1
    start = sum(1 for r in rows if r[3] == flow[0])
    return c, start


@pytest.mark.parametrize("flow", [(1, 2, 3), (1, 1, 2), (2, 2, 2, 1)])
def test_funnel_with_bursts_of_copies_matches_brute_force(spark, flow):
    import random

    rnd = random.Random(11)
    rows = []
    for s in range(5):
        for _ in range(rnd.randint(1, 30)):
            t = f"2024-01-01 {rnd.randint(9, 12):02d}:{rnd.randint(0, 59):02d}:{rnd.randint(0, 3):02d}"
            for _ in range(rnd.choice([1, 1, 1, 4, 25])):  # bursts of identical actions
                rows.append(act(f"s{s}", t, page=rnd.randint(1, 3)))
    a = actions_df(spark, rows)
    want, start = _model_splits(rows, flow)
    for chunk in ("hour", None):
        got = funnel.page_split_pv(funnel.page_splits(a, flow, chunk)).collect()
        assert {r["page_split"]: r["split_pv"] for r in got} == dict(want), (flow, chunk)
        rates = {r["page_split"]: r for r in funnel.page_convert_rate(a, FunnelParams(flow=flow), chunk).collect()}
        for sp, r in rates.items():
            assert r["split_pv"] == want.get(sp, 0)
        first = [r for r in rates.values() if r["position"] == 1]
        assert not first or first[0]["prev_pv"] == start


def test_funnel_on_empty_input(spark):
    a = actions_df(spark, [act("s1", "2024-01-01 10:00:00", page=1)]).filter(F.lit(False))
    r = funnel.page_convert_rate(a, FunnelParams(flow=(1, 2))).collect()
    assert [(x["split_pv"], x["prev_pv"], x["convert_rate"]) for x in r] == [(0, 0, None)]


def test_batch_table_retention(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("click_count", T.LongType())])
    t = tables.BatchTable(spark, str(tmp_path / "r"), schema, keys=["k"], mode="add", merge_every=2)
    one = spark.createDataFrame([("a", 1)], schema)
    for b in range(7):
        t.write_batch(one, b)
        assert [tuple(r) for r in t.read().collect()] == [("a", b + 1)]
    # merges at 1, 3, 5: keep 3 and 5, and only the deltas after 3
    assert list(t.bases().values()) == [[3, 5]]
    assert t.batches() == [4, 5, 6]
    assert [tuple(r) for r in t.read(4).collect()] == [("a", 5)]  # a replay of batch 5 reads this
    t.write_batch(one, 5)  # the replay itself is idempotent
    assert [tuple(r) for r in t.read().collect()] == [("a", 7)]


def test_sliding_counts_over_chunk_edges(spark):
    """Marks in two chunks, gaps longer than a chunk, NULL ads: equal to window()."""
    from clickflow.operators import ads

    base = dt.datetime(2024, 1, 1, 23, 0, 0)
    steps = (0, 7, 3599, 3600, 3601, 7200, 86400 * 3, 86400 * 3 + 5, 86400 * 9 + 3600)
    rows = [(base + dt.timedelta(seconds=s + j), j % 2 if j else None) for s in steps for j in range(3)]
    rows += [(dt.datetime(1969, 12, 31, 23, 59, 58), 1)]
    log = spark.createDataFrame(rows, "ts timestamp, ad_id bigint")
    want = sorted(map(str, ads.sliding_count(log, "1 hour", "10 seconds", preaggregate=False).collect()))
    for chunk in ("1 day", "1 hour", "10 seconds", "61 minutes"):
        got = ads.spread_buckets(ads.bucket_counts(log, "10 seconds"), "1 hour", "10 seconds", chunk)
        assert sorted(map(str, got.collect())) == want, chunk


def test_sliding_marks_are_two_rows_a_bucket(spark):
    from clickflow.operators import ads

    log = spark.range(1000).selectExpr("timestamp_seconds(1704067200 + id * 10) AS ts", "id % 2 AS ad_id")
    plan = ads.spread_buckets(ads.bucket_counts(log), "1 hour", "10 seconds")._jdf.queryExecution().toString()
    sequences = [line for line in plan.splitlines() if "sequence(" in line and "Generate explode" in line]
    assert sequences and "Window [" not in "".join(sequences)
    generated = [i for i, line in enumerate(plan.splitlines()) if "Generate explode(sequence" in line]
    first_exchange = [i for i, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning" in line]
    assert min(generated) < min(first_exchange)  # windows are made above every shuffle


def test_large_cluster_profile_and_defaults(spark):
    from clickflow.config import LARGE_SCALE, SQL_DEFAULTS, configure_session

    before = {k: spark.conf.get(k, None) for k in LARGE_SCALE}
    try:
        configure_session(spark, large=True)
        for k, v in {**SQL_DEFAULTS, **LARGE_SCALE}.items():
            assert spark.conf.get(k) == v, k
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    # broadcasts by size are Spark's own choice
    assert not any("autoBroadcastJoinThreshold" in k for k in (*SQL_DEFAULTS, *LARGE_SCALE))
    assert LARGE_SCALE["spark.sql.adaptive.forceOptimizeSkewedJoin"] == "true"
