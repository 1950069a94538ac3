"""DuckDB SQL for each registered query (the correctness oracle).

The CTEs below write the same TESTDATA → reference-table mapping as
:mod:`clickflow.sources.fixtures`, independently, in plain SQL.  Output columns
carry the same names and text forms as :func:`clickflow.plans.output.to_output`.
"""

from __future__ import annotations

START = "DATE '2024-01-05'"
END = "DATE '2024-01-20'"
THRESHOLD = 2


def T(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def D(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def L(c: str) -> str:
    return f"array_to_string(list_sort({c}), ',')"


def RATIO(n: str, d: str) -> str:
    return f"CASE WHEN ({d}) = 0 THEN NULL ELSE CAST(((200 * ({n}) + ({d})) // (2 * ({d}))) AS DOUBLE) / 100.0 END"


EVK = "(SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"

UVA_ALL = f"""uva_all AS (
  SELECT CAST(ts AS DATE) AS date, user_id,
         CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS session_id,
         k % 10 AS page_id,
         date_trunc('second', ts) AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 10 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k END AS click_category_id,
         CASE WHEN event_type = 'click' THEN k % 50 END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) || ',' || CAST((k + 1) % 100 AS VARCHAR) END
              AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(k % 50 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k % 50 AS VARCHAR) END AS pay_product_ids,
         (user_id + event_id) % 25 AS city_id
  FROM {EVK} e)"""

UVA = f"""uva AS (SELECT * FROM uva_all WHERE date BETWEEN {START} AND {END})"""

UVA_OUT = f"""{D('date')} AS date, user_id, session_id, page_id, {T('action_time')} AS action_time,
  search_keyword, click_category_id, click_product_id, order_category_ids, order_product_ids,
  pay_category_ids, pay_product_ids, city_id"""

UI = """ui AS (
  SELECT c_custkey AS user_id, 'user' || CAST(c_custkey AS VARCHAR) AS username, c_name AS name,
         CAST(c_custkey % 60 AS BIGINT) AS age, c_mktsegment AS professional, n_name AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

CI = """ci AS (SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
           FROM nation JOIN region ON n_regionkey = r_regionkey)"""

PI = """pi AS (SELECT p_partkey AS product_id, p_name AS product_name,
                  '{"product_status": ' || CAST(p_partkey % 2 AS VARCHAR) || '}' AS extend_info FROM part)"""

SA = """sa AS (
  SELECT session_id, min(user_id) AS user_id,
         list_sort(list_distinct(list(CASE WHEN search_keyword <> '' THEN search_keyword END))) AS search_keywords,
         list_sort(list_distinct(list(click_category_id))) AS click_category_ids,
         min(action_time) AS start_time, max(action_time) AS end_time,
         CAST(epoch(max(action_time)) - epoch(min(action_time)) AS BIGINT) AS visit_length,
         count(*) AS step_length
  FROM uva GROUP BY session_id)"""

SAI = """sai AS (SELECT sa.*, ui.age, ui.professional, ui.city, ui.sex FROM sa JOIN ui USING (user_id))"""

SF = """sf AS (SELECT * FROM sai WHERE age BETWEEN 10 AND 50 AND sex IN ('male'))"""

DT = """dt AS (SELECT * FROM uva WHERE session_id IN (SELECT session_id FROM sf))"""

SA_OUT = f"""session_id, user_id, {L('search_keywords')} AS search_keywords,
  {L('click_category_ids')} AS click_category_ids, {T('start_time')} AS start_time, {T('end_time')} AS end_time,
  visit_length, step_length"""

SAI_OUT = SA_OUT + ", age, professional, city, sex"

J1 = f"WITH {UVA_ALL}, {UVA}, {UI}, {SA}, {SAI}, {SF}, {DT}"

SA_ALL = SA.replace("sa AS (", "sa_all AS (", 1).replace("FROM uva GROUP", "FROM uva_all GROUP")
J1_ALL = f"WITH {UVA_ALL}, {SA_ALL}"

# category ids exploded from the detail rows: one row per (category, kind)
CAT_LONG = """cat_long AS (
  SELECT click_category_id AS category_id, 'click' AS kind FROM dt WHERE click_category_id IS NOT NULL
  UNION ALL
  SELECT CAST(x AS BIGINT), 'order' FROM (SELECT unnest(string_split(order_category_ids, ',')) AS x FROM dt
                                         WHERE order_category_ids IS NOT NULL)
  UNION ALL
  SELECT CAST(x AS BIGINT), 'pay' FROM (SELECT unnest(string_split(pay_category_ids, ',')) AS x FROM dt
                                       WHERE pay_category_ids IS NOT NULL))"""

CAT_COUNTS = """cat_counts AS (
  SELECT category_id,
         count(*) FILTER (WHERE kind = 'click') AS click_count,
         count(*) FILTER (WHERE kind = 'order') AS order_count,
         count(*) FILTER (WHERE kind = 'pay') AS pay_count
  FROM cat_long GROUP BY category_id)"""

TOP10 = """top10 AS (SELECT * FROM cat_counts
                     ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id ASC LIMIT 10)"""

CSC = """csc AS (SELECT click_category_id AS category_id, session_id, count(*) AS click_count
                 FROM dt WHERE click_category_id IS NOT NULL GROUP BY 1, 2)"""

TOPS = """tops AS (
  SELECT category_id, session_id, click_count FROM (
    SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id ASC) AS rn
    FROM csc WHERE category_id IN (SELECT category_id FROM top10)) WHERE rn <= 10)"""

J1C = f"{J1}, {CAT_LONG}, {CAT_COUNTS}, {TOP10}, {CSC}, {TOPS}"

HOURS = """hours AS (
  SELECT CAST(start_time AS DATE) AS date, strftime(start_time, '%H') AS hour, count(*) AS session_count
  FROM sf GROUP BY 1, 2)"""

QUOTA = """quota AS (
  SELECT h.*, CAST(sum(session_count) OVER (PARTITION BY date) AS BIGINT) AS day_total,
         CAST(100 // (SELECT count(DISTINCT date) FROM hours) AS BIGINT) AS extract_number
  FROM hours h),
quota2 AS (
  SELECT *, least(CAST(floor(CAST(session_count AS DOUBLE) / CAST(day_total AS DOUBLE)
                              * CAST(extract_number AS DOUBLE)) AS BIGINT) + 1, session_count) AS quota
  FROM quota)"""

SAMPLE = """smp AS (
  SELECT s.* FROM (
    SELECT sf.*, CAST(start_time AS DATE) AS date, strftime(start_time, '%H') AS hour,
           row_number() OVER (PARTITION BY CAST(start_time AS DATE), strftime(start_time, '%H')
                              ORDER BY md5('42|' || session_id), session_id) AS rn
    FROM sf) s JOIN quota2 q ON s.date = q.date AND s.hour = q.hour
  WHERE s.rn <= q.quota)"""

J1S = f"{J1}, {HOURS}, {QUOTA}, {SAMPLE}"

# ---------------------------------------------------------------- funnel
PREV = """prev AS (
  SELECT session_id, action_time, page_id,
         lag(page_id) OVER (PARTITION BY session_id ORDER BY action_time, page_id) AS prev_page_id
  FROM uva)"""

SPLITS = """splits AS (
  SELECT session_id, action_time, CAST(prev_page_id AS VARCHAR) || '_' || CAST(page_id AS VARCHAR) AS page_split
  FROM prev WHERE prev_page_id IS NOT NULL
    AND CAST(prev_page_id AS VARCHAR) || '_' || CAST(page_id AS VARCHAR) IN ('1_2', '2_3', '3_4'))"""

SPV = """spv AS (SELECT page_split, count(*) AS split_pv FROM splits GROUP BY 1)"""
START_PV = """start_pv AS (SELECT count(*) AS start_page_pv FROM uva WHERE page_id = 1)"""
RATES = f"""flow AS (SELECT * FROM (VALUES (1, '1_2', '^start'), (2, '2_3', '1_2'), (3, '3_4', '2_3'))
                 AS t(position, page_split, denominator_key)),
pv_all AS (SELECT page_split AS key, split_pv AS pv FROM spv
           UNION ALL SELECT '^start', start_page_pv FROM start_pv),
rates AS (
  SELECT f.position, f.page_split, CAST(coalesce(n.pv, 0) AS BIGINT) AS split_pv,
         CAST(coalesce(d.pv, 0) AS BIGINT) AS prev_pv,
         {RATIO('coalesce(n.pv, 0)', 'coalesce(d.pv, 0)')} AS convert_rate
  FROM flow f LEFT JOIN pv_all n ON n.key = f.page_split LEFT JOIN pv_all d ON d.key = f.denominator_key)"""

J2 = f"WITH {UVA_ALL}, {UVA}, {PREV}, {SPLITS}, {SPV}, {START_PV}, {RATES}"

# ---------------------------------------------------------------- area
BASIC = """basic AS (SELECT c.city_id, ci.city_name, ci.area, c.product_id
                     FROM (SELECT city_id, click_product_id AS product_id FROM uva
                           WHERE click_product_id IS NOT NULL) c JOIN ci ON c.city_id = ci.city_id)"""
APCC = """apcc AS (SELECT area, product_id, count(*) AS click_count,
                          array_to_string(list_sort(list_distinct(list(
                              coalesce(CAST(city_id AS VARCHAR), 'null') || ':' || coalesce(city_name, 'null')))), ',')
                          AS city_infos
                   FROM basic GROUP BY area, product_id)"""
AFULL = """afull AS (SELECT a.area, a.product_id, a.click_count, a.city_infos, pi.product_name,
                            CASE WHEN json_extract_string(pi.extend_info, '$.product_status') = '0'
                                 THEN 'self' ELSE 'third party' END AS product_status
                     FROM apcc a JOIN pi ON a.product_id = pi.product_id)"""
J3 = f"WITH {UVA_ALL}, {UVA}, {CI}, {PI}, {BASIC}, {APCC}, {AFULL}"
J3_ALL = f"WITH {UVA_ALL}, {CI}, " + BASIC.replace("FROM uva\n", "FROM uva_all\n")

# ---------------------------------------------------------------- ads
ADLOG = f"""{CI},
adlog AS (
  SELECT e.event_id, CAST(hour(e.ts) // 6 AS BIGINT) AS batch_no,
         epoch_us(e.ts) // 1000 AS ts_ms,
         make_timestamp((epoch_us(e.ts) // 1000) * 1000) AS ts,
         CAST(make_timestamp((epoch_us(e.ts) // 1000) * 1000) AS DATE) AS date,
         replace(ci.area, ' ', '_') AS province, ci.city_name AS city, e.user_id, e.k % 5 AS ad_id
  FROM {EVK} e JOIN ci ON ci.city_id = (e.user_id + e.event_id) % 25
  WHERE e.event_type = 'click')"""

LOG_OUT = f"ts_ms, {T('ts')} AS ts, {D('date')} AS date, province, city, user_id, ad_id"

UCC_EARLY = "ucc_early AS (SELECT date, user_id, ad_id, count(*) AS click_count FROM adlog WHERE batch_no < 2 GROUP BY 1,2,3)"
UCC_LATE = "ucc_late AS (SELECT date, user_id, ad_id, count(*) AS click_count FROM adlog WHERE batch_no >= 2 GROUP BY 1,2,3)"
TOTALS = """totals AS (SELECT date, user_id, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count
                      FROM (SELECT * FROM ucc_early UNION ALL SELECT * FROM ucc_late) GROUP BY 1,2,3)"""
BLACKLIST = f"""bl AS (SELECT DISTINCT l.user_id FROM ucc_late l LEFT JOIN totals t
                       ON l.date = t.date AND l.user_id = t.user_id AND l.ad_id = t.ad_id
                       WHERE coalesce(t.click_count, 0) >= {THRESHOLD})"""
J4BL = f"WITH {ADLOG}, {UCC_EARLY}, {UCC_LATE}, {TOTALS}, {BLACKLIST}"

FEEDBACK = f"""per_batch AS (SELECT date, user_id, ad_id, batch_no, count(*) AS n FROM adlog GROUP BY 1,2,3,4),
cum AS (SELECT *, sum(n) OVER (PARTITION BY date, user_id, ad_id ORDER BY batch_no
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM per_batch),
breach AS (SELECT user_id, min(batch_no) AS breach_batch FROM cum WHERE c >= {THRESHOLD} GROUP BY user_id),
kept AS (SELECT a.* FROM adlog a LEFT JOIN breach b ON a.user_id = b.user_id
         WHERE b.breach_batch IS NULL OR a.batch_no <= b.breach_batch)"""

STAT = "stat AS (SELECT date, province, city, ad_id, count(*) AS click_count FROM adlog GROUP BY 1,2,3,4)"
STAT_EARLY = "stat_early AS (SELECT date, province, city, ad_id, count(*) AS click_count FROM adlog WHERE batch_no < 2 GROUP BY 1,2,3,4)"
STAT_LATE = "stat_late AS (SELECT date, province, city, ad_id, count(*) AS click_count FROM adlog WHERE batch_no >= 2 GROUP BY 1,2,3,4)"


def PROV_TOP(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT date, province, ad_id, click_count FROM (
    SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, ad_id ASC) AS rn
    FROM (SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count FROM {src} GROUP BY 1,2,3))
  WHERE rn <= 3)"""


TREND = f"""SELECT {D('m')} AS date, strftime(m, '%H') AS hour, strftime(m, '%M') AS minute, ad_id,
       count(*) AS click_count
FROM (SELECT date_trunc('minute', ts) AS m, ad_id FROM adlog {{where}}) GROUP BY m, ad_id"""

LAST_HOUR = "WHERE date_trunc('minute', ts) > (SELECT date_trunc('minute', max(ts)) FROM adlog) - INTERVAL 60 MINUTE"

SLIDING = f"""SELECT {T('make_timestamp(s)')} AS window_start, {T('make_timestamp(s + 3600000000)')} AS window_end,
       ad_id, count(*) AS click_count
FROM (SELECT (epoch_us(ts) // 10000000) * 10000000 - i * 10000000 AS s, ad_id
      FROM adlog, range(0, 360) r(i))
GROUP BY s, ad_id"""


# a batch's watermark: the newest click of the batches before it, less ten days
LATENESS = """newest AS (SELECT batch_no, max(ts_ms) AS ms FROM adlog GROUP BY 1),
late AS (SELECT b.batch_no, max(n.ms) - 10 * 86400000 AS watermark
         FROM newest b LEFT JOIN newest n ON n.batch_no < b.batch_no GROUP BY 1)"""
IS_LATE = "(ts_ms // 60000 + 1) * 60000 <= watermark"
IDLE_MS = 2 * 86400000


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    # ---------------- J3
    q["scan_click_actions"] = (
        f"WITH {UVA_ALL}, {UVA} SELECT city_id, click_product_id AS product_id FROM uva WHERE click_product_id IS NOT NULL"
    )
    q["click_product_basic"] = f"{J3} SELECT city_id, city_name, area, product_id FROM basic"
    q["area_product_click_count"] = f"{J3} SELECT * FROM apcc"
    q["area_full_product_click_count"] = f"{J3} SELECT * FROM afull"
    q["area_top3_product"] = f"""{J3}
SELECT area,
       CASE WHEN area = 'ASIA' THEN 'A level' WHEN area = 'EUROPE' THEN 'A level'
            WHEN area = 'AMERICA' THEN 'B level' WHEN area = 'AFRICA' THEN 'B level' ELSE 'D level' END AS area_level,
       product_id, click_count, city_infos, product_name, product_status
FROM (SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id ASC) AS rn FROM afull)
WHERE rn <= 3"""
    q["area_top3_product_sql"] = q["area_top3_product"]
    q["udf_concat_long_string"] = f"""{J3_ALL}
SELECT product_id, coalesce(CAST(city_id AS VARCHAR), 'null') || ':' || coalesce(city_name, 'null') AS city_info
FROM basic"""
    q["udf_json_field"] = f"""WITH {PI}
SELECT product_id, json_extract_string(extend_info, '$.product_status') AS product_status,
       json_extract_string(extend_info, '$.missing_field') AS missing_field FROM pi"""
    q["udaf_group_concat_distinct"] = f"""{J3_ALL}
SELECT product_id, array_to_string(list_sort(list_distinct(list(city_name))), ',') AS city_names
FROM basic GROUP BY product_id"""
    # ---------------- J1
    q["scan_actions_by_date"] = f"WITH {UVA_ALL}, {UVA} SELECT {UVA_OUT} FROM uva"
    q["session_aggr"] = f"{J1} SELECT {SA_OUT} FROM sa"
    q["session_aggr_info"] = f"{J1} SELECT {SAI_OUT} FROM sai"
    q["session_filter"] = f"{J1} SELECT {SAI_OUT} FROM sf"
    cities = ", ".join(f"'NATION_{i}'" for i in range(0, 25, 2))
    cats = ", ".join(str(i) for i in range(0, 100, 3))
    q["session_filter_all"] = f"""{J1} SELECT {SAI_OUT} FROM sai
WHERE age BETWEEN 10 AND 50 AND professional IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
  AND city IN ({cities}) AND sex IN ('male')
  AND list_has_any(search_keywords, ['kw1', 'kw3', 'kw5', 'kw7'])
  AND list_has_any(click_category_ids, [{cats}]::BIGINT[])"""
    q["session_filter_equal"] = f"{J1} SELECT {SAI_OUT} FROM sai WHERE professional = 'BUILDING'"
    buckets_v = [("1s_3s", 1, 3), ("4s_6s", 4, 6), ("7s_9s", 7, 9), ("10s_30s", 10, 29), ("30s_60s", 30, 59),
                 ("1m_3m", 60, 179), ("3m_10m", 180, 599), ("10m_30m", 600, 1799), ("30m", 1800, None)]
    buckets_s = [("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_30", 10, 29), ("30_60", 30, 59), ("60", 60, None)]

    def bucket(col, lo, hi):
        cond = f"{col} >= {lo}" if hi is None else f"{col} BETWEEN {lo} AND {hi}"
        return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"

    stats_cols = ["count(*) AS session_count"]
    stats_cols += [f"{bucket('visit_length', lo, hi)} AS visit_{n}" for n, lo, hi in buckets_v]
    stats_cols += [f"{bucket('step_length', lo, hi)} AS step_{n}" for n, lo, hi in buckets_s]
    STATS = f"stats AS (SELECT {', '.join(stats_cols)} FROM sf)"
    q["session_length_stats"] = f"{J1}, {STATS} SELECT * FROM stats"
    ratio_cols = ["session_count"]
    ratio_cols += [f"{RATIO(f'visit_{n}', 'session_count')} AS visit_length_{n}_ratio" for n, _, _ in buckets_v]
    ratio_cols += [f"{RATIO(f'step_{n}', 'session_count')} AS step_length_{n}_ratio" for n, _, _ in buckets_s]
    q["session_length_ratios"] = f"{J1}, {STATS} SELECT {', '.join(ratio_cols)} FROM stats WHERE session_count > 0"
    q["session_detail"] = f"{J1} SELECT {UVA_OUT} FROM dt"
    q["category_click_counts"] = (
        f"{J1C} SELECT category_id, count(*) AS click_count FROM cat_long WHERE kind = 'click' GROUP BY 1"
    )
    q["category_order_counts"] = (
        f"{J1C} SELECT category_id, count(*) AS order_count FROM cat_long WHERE kind = 'order' GROUP BY 1"
    )
    q["category_pay_counts"] = (
        f"{J1C} SELECT category_id, count(*) AS pay_count FROM cat_long WHERE kind = 'pay' GROUP BY 1"
    )
    q["category_ids"] = f"{J1C} SELECT DISTINCT category_id FROM cat_long"
    q["category_counts"] = f"{J1C} SELECT * FROM cat_counts"
    q["top10_category"] = f"{J1C} SELECT * FROM top10"
    q["category_session_counts"] = f"{J1C} SELECT * FROM csc"
    q["top10_category_session"] = f"{J1C} SELECT * FROM tops"
    q["top10_session_detail"] = f"{J1C} SELECT {UVA_OUT}, t.category_id FROM dt JOIN tops t USING (session_id)"
    q["session_hour_counts"] = f"{J1S} SELECT {D('date')} AS date, hour, session_count FROM hours"
    q["session_sample_quota"] = (
        f"{J1S} SELECT {D('date')} AS date, hour, session_count, day_total, extract_number, quota FROM quota2"
    )
    q["session_sample"] = f"""{J1S} SELECT session_id, {D('date')} AS date, hour, {T('start_time')} AS start_time,
  {L('search_keywords')} AS search_keywords, {L('click_category_ids')} AS click_category_ids FROM smp"""
    q["session_sample_detail"] = (
        f"{J1S} SELECT {UVA_OUT} FROM dt WHERE session_id IN (SELECT session_id FROM smp)"
    )
    # ---------------- J2
    q["page_splits"] = f"{J2} SELECT session_id, {T('action_time')} AS action_time, page_split, count(*) AS n FROM splits GROUP BY ALL"
    q["page_split_pv"] = f"{J2} SELECT * FROM spv"
    q["start_page_pv"] = f"{J2} SELECT * FROM start_pv"
    q["page_convert_rate"] = f"{J2} SELECT CAST(position AS BIGINT) AS position, page_split, split_pv, prev_pv, convert_rate FROM rates"
    q["page_convert_rate_encoded"] = f"""{J2}
SELECT coalesce(string_agg(page_split || '=' || coalesce(CAST(convert_rate AS VARCHAR), 'null'), '|' ORDER BY position), '')
       AS convert_rate FROM rates"""
    # ---------------- scalars
    KV = f"""{J1_ALL}, kv AS (
  SELECT session_id, step_length,
         'sessionid=' || session_id || '|searchKeywords=' || array_to_string(search_keywords, ',')
         || '|clickCategoryIds=' || array_to_string(click_category_ids, ',')
         || '|visitLength=' || CAST(visit_length AS VARCHAR) || '|stepLength=' || CAST(step_length AS VARCHAR)
         || '|startTime=' || {T('start_time')} AS aggr_info,
         search_keywords, click_category_ids, visit_length, start_time
  FROM sa_all)"""
    q["kv_get"] = f"""{KV}
SELECT session_id,
       CASE WHEN len(search_keywords) = 0 THEN NULL ELSE array_to_string(search_keywords, ',') END AS search_keywords,
       CASE WHEN len(click_category_ids) = 0 THEN NULL ELSE array_to_string(click_category_ids, ',') END
           AS click_category_ids,
       CAST(visit_length AS VARCHAR) AS visit_length, {T('start_time')} AS start_time,
       CAST(NULL AS VARCHAR) AS missing
FROM kv"""
    q["kv_set"] = f"""{KV}
SELECT session_id,
       'sessionid=' || session_id || '|searchKeywords=' || array_to_string(search_keywords, ',')
         || '|clickCategoryIds=' || array_to_string(click_category_ids, ',')
         || '|visitLength=' || CAST(step_length AS VARCHAR) || '|stepLength=' || CAST(step_length AS VARCHAR)
         || '|startTime=' || {T('start_time')} AS aggr_info,
       aggr_info AS unchanged
FROM kv"""
    q["scalar_strings"] = f"""{J1_ALL}
SELECT session_id,
       array_to_string(search_keywords, ',') AS trimmed,
       CASE WHEN length(CAST(hour(start_time) AS VARCHAR)) = 2 THEN CAST(hour(start_time) AS VARCHAR)
            ELSE '0' || CAST(hour(start_time) AS VARCHAR) END AS hour_padded,
       CASE WHEN length(CAST(hour(start_time) AS VARCHAR) || '0') = 2 THEN CAST(hour(start_time) AS VARCHAR) || '0'
            ELSE '0' || CAST(hour(start_time) AS VARCHAR) || '0' END AS padded_3,
       len(search_keywords) = 0 AS kw_empty,
       len(search_keywords) > 0 AS kw_not_empty
FROM sa_all"""
    q["scalar_dates"] = f"""WITH {UVA_ALL}
SELECT session_id, {T('action_time')} AS action_time, strftime(action_time, '%Y-%m-%d_%H') AS date_hour,
       {D('action_time')} AS date, strftime(action_time, '%Y%m%d') AS date_key,
       strftime(action_time, '%Y%m%d%H%M') AS minute_key, {T('action_time')} AS parsed_time,
       {D('action_time')} AS parsed_date, CAST(NULL AS VARCHAR) AS bad_time,
       action_time < TIMESTAMP '2024-01-12 12:00:00' AS before_noon_12,
       action_time > TIMESTAMP '2024-01-12 12:00:00' AS after_noon_12,
       CAST(epoch(action_time) - epoch(TIMESTAMP '2024-01-01 00:00:00') AS BIGINT) AS seconds_since_jan1,
       CAST(0 AS BIGINT) AS minus_bad
FROM uva_all"""
    q["scalar_today"] = f"""
SELECT event_id, {D('current_date')} AS today, {D('current_date - 1')} AS yesterday,
       CAST(date_diff('day', CAST(ts AS DATE), current_date) AS BIGINT) AS days_ago,
       CAST(ts AS DATE) <= current_date - 1 AS by_yesterday
FROM events"""
    q["scalar_round"] = f"""WITH {UVA_ALL}
SELECT user_id, count(click_category_id) AS clicks, count(*) AS actions,
       {RATIO('count(click_category_id)', 'count(*)')} AS click_ratio
FROM uva_all GROUP BY user_id"""
    q["task_params"] = """
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS task_id, strftime(d, '%Y-%m-%d') AS startDate,
       strftime(d + INTERVAL 6 DAY, '%Y-%m-%d') AS endDate,
       CAST(NULL AS VARCHAR) AS startAge, CAST(NULL AS VARCHAR) AS endAge,
       CAST(NULL AS VARCHAR) AS professionals, CAST(NULL AS VARCHAR) AS cities,
       CASE WHEN day(d) % 2 = 0 THEN 'male' ELSE 'female' END AS sex,
       CAST(NULL AS VARCHAR) AS keywords, CAST(NULL AS VARCHAR) AS categoryIds, '1,2,3,4' AS targetPageFlow
FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)"""
    # ---------------- J4 batch
    q["ad_log_parse"] = f"WITH {ADLOG} SELECT event_id, batch_no, {LOG_OUT} FROM adlog"
    q["ad_user_click_count"] = (
        f"WITH {ADLOG} SELECT {D('date')} AS date, user_id, ad_id, count(*) AS click_count FROM adlog GROUP BY 1,2,3"
    )
    q["ad_blacklist_generate"] = f"{J4BL} SELECT user_id FROM bl"
    q["ad_blacklist_filter"] = f"{J4BL} SELECT event_id, {LOG_OUT} FROM adlog WHERE user_id NOT IN (SELECT user_id FROM bl)"
    q["ad_blacklist_feedback"] = f"WITH {ADLOG}, {FEEDBACK} SELECT event_id, batch_no, {LOG_OUT} FROM kept"
    q["ad_stat"] = f"WITH {ADLOG}, {STAT} SELECT {D('date')} AS date, province, city, ad_id, click_count FROM stat"
    q["ad_province_click_count"] = f"""WITH {ADLOG}, {STAT}
SELECT {D('date')} AS date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count FROM stat GROUP BY 1,2,3"""
    q["ad_province_top3"] = f"WITH {ADLOG}, {STAT}, {PROV_TOP('stat', 'ptop')} SELECT {D('date')} AS date, province, ad_id, click_count FROM ptop"
    q["ad_click_trend"] = f"WITH {ADLOG} " + TREND.format(where="")
    q["ad_click_trend_last_hour"] = f"WITH {ADLOG} " + TREND.format(where=LAST_HOUR)
    q["ad_sliding_count"] = f"WITH {ADLOG} " + SLIDING
    # ---------------- table semantics
    q["upsert_add"] = f"{J4BL} SELECT {D('date')} AS date, user_id, ad_id, click_count FROM totals"
    q["upsert_replace"] = f"""WITH {ADLOG}, {STAT_EARLY}, {STAT_LATE}
SELECT {D('date')} AS date, province, city, ad_id, click_count FROM (
  SELECT * FROM stat_early e WHERE NOT EXISTS (
    SELECT 1 FROM stat_late l WHERE l.date = e.date AND l.province = e.province AND l.city = e.city AND l.ad_id = e.ad_id)
  UNION ALL SELECT * FROM stat_late)"""
    q["upsert_split"] = f"""WITH {ADLOG}, {STAT_EARLY}, {STAT_LATE}
SELECT {D('date')} AS date, province, city, ad_id, click_count,
       CASE WHEN EXISTS (SELECT 1 FROM stat_early e WHERE l.date = e.date AND l.province = e.province
                         AND l.city = e.city AND l.ad_id = e.ad_id) THEN 'update' ELSE 'insert' END AS action
FROM stat_late l"""
    q["replace_groups"] = f"""WITH {ADLOG}, {STAT_EARLY}, {STAT_LATE},
{PROV_TOP('stat_early', 'pe')}, {PROV_TOP('stat_late', 'pl')}
SELECT {D('date')} AS date, province, ad_id, click_count FROM (
  SELECT * FROM pe WHERE NOT EXISTS (SELECT 1 FROM pl WHERE pl.date = pe.date AND pl.province = pe.province)
  UNION ALL SELECT * FROM pl)"""
    q["append_results"] = f"{J1C} SELECT CAST(t.id AS BIGINT) AS task_id, top10.* FROM top10, (VALUES (1), (2)) t(id)"
    # ---------------- streams: same oracle as their batch form
    q["stream_ad_log_parse"] = q["ad_log_parse"]
    q["stream_ad_user_click_count"] = q["ad_user_click_count"]
    q["stream_ad_blacklist"] = q["ad_blacklist_feedback"]
    q["stream_ad_stat"] = q["ad_stat"]
    q["stream_ad_province_top3"] = q["ad_province_top3"]
    q["stream_ad_click_trend"] = q["ad_click_trend"]
    q["stream_ad_sliding_count"] = q["ad_sliding_count"]
    q["stream_ad_click_trend_last_hour"] = q["ad_click_trend_last_hour"]
    q["stream_ad_click_trend_watermark"] = f"""WITH {ADLOG}, {LATENESS},
kept AS (SELECT a.* FROM adlog a JOIN late USING (batch_no) WHERE NOT coalesce({IS_LATE}, false))
{TREND.format(where="").replace("FROM adlog", "FROM kept")}"""
    q["stream_ad_pipeline"] = f"""WITH {ADLOG}, {FEEDBACK},
kstat AS (SELECT date, province, city, ad_id, count(*) AS click_count FROM kept GROUP BY 1,2,3,4),
{PROV_TOP('kstat', 'ktop')},
ktrend AS ({TREND.format(where="").replace("FROM adlog", "FROM kept")}),
klast AS ({TREND.format(where=LAST_HOUR).replace("FROM adlog", "FROM kept")}),
kslide AS ({SLIDING.replace("FROM adlog", "FROM kept")})
SELECT 'user_click_count' AS result, {D('date')} AS date, concat_ws('|', user_id, ad_id) AS key, count(*) AS n
FROM kept GROUP BY ALL
UNION ALL SELECT 'blacklist', '', CAST(user_id AS VARCHAR), 1 FROM breach
UNION ALL SELECT 'ad_stat', {D('date')}, concat_ws('|', province, city, ad_id), click_count FROM kstat
UNION ALL SELECT 'province_top', {D('date')}, concat_ws('|', province, ad_id), click_count FROM ktop
UNION ALL SELECT 'click_trend', date, concat_ws('|', hour, minute, ad_id), click_count FROM ktrend
UNION ALL SELECT 'click_trend_last_hour', date, concat_ws('|', hour, minute, ad_id), click_count FROM klast
UNION ALL SELECT 'sliding_count', window_start, CAST(ad_id AS VARCHAR), click_count FROM kslide
UNION ALL SELECT 'rejects', '', 'city', count(*) FROM events WHERE event_type = 'signup' HAVING count(*) > 0"""
    q["stream_ad_click_trend_late"] = f"""WITH {ADLOG}, {LATENESS},
ontime AS (SELECT a.* FROM adlog a JOIN late USING (batch_no) WHERE NOT coalesce({IS_LATE}, false)),
tardy AS (SELECT a.* FROM adlog a JOIN late USING (batch_no) WHERE {IS_LATE})
SELECT *, 'on time' AS arrival FROM ({TREND.format(where="").replace("FROM adlog", "FROM ontime")})
UNION ALL SELECT *, 'late' FROM ({TREND.format(where="").replace("FROM adlog", "FROM tardy")})"""
    # runs of clicks per (user, ad); the last watermark is an hour before the newest click
    q["stream_ad_click_runs"] = f"""WITH {ADLOG},
step AS (SELECT user_id, ad_id, ts_ms,
                CASE WHEN ts_ms - lag(ts_ms) OVER (PARTITION BY user_id, ad_id ORDER BY ts_ms) <= {IDLE_MS} THEN 0 ELSE 1 END AS new
         FROM adlog),
run AS (SELECT *, sum(new) OVER (PARTITION BY user_id, ad_id ORDER BY ts_ms RANGE UNBOUNDED PRECEDING) AS nth FROM step)
SELECT user_id, ad_id, min(ts_ms) AS first_ms, max(ts_ms) AS last_ms, count(*) AS click_count,
       CASE WHEN max(ts_ms) + {IDLE_MS} < (SELECT max(ts_ms) FROM adlog) - 3600000 THEN 'ended' ELSE 'open' END AS state
FROM run GROUP BY user_id, ad_id, nth"""
    q["stream_line_log_restart"] = f'WITH {ADLOG} SELECT user_id % 3 AS "partition", {LOG_OUT} FROM adlog'
    # ---------------- other mechanisms, same results
    q["ad_blacklist_filter_bloom"] = q["ad_blacklist_filter"]
    q["session_detail_bucketed"] = q["session_detail"]
    q["session_sample_detail_bucketed"] = q["session_sample_detail"]
    q["top10_session_detail_bucketed"] = q["top10_session_detail"]
    q["session_length_stats_observed"] = q["session_length_stats"]
    q["scan_actions_of_task"] = q["scan_actions_by_date"]
    q["stored_upsert_add"] = q["upsert_add"]
    q["stored_upsert_replace"] = q["upsert_replace"]
    q["stored_replace_groups"] = q["replace_groups"]
    return q


def oracle_sql() -> dict[str, str]:
    return _sql()
