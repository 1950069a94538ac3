"""State with expiry, the replayable source, the Bloom split, and stored layouts of the action table."""

import datetime as dt
import json
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickflow.config import local_path, work_dir
from clickflow.operators import ads, membership, session, tables
from clickflow.params import AdParams
from clickflow.plans.replay import replay
from clickflow.sources import layout
from clickflow.sources.line_log import LineLogReader, line_log_stream
from clickflow.sources.readers import parse_ad_log
from clickflow.streaming import ads_stream as st
from clickflow.streaming import click_runs


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- click runs ------------------------------------------------------------------------
def _runs(clicks, idle):
    """Brute force: sort each key's clicks and cut at gaps longer than idle."""
    out, by = [], {}
    for key, ms in clicks:
        by.setdefault(key, []).append(ms)
    for key, times in by.items():
        times.sort()
        first = last = times[0]
        n = 0
        for t in times:
            if t - last > idle:
                out.append((*key, first, last, n))
                first, n = t, 0
            last, n = t, n + 1
        out.append((*key, first, last, n))
    return out


def test_runs_merge_in_any_order():
    r = random.Random(1)
    for _ in range(50):
        times = [r.randint(0, 300) for _ in range(30)]
        want = [x[1:] for x in _runs([((0,), t) for t in times], 7)]
        runs = [(t, t, 1) for t in times]
        r.shuffle(runs)
        half = click_runs.merged_runs(runs[:15], 7) + click_runs.merged_runs(runs[15:], 7)
        assert click_runs.merged_runs(half, 7) == sorted(want)


def test_idle_keys_leave_the_state_store(spark):
    """Runs are emitted once when they end; the store holds the rest, also after a restart.  NULL keys,
    clicks out of order within a batch, and a hot key."""
    idle, r = 1000, random.Random(2)
    base = work_dir(spark, "test-runs")
    keys = [(1, 1), (1, 2), (None, 1), (2, None), (None, None)]
    rows = [(k[0], k[1], b * 20_000 + r.randint(0, 15_000), b) for b in range(3) for k in keys for _ in range(12)]
    rows += [(7, 7, b * 20_000 + i, b) for b in range(3) for i in range(3000)]
    df = spark.createDataFrame(rows, "user_id long, ad_id long, ts_ms long, batch_no int")

    def start(stream, trigger):
        return click_runs.start_click_runs(stream, f"{base}/out", f"{base}/ckpt", idle, trigger=trigger)

    replay(spark, df.filter("batch_no < 2"), "batch_no", f"{base}/source", start)
    half = [x for x in rows if x[3] < 2]
    _check_runs(spark, base, half, idle)
    replay(spark, df.filter("batch_no = 2"), "batch_no", f"{base}/source2", lambda s, t: _restart(spark, base, idle, t))
    _check_runs(spark, base, rows, idle)


def _restart(spark, base, idle, trigger):
    """The same query over the first source folder, which the later batch joins."""
    os.rename(local_path(f"{base}/source2/b000000"), local_path(f"{base}/source/b000002"))
    schema = "user_id long, ad_id long, ts_ms long, batch_no int"
    stream = spark.readStream.schema(schema).parquet(f"{base}/source/*")
    return click_runs.start_click_runs(stream, f"{base}/out", f"{base}/ckpt", idle, trigger=trigger)


def _check_runs(spark, base, rows, idle):
    newest = max(x[2] for x in rows)
    every = _runs([(x[:2], x[2]) for x in rows], idle)
    ended = [x for x in every if x[3] + idle < newest]
    got = spark.read.schema(click_runs.RUN_SCHEMA).parquet(f"{base}/out").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, ended))
    still = click_runs.open_runs(spark, f"{base}/ckpt").collect()
    assert sorted(map(str, map(tuple, still))) == sorted(map(str, [x for x in every if x not in ended]))
    assert 0 < len(still) < len(every)


def test_state_is_kept_by_parts_of_keys(spark):
    """Many keys cost few entries of the state store; NULL keys lie in the same batches as others."""
    idle, r = 1000, random.Random(3)
    base = work_dir(spark, "test-parts")
    keys = [(u, a) for u in [None, -1, 0, *range(1, 1500)] for a in [None, 0, 1]]
    rows = [(*k, 1 + b * 5000 + r.randint(0, 4000), b) for b in range(2) for k in keys for _ in range(2)]
    df = spark.createDataFrame(rows, "user_id long, ad_id long, ts_ms long, batch_no int")

    def start(stream, trigger):
        return click_runs.start_click_runs(stream, f"{base}/out", f"{base}/ckpt", idle, trigger=trigger)

    replay(spark, df, "batch_no", f"{base}/source", start)
    _check_runs(spark, base, rows, idle)
    state = spark.read.format("statestore").option("stateVarName", click_runs.STATE_VAR).load(f"{base}/ckpt")
    assert 0 < state.count() <= click_runs.PARTS < len(keys)


class _Part:
    """A part's value state and timers, with a count of the calls."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, *_):
        return self

    def _called(self):
        self.calls += 1

    def get(self):
        self._called()
        return self.value

    def update(self, value):
        self._called()
        self.value = value

    def clear(self):
        self._called()
        self.value = None

    def registerTimer(self, ms):
        self._called()
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self._called()
        self.timers.remove(ms)

    def getCurrentWatermarkInMs(self):
        return self.watermark


def test_a_part_of_many_keys_takes_few_calls(monkeypatch):
    monkeypatch.setattr(click_runs, "WAITING", 50)
    idle, r, at, emitted = 20, random.Random(4), _Part(), []
    runs = click_runs.OpenRuns(idle)
    runs.init(at)
    clicks = [(u, a, b * 300 + r.randint(0, 299)) for b in range(3) for u in (None, 0, 2**60, 2**60 + 1) for a in range(50) for _ in range(4)]
    for b in range(3):
        held = [(2 * (u is None), u or 0, a, t, t, 1) for u, a, t in clicks if t // 300 == b]
        r.shuffle(held)
        chunks = [pd.DataFrame(held[i : i + 30], columns=click_runs.HELD) for i in range(0, len(held), 30)]
        assert list(runs.handleInputRows((0,), iter(chunks), at)) == []
        at.watermark = max(h[4] for h in held)
        while due := [t for t in at.timers if t <= at.watermark]:
            at.timers -= set(due)
            for out in runs.handleExpiredTimer((0,), at, None):
                emitted += [tuple(None if v is pd.NA else int(v) for v in x) for x in out.astype(object).itertuples(index=False)]
    every = _runs([(c[:2], c[2]) for c in clicks], idle)
    still = [(None if x[0] else x[1], *x[2:]) for x in zip(*at.value)]
    want = [x for x in every if x[3] + idle < at.watermark]
    assert sorted(map(str, emitted)) == sorted(map(str, want))
    assert sorted(map(str, still)) == sorted(map(str, [x for x in every if x not in want]))
    assert len(want) > 1000 and at.calls <= 3 * 7


# -- line log --------------------------------------------------------------------------
def _publish(root, partition, segment, *files):
    folder = root / f"partition={partition}" / f"segment={segment}"
    folder.mkdir(parents=True)
    for i, text in enumerate(files):
        (folder / f"part-{i}.txt").write_bytes(text.encode())
    (folder / "_SUCCESS").write_text("")


def _run_log(spark, tmp_path, most=0):
    stream = line_log_stream(spark, f"file://{tmp_path}/log", most)
    q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    q = q.option("checkpointLocation", str(tmp_path / "ckpt")).trigger(processingTime="100 milliseconds").start()
    try:
        q.processAllAvailable()
        return [json.loads(p.json)["numInputRows"] for p in q.recentProgress]
    finally:
        q.stop()


def _lines(spark, tmp_path):
    return sorted((r.partition, r.segment, r.value) for r in spark.read.parquet(str(tmp_path / "out")).collect())


@pytest.mark.parametrize("most", [0, 1])
def test_a_restarted_query_reads_every_line_once(spark, tmp_path, most):
    log = tmp_path / "log"
    _publish(log, 0, 0, "a\nb\n", "c")  # the last line may lack its end
    _publish(log, 0, 1, "", "d\n")
    _publish(log, 1, 5, "x\n\ny\n")  # older segments are gone; an empty line is a line
    _run_log(spark, tmp_path, most)
    want = [(0, 0, "a"), (0, 0, "b"), (0, 0, "c"), (0, 1, "d"), (1, 5, ""), (1, 5, "x"), (1, 5, "y")]
    assert _lines(spark, tmp_path) == want
    _run_log(spark, tmp_path, most)  # nothing new: nothing is read
    assert _lines(spark, tmp_path) == want
    _publish(log, 0, 2, "e\n")
    _publish(log, 0, 4, "not yet\n")  # segment 3 isn't published
    _publish(log, 2, 0, "é\U0001f600" * 200_000 + "\n")  # a new partition, a line beyond one read block
    _run_log(spark, tmp_path, most)
    want = sorted([*want, (0, 2, "e"), (2, 0, "é\U0001f600" * 200_000)])
    assert _lines(spark, tmp_path) == want
    _publish(log, 0, 3, "f\n")
    _run_log(spark, tmp_path, most)
    assert _lines(spark, tmp_path) == sorted([*want, (0, 3, "f"), (0, 4, "not yet")])


def test_a_batch_lost_before_its_commit_is_read_again(spark, tmp_path):
    """Offsets logged but not committed: the restarted query repeats that batch between the same offsets."""
    log = tmp_path / "log"
    _publish(log, 0, 0, "a\n")
    _run_log(spark, tmp_path)
    last = max((tmp_path / "ckpt" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    _publish(log, 0, 1, "b\n")
    _run_log(spark, tmp_path)
    commits = sorted((p for p in (tmp_path / "ckpt" / "commits").glob("[0-9]*") if int(p.name) > int(last.name)))
    for c in commits:
        c.unlink()
        (c.parent / f".{c.name}.crc").unlink(missing_ok=True)
    _publish(log, 0, 2, "c\n")
    _run_log(spark, tmp_path)
    assert _lines(spark, tmp_path) == [(0, 0, "a"), (0, 1, "b"), (0, 2, "c")]


def test_offsets_are_bounded_per_batch(tmp_path):
    for n in range(4):
        _publish(tmp_path, 0, n, f"{n}\n")
    reader = LineLogReader({"path": str(tmp_path), "segmentsperbatch": "2", "segmentsPerBatch": "2"})
    start = reader.initialOffset()
    seen = []
    for _ in range(3):
        end = reader.latestOffset()
        seen.append(end["0"])
        ranges = reader.partitions(start, end)
        assert [(r.start, r.end) for r in ranges] == [(i, i + 1) for i in range(start.get("0", 0), end["0"])]
        start = end
    assert seen == [2, 4, 4]
    assert LineLogReader({"path": str(tmp_path / "none")}).latestOffset() == {}


# -- Bloom split -----------------------------------------------------------------------
@pytest.mark.parametrize("bits", [64, 1 << 12, 1 << 20])
def test_bloom_split_is_exact(spark, bits):
    rows = spark.createDataFrame([(i % 997 if i % 50 else None, i) for i in range(5000)], "user_id long, x int")
    for listed in (range(0, 997, 3), range(5000, 5400), []):
        black = spark.createDataFrame([(i,) for i in [*listed, *listed]] + [(None,)], "user_id long")
        got = membership.anti_join_long(rows, black, "user_id", bits=bits)
        want = ads.blacklist_filter(rows, black)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_bloom_split_keeps_clear_rows_out_of_the_shuffle(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "user_id")
    black = spark.range(0, 20_000, 100).withColumnRenamed("id", "user_id")
    suspects, clear = membership.split_by_filter(rows, black, "user_id", bits=1 << 14)
    assert 200 <= suspects.count() < 400 and suspects.count() + clear.count() == 20_000
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(membership.anti_join_long(rows, black, "user_id", bits=1 << 14))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan[plan.index("Union") :].splitlines()[1:]
    clear_branch = [x for x in lines if x.startswith("   :") and not x.startswith("   :     :")]  # without the filter's subquery
    assert any("getbit" in x for x in clear_branch) and not any("Exchange" in x for x in clear_branch), clear_branch


# -- layouts ---------------------------------------------------------------------------
def test_bucketed_tables_join_without_a_shuffle(spark):
    from clickflow.plans import registry as Q
    from tests.conftest import SF001

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        acts, kept = Q.session_tables(spark, SF001)
        detail = layout.with_bucket(acts, kept.select("session_id"))
        assert "Exchange" not in _plan(detail) and "SortMergeJoin" in _plan(detail)
        counts = detail.groupBy("session_id").count()
        assert "Exchange" not in _plan(counts)  # also what is counted per session stays in its bucket
        assert detail.count() == Q.detail(spark, SF001).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _dated(spark, tmp_path):
    rows = [(dt.date(2024, 1, d), i) for d in range(1, 11) for i in range(3)] + [(None, 9)]
    return layout.dated(spark.createDataFrame(rows, "date date, x int"), str(tmp_path / "dated"))


def test_the_range_of_a_task_prunes_folders(spark, tmp_path):
    stored = _dated(spark, tmp_path)
    params = [
        (1, {"startDate": ["2024-01-03"], "endDate": ["2024-01-04"]}),
        (2, {"startDate": ["2024-01-09"]}),
        (3, {"endDate": ["2024-01-01"]}),
        (4, {}),
    ]
    tasks = spark.createDataFrame([(i, json.dumps(p)) for i, p in params], "task_id long, task_param string")
    days = lambda i: sorted({str(r.date) for r in layout.actions_of_task(stored, tasks, i).collect()})
    assert days(1) == ["2024-01-03", "2024-01-04"]
    assert days(2) == ["2024-01-09", "2024-01-10"]
    assert days(3) == ["2024-01-01"]
    assert len(days(4)) == 11  # no bound: also actions without a date
    assert days(99) == []
    got = layout.actions_of_task(stored, tasks, 1)
    got.collect()
    scan = [x for x in _plan(got).splitlines() if "FileScan parquet" in x and "PartitionFilters: [" in x]
    assert any("ubquery" in x.split("PartitionFilters: ")[1].split("PushedFilters")[0] for x in scan), scan


def test_only_the_folders_of_the_range_are_read(spark, tmp_path):
    """Files of other days may be unreadable: they are never opened."""
    stored = _dated(spark, tmp_path)
    for p in (tmp_path / "dated").glob("date=2024-01-0[5-9]/*.parquet"):
        p.write_bytes(b"not parquet")
        (p.parent / f".{p.name}.crc").unlink(missing_ok=True)
    tasks = spark.createDataFrame([(1, json.dumps({"startDate": ["2024-01-03"], "endDate": ["2024-01-04"]}))], "task_id long, task_param string")
    assert layout.actions_of_task(stored, tasks, 1).count() == 6


# -- observed counters -----------------------------------------------------------------
def test_observed_lengths_equal_the_aggregate(spark):
    rows = [(i, (i * 7) % 2000, i % 70) for i in range(500)] + [(1000, None, 3), (1001, 5, None)]
    for some in (rows, rows[:1], []):
        df = spark.createDataFrame(some, "session_id long, visit_length long, step_length long")
        seen = session.ObservedLengths()
        written = tables.materialize(seen.watch(df), "test-observed")
        assert [tuple(r) for r in seen.stats(df).collect()] == [tuple(r) for r in session.length_stats(df).collect()]
        assert written.count() == len(some)


# -- late clicks -----------------------------------------------------------------------
def test_late_and_on_time_clicks_add_up(spark):
    at = lambda s: int(dt.datetime.fromisoformat(s).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    batches = [
        [at("2024-01-01T10:00:05"), at("2024-01-01T12:00:30")],
        [at("2024-01-01T10:59:59"), at("2024-01-01T11:00:00"), at("2024-01-01T10:58:00")],  # watermark 11:00
        [at("2024-01-01T15:00:00"), at("2024-01-01T11:30:00")],
        [at("2024-01-01T13:59:59"), at("2024-01-01T14:00:00")],  # watermark 14:00
    ]
    p = st.AdPipeline(spark, work_dir(spark, "test-late"), AdParams(lateness="1 hour"), merge_every=2)
    for b, times in enumerate(batches):
        df = spark.createDataFrame([(f"{t} p c 1 1",) for t in times] + [("bad",)], "value string")
        for _ in range(2):  # replayed
            p.process(parse_ad_log(df), b)
    r = p.results()
    clock = lambda df: sorted((x.hour + x.minute, x.click_count) for x in df.collect())
    assert clock(r["late_clicks"]) == [("1058", 1), ("1059", 1), ("1359", 1)]
    assert clock(r["click_trend"]) == [("1000", 1), ("1100", 1), ("1130", 1), ("1200", 1), ("1400", 1), ("1500", 1)]
    assert r["ad_stat"].agg(F.sum("click_count")).first()[0] == 9
    assert r["rejects"].collect()[0]["n_lines"] == 4
