"""Z4 / Z9 with expiry: state per (user, ad) that is updated by key and leaves when the key is idle.

The reference keeps a running total per key for ever.  Here a key's clicks form runs: a click
belongs to a run if it is at most ``idle`` away from one of its clicks.  A run is open, and held in the state store, while
the watermark may still let a click in that extends it; then its timer fires, the run is
emitted once and its state is removed.  So the store holds the active keys only, however many keys
the log has ever had.  ``ttl`` is a second bound, by processing time, for keys whose watermark
stands still; Spark 4.1 refuses it beside event time, so it is unset by default.

Spark partitions the keys and keeps the state (``transformWithState`` on RocksDB).  A call of the state
store from Python costs as much as merging thousands of runs, so keys are dealt by hash to ``parts``:
a part's state is the list of its keys' open runs, read, merged and written at once, and its one timer stands
at the first end among them.  A part's runs must fit a task's memory: ``PARTS`` are for some millions of
active keys, a few thousand a part; give more for more.  The number belongs to a checkpoint and must stay.  A hot key
sends few rows: clicks become runs inside each task first, and runs merge with runs exactly, in any order.

Defined results: clicks without a user or an ad form runs of their own (NULL is a key); clicks in
the same millisecond are one instant; a click older than the watermark is late and dropped, as
in Spark's own windows.
"""

from __future__ import annotations

import sys
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Executors need not have this package: what they run of this module travels with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEYS = ("user_id", "ad_id")
RUN_SCHEMA = "user_id long, ad_id long, first_ms long, last_ms long, click_count long"
STATE_VAR = "open_runs"
#: What is held of a run.  ``nulls`` has 2 for a NULL user and 1 for a NULL ad, which are 0 themselves: without
#: NULLs all numbers stay whole ones in pandas.
HELD = ("nulls", *KEYS, "first_ms", "last_ms", "click_count")
FIRST, LAST, COUNT = 3, 4, 5
PARTS = 1024
#: Rows of a part that wait for a merge, beyond as many as it holds.
WAITING = 100_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

Run = tuple[int, int, int]  # first, last, clicks


def merged(runs: np.ndarray, idle_ms: int) -> np.ndarray:
    """Rows of ``HELD``, of any keys in any order: runs of a key at most ``idle_ms`` apart become one."""
    if not len(runs):
        return runs
    runs = runs[np.lexsort(runs[:, FIRST::-1].T)]
    first, last = runs[:, FIRST], runs[:, LAST]
    new = np.append(True, (runs[1:, :FIRST] != runs[:-1, :FIRST]).any(axis=1))
    reach = pd.Series(last).groupby(new.cumsum()).cummax().to_numpy()
    new[1:] |= first[1:] - reach[:-1] > idle_ms
    at = np.flatnonzero(new)
    out = runs[at]
    out[:, LAST] = np.maximum.reduceat(last, at)
    out[:, COUNT] = np.add.reduceat(runs[:, COUNT], at)
    return out


def merged_runs(runs: list[Run], idle_ms: int) -> list[Run]:
    """Runs of one key at most ``idle_ms`` apart become one."""
    held = np.array([(0, 0, 0, *run) for run in runs], dtype=np.int64).reshape(-1, len(HELD))
    return [tuple(run) for run in merged(held, idle_ms)[:, FIRST:].tolist()]


def runs_in_tasks(clicks: DataFrame, idle_ms: int) -> DataFrame:
    """Clicks (user_id, ad_id, ts_ms) -> the runs they form inside each Arrow batch of a task."""

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            b = batch.sort_values([*KEYS, "ts_ms"], na_position="first")
            key = b[list(KEYS)].fillna(-1).ne(b[list(KEYS)].fillna(-1).shift())
            known = b[list(KEYS)].isna().ne(b[list(KEYS)].isna().shift())
            new = key.any(axis=1) | known.any(axis=1) | (b["ts_ms"].diff() > idle_ms)
            grouped = b.groupby(new.cumsum(), sort=False)
            yield grouped.agg(
                user_id=("user_id", "first"),
                ad_id=("ad_id", "first"),
                first_ms=("ts_ms", "min"),
                last_ms=("ts_ms", "max"),
                click_count=("ts_ms", "size"),
            ).astype({"user_id": "Int64", "ad_id": "Int64"})

    return clicks.select(*KEYS, "ts_ms").mapInPandas(runs, RUN_SCHEMA)


class OpenRuns(StatefulProcessor):
    """Holds the open runs of a part's keys; a timer at the first end among them ends those that are due."""

    def __init__(self, idle_ms: int, ttl_ms: int | None = None):
        self.idle_ms = idle_ms
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState(STATE_VAR, ", ".join(f"{c} array<bigint>" for c in HELD), self.ttl_ms)

    def _ends(self, runs: np.ndarray) -> np.ndarray:
        """The first watermark at which no click on time can extend a run."""
        return runs[:, LAST] + self.idle_ms + 1

    def _hold(self, runs: np.ndarray) -> None:
        if len(runs):
            self.open.update(tuple(runs.T.tolist()))
        else:
            self.open.clear()

    def _held(self) -> np.ndarray:
        state = self.open.get()
        return np.array(state, dtype=np.int64).T if state else np.empty((0, len(HELD)), np.int64)

    @staticmethod
    def _rows(runs: np.ndarray) -> Iterator[pd.DataFrame]:
        if len(runs):
            out = pd.DataFrame(runs, columns=HELD)
            for bit, name in zip((2, 1), KEYS):
                out[name] = out[name].astype("Int64").mask((out["nulls"] & bit) > 0)
            yield out.drop(columns="nulls")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = runs = self._held()
        waiting, n = [], 0
        for part in rows:
            waiting.append(part[list(HELD)].to_numpy(np.int64))
            n += len(part)
            if n > len(runs) + WAITING:
                runs = merged(np.concatenate([runs, *waiting]), self.idle_ms)
                waiting, n = [], 0
        runs = merged(np.concatenate([runs, *waiting]), self.idle_ms)
        self._set_timer(before, runs)
        self._hold(runs)
        return iter(())

    def _set_timer(self, before: np.ndarray, runs: np.ndarray) -> None:
        had, has = (int(self._ends(r).min()) if len(r) else None for r in (before, runs))
        if had != has:
            if had is not None:
                self.handle.deleteTimer(had)
            if has is not None:
                self.handle.registerTimer(has)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        runs = self._held()
        due = self._ends(runs) <= timerValues.getCurrentWatermarkInMs()
        still = runs[~due]
        if len(still):
            self.handle.registerTimer(int(self._ends(still).min()))
        self._hold(still)
        return self._rows(runs[due])

    def close(self) -> None:
        pass


def ended_runs(
    log: DataFrame, idle_ms: int, delay: str = "0 seconds", ttl_ms: int | None = None, parts: int = PARTS
) -> DataFrame:
    """A parsed stream -> each run of clicks once, when it has ended."""
    runs = runs_in_tasks(log, idle_ms).withColumn("last_click", F.timestamp_millis("last_ms"))
    nulls = (F.isnull("user_id").cast("long") * 2 + F.isnull("ad_id").cast("long")).alias("nulls")
    keys = [F.coalesce(c, F.lit(0)).alias(c) for c in KEYS]
    part = F.pmod(F.hash(*KEYS), F.lit(parts)).alias("part")
    return (
        runs.select(part, nulls, *keys, *HELD[FIRST:], "last_click")
        .withWatermark("last_click", delay)
        .groupBy("part")
        .transformWithStateInPandas(OpenRuns(idle_ms, ttl_ms), RUN_SCHEMA, "append", "eventTime")
    )


def start_click_runs(
    log: DataFrame, path: str, checkpoint: str, idle_ms: int, delay: str = "0 seconds",
    trigger: str | None = "5 seconds", ttl_ms: int | None = None, parts: int = PARTS,
):
    """Ended runs -> parquet at ``path`` (append; the file sink's own log makes it exactly-once)."""
    spark = log.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)  # a started query keeps its own copy of the settings
    try:
        w = ended_runs(log, idle_ms, delay, ttl_ms, parts).writeStream.format("parquet").option("path", path)
        w = w.option("checkpointLocation", checkpoint).outputMode("append")
        w = w.trigger(availableNow=True) if trigger is None else w.trigger(processingTime=trigger)
        return w.start()
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def open_runs(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The runs that a stopped or running query still holds, read from its state store."""
    state = spark.read.format("statestore").option("stateVarName", STATE_VAR).load(checkpoint)
    runs = state.select(F.explode(F.arrays_zip(*[f"value.{c}" for c in HELD])).alias("run")).select("run.*")
    null = {name: F.col("nulls").bitwiseAND(bit) > 0 for bit, name in zip((2, 1), KEYS)}
    return runs.select(*[F.when(~null[c], F.col(c)).alias(c) for c in KEYS], *HELD[FIRST:])
