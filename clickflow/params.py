"""Typed job parameters.

The reference keeps parameters as a JSON object of arrays in a ``task`` table and
reads element 0 of each array.  Here they are dataclasses; :func:`task_param_columns`
parses the JSON column in Spark, and :func:`load_task` turns one task row into typed
parameters (one row is read on the driver: parameters shape the plan).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parameter keys of the task JSON object.
PARAM_KEYS = (
    "startDate",
    "endDate",
    "startAge",
    "endAge",
    "professionals",
    "cities",
    "sex",
    "keywords",
    "categoryIds",
    "targetPageFlow",
)

# The reference's area → level mapping (its default).
DEFAULT_AREA_LEVELS: Mapping[str, str] = {
    "华北": "A level",
    "华东": "A level",
    "华南": "B level",
    "华中": "B level",
    "西北": "C level",
    "西南": "C level",
}
DEFAULT_AREA_LEVEL_ELSE = "D level"


def _split_values(values: Sequence[str] | str | None) -> list[str] | None:
    """Accept ``['a,b']``, ``['a', 'b']`` or ``'a,b'``; flatten and comma-split."""
    if values is None:
        return None
    if isinstance(values, str):
        values = [values]
    out: list[str] = []
    for v in values:
        if v is None:
            continue
        out.extend(p for p in str(v).split(",") if p != "")
    return out or None


@dataclass(frozen=True)
class SessionParams:
    """Session-analysis filter.  ``None`` means "not set" and lets every row pass."""

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] | None = None
    cities: tuple[str, ...] | None = None
    sex: tuple[str, ...] | None = None
    keywords: tuple[str, ...] | None = None
    category_ids: tuple[int, ...] | None = None

    @staticmethod
    def from_dict(d: Mapping[str, object]) -> "SessionParams":
        def first(key):
            vals = _split_values(d.get(key))  # type: ignore[arg-type]
            return vals[0] if vals else None

        def many(key, cast=str):
            vals = _split_values(d.get(key))  # type: ignore[arg-type]
            return tuple(cast(v) for v in vals) if vals else None

        age0, age1 = first("startAge"), first("endAge")
        return SessionParams(
            start_date=first("startDate"),
            end_date=first("endDate"),
            start_age=int(age0) if age0 is not None else None,
            end_age=int(age1) if age1 is not None else None,
            professionals=many("professionals"),
            cities=many("cities"),
            sex=many("sex"),
            keywords=many("keywords"),
            category_ids=many("categoryIds", int),
        )

    @staticmethod
    def from_task(tasks: DataFrame, task_id: int) -> "SessionParams":
        """Parameters of one row of the ``task`` table."""
        return SessionParams.from_dict(load_task(tasks, task_id))


@dataclass(frozen=True)
class FunnelParams:
    """Page-funnel parameters: date range and the target page flow."""

    flow: tuple[int, ...]
    start_date: str | None = None
    end_date: str | None = None

    def __post_init__(self):
        if len(self.flow) < 1:
            raise ValueError("target page flow needs at least one page")

    @staticmethod
    def from_dict(d: Mapping[str, object]) -> "FunnelParams":
        flow = _split_values(d.get("targetPageFlow"))  # type: ignore[arg-type]
        if not flow:
            raise ValueError("targetPageFlow is missing")
        s = SessionParams.from_dict(d)
        return FunnelParams(flow=tuple(int(p) for p in flow), start_date=s.start_date, end_date=s.end_date)

    @staticmethod
    def from_task(tasks: DataFrame, task_id: int) -> "FunnelParams":
        return FunnelParams.from_dict(load_task(tasks, task_id))


@dataclass(frozen=True)
class AreaParams:
    """Area top-N parameters: date range, level mapping and N."""

    start_date: str | None = None
    end_date: str | None = None
    levels: Mapping[str, str] = field(default_factory=lambda: dict(DEFAULT_AREA_LEVELS))
    level_else: str = DEFAULT_AREA_LEVEL_ELSE
    top_n: int = 3

    @staticmethod
    def from_task(tasks: DataFrame, task_id: int) -> "AreaParams":
        """Date range of one task row; levels keep their default mapping."""
        s = SessionParams.from_dict(load_task(tasks, task_id))
        return AreaParams(start_date=s.start_date, end_date=s.end_date)


@dataclass(frozen=True)
class AdParams:
    """Ad-stream parameters: blacklist threshold (D15), top-n per province,
    micro-batch interval (Z1), sliding window/slide (Z7) and the optional
    event-time watermark of the single-table minute trend (Z8).  With ``lateness`` the whole job
    takes a click whose minute ended that long before the newest click of earlier batches as late."""

    blacklist_threshold: int = 100
    top_n: int = 3
    trigger: str = "5 seconds"
    window: str = "60 minutes"
    slide: str = "10 seconds"
    watermark: str | None = None
    lateness: str | None = None


def task_param_columns(task_param: Column) -> list[Column]:
    """Parse the task JSON (``{"key": ["v", ...]}``) into one column per key.

    Each column holds element 1 of the array (``try_element_at`` → NULL when the
    key is absent or the array is empty).
    """
    parsed = F.from_json(task_param, "map<string,array<string>>")
    return [F.try_element_at(parsed[k], F.lit(1)).alias(k) for k in PARAM_KEYS]


def load_task(tasks: DataFrame, task_id: int) -> dict[str, list[str]]:
    """Read one task's parameter JSON (S6).  Unknown id → ``ValueError``."""
    rows = tasks.filter(F.col("task_id") == F.lit(task_id)).select("task_param").limit(2).collect()
    if not rows:
        raise ValueError(f"unknown task id {task_id}")
    if len(rows) > 1:
        raise ValueError(f"task id {task_id} is not unique")
    raw = rows[0]["task_param"]
    data = json.loads(raw) if raw else {}
    return {k: v if isinstance(v, list) else [v] for k, v in data.items()}
