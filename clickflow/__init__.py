"""clickflow: clickstream and ad-click analytics expressed as Spark DataFrame plans.

The operators take DataFrames (and typed parameters) and return lazy DataFrames; the jobs and
streams built on them write tables.  Only parameters and folder listings reach the driver.
Catalyst plans the work, so filters reach the parquet scan, aggregates combine map-side and
top-k windows are limited before their shuffle.
"""

from clickflow.config import configure_session, work_dir  # noqa: F401
from clickflow.params import AdParams, AreaParams, FunnelParams, SessionParams  # noqa: F401

__all__ = [
    "AdParams",
    "AreaParams",
    "FunnelParams",
    "SessionParams",
    "configure_session",
    "work_dir",
]
