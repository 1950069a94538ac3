"""Registered queries over TESTDATA (``queries``) and their DuckDB oracle SQL (``oracle_sql``)."""

from clickflow.plans.oracle import oracle_sql  # noqa: F401
from clickflow.plans.registry import queries, run  # noqa: F401
