"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as E
from clickflow import plans
from tests.conftest import SF001, SF01
from tests.oracle_compare import compare, duck

BASE = plans.queries()
QUERIES = {name: fn for name, fn in E.queries().items() if name in BASE}
ORACLE = {name: sql for name, sql in E.oracle_sql().items() if name in BASE}


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle_or_is_rows_only():
    missing = set(QUERIES) - set(ORACLE) - set(E.ROWS_ONLY)
    assert not missing, missing
    assert set(ORACLE) <= set(QUERIES), set(ORACLE) - set(QUERIES)
    assert E.ROWS_ONLY == ()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF01, name, QUERIES[name], ORACLE.get(name), con)
    assert r["status"] in ("ok", "rows-only"), r
    if r["status"] == "rows-only":
        assert r["spark_rows"] > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == [
        "area", "area_level", "product_id", "click_count", "city_infos", "product_name", "product_status"
    ]


def test_queries_are_lazy_and_repeatable(spark):
    a = QUERIES["top10_category"](spark, SF001).collect()
    b = QUERIES["top10_category"](spark, SF001).collect()
    assert a == b
