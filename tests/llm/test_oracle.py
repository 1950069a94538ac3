"""The corpus queries against their DuckDB SQL at sf0.01; every query has its oracle or brute-force tests."""

import pytest

import __spark_entry__ as E
from clickflow.llm.oracle import ORACLE
from clickflow.llm.queries import QUERIES
from tests.llm.conftest import SF01
from tests.oracle_compare import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    assert E.oracle_sql()[name] == ORACLE[name]
    told = compare(spark, SF01, name, E.queries()[name], ORACLE[name], duck(SF01))
    assert told["status"] == "ok", told


def test_all_operators_are_registered():
    assert set(QUERIES) <= set(E.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
