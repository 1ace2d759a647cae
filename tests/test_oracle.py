"""Every registered query equals its DuckDB oracle at sf0.01 (the driver's gate)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod
from conftest import SF01
from ebbtide import queries as registry
from oracle_compare import compare, duck

# The training-data queries, where present, have tests of their own.
QUERIES = {k: v for k, v in entry_mod.queries().items() if k in registry.all_spark_queries()}
ORACLE = {k: v for k, v in entry_mod.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF01, con)
    assert r["columns_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["spark_rows"] == r["oracle_rows"]
    assert r["values_match"], (r.get("only_spark"), r.get("only_oracle"))
