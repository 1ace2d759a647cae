"""Queries that SQL can express equal their DuckDB SQL at sf0.01."""

from __future__ import annotations

import pytest

from conftest import SF01
from ebbtide.llm import oracle, queries
from oracle_compare import compare, duck


@pytest.mark.parametrize("name", sorted(oracle.all_queries()))
def test_matches_oracle(spark, name):
    r = compare(spark, name, queries.all_queries()[name], oracle.all_queries()[name], SF01, duck(SF01))
    assert r["columns_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["spark_rows"] == r["oracle_rows"]
    assert r["values_match"], (r.get("only_spark"), r.get("only_oracle"))
