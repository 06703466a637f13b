"""Differential check: every registered query equals its DuckDB twin (sf0.001).

Set WM_ORACLE_SF to run at another scale factor folder.
"""

import os
import re

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck

SF = os.environ.get("WM_ORACLE_SF", "/root/testdata/sf0.001")
OWN = {n for n in E.queries() if n != "pipeline" and not re.match(r"op\d+_", n)}  # tests/llm has the others
SQL = {n: q for n, q in E.oracle_sql().items() if n in OWN}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["split", "Label", "n_rows", "total_tokens", "longest"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, con, name):
    ok, msg = compare(spark, con, SF, name, E.queries()[name], SQL[name])
    assert ok, msg


@pytest.mark.parametrize("name", sorted(OWN - set(SQL)))
def test_rows_only_queries_run(spark, name):
    rows = E.queries()[name](spark, SF)
    assert rows.count() > 0 and len(set(rows.columns)) == len(rows.columns)
