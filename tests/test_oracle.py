"""Every registered query against its DuckDB oracle (row count, column names, exact values).

Runs on sf0.001 by default for speed; set ORACLE_SF_DIR=/root/testdata/sf0.01 for the size the
driver uses.
"""

import os

import pytest

import __spark_entry__ as entry_module
from costmart.plans.catalog import all_queries
from tests.oracle_check import compare, duck
from tests.oracle_sql import oracle_queries

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = all_queries()
ORACLES = oracle_queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_registered():
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    result = compare(QUERIES[name](spark, SF), con, ORACLES[name])
    assert result["ok"], result


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    rows = df.collect()
    assert df.columns == ["cloud_provider", "total_cost_usd", "num_line_items"]
    assert {r.cloud_provider for r in rows} == {"AWS", "GCP"}
