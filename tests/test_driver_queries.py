"""Every driver query against its DuckDB oracle, plus the entry contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from submart.plans.driver_queries import QUERIES
from submart.plans.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    ok, msg = compare(df, con, ORACLE_SQL[name])
    assert ok, msg


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[-1] == "run_date"
