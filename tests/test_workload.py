"""Every bound query equals its SQL, at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference
from workload import oracles
from workload.queries import QUERIES as BOUND
from workload.queries import bound

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: bound(run) for name, run in BOUND.items()}
SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_entry_ranks_hubs(spark):
    df = entry.entry(spark)
    assert df.columns == ["symbol", "pathway_count"]
    rows = df.collect()
    assert rows and [r[1] for r in rows] == sorted((r[1] for r in rows), reverse=True)


def test_flagship_reads_only_its_columns(spark):
    plan = QUERIES["hub_by_symbol"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,F)]" in plan
    assert "l_extendedprice" not in plan and "CartesianProduct" not in plan
