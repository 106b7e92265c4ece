"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as spark_entry
from checks.compare import compare, connect
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_registry():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(spark_entry.queries())
    assert ORACLE.items() <= spark_entry.oracle_sql().items()
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


def no_python_no_cross_join(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, node


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees(spark, con, name):
    good, text = compare(spark, con, name, SF_DIR, inspect=no_python_no_cross_join)
    assert good, text
