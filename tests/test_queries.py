"""Every registered query against its SQL, and the shape of every plan."""

from __future__ import annotations

import pytest

import __spark_entry__
from checks.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
# The corpus queries have tests of their own beside them.
QUERIES = {n: build for n, build in __spark_entry__.queries().items() if n not in {**__spark_entry__.CORPUS, **__spark_entry__.PIPELINE}}
ORACLES = __spark_entry__.oracle_sql()
# Queries that may find nothing in the smallest tables.
MAY_BE_EMPTY: frozenset[str] = frozenset()
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in plan]
    if name in ORACLES:
        assert compare(df, duck, ORACLES[name]) in ("", "no rows" if name in MAY_BE_EMPTY else "")
    else:
        assert df.count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_scans_read_only_the_used_columns(spark):
    df = QUERIES["dash_revenue_by_week"](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "c_acctbal" not in plan


def test_filters_reach_the_scan(spark):
    df = QUERIES["preview_table"](spark, FOLDER)
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()
    df = QUERIES["bronze_promotions"](spark, FOLDER)
    assert "GreaterThan(l_discount,0.05)" in df._jdf.queryExecution().executedPlan().toString()
