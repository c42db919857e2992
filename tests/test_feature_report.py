"""What travels for the feature report: products never with the pairs, and one reading of whole orders."""

from __future__ import annotations

import re

import pytest

import __spark_entry__


@pytest.fixture
def plan(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = __spark_entry__.queries()["gold_ml_ready_dataset"](spark, "/root/testdata/sf0.001")
        yield df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pairs_meet_products_last(plan):
    last = next(line for line in plan.splitlines() if "Join" in line)
    assert "product_id" in last and "customer_id" not in last


def test_no_filter_of_the_products_reaches_one_copy_of_the_cells(plan):
    assert "p_partkey" not in plan
    # Both sides, measures and distinct values, and pairs: five times the same cells, of which Spark makes one.
    cells = [re.sub(r"#\d+L?", "", line) for line in plan.splitlines() if "Scan parquet" in line and "order_value_tier" in line]
    assert len(cells) == 5 and len({line[line.index("FileScan") :] for line in cells}) == 1
