"""Free ranks of groups, small and large, and the tasks that hold their pairs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from depotlens.operators import ordering


def tasks(df):
    return df.select(F.spark_partition_id()).distinct().count()


@pytest.mark.parametrize("most", [0, 30, 60, 1000])
@pytest.mark.parametrize("counted", [True, False])
def test_large_groups_go_by_blocks_and_small_ones_whole(spark, most, counted):
    chance = random.Random(7)
    taken = {g: sorted(chance.sample(range(40), n)) for g, n in ((1, 0), (2, 5), (3, 20), (4, 35))}
    wants = [(g, r, f"{g}-{r}") for g in taken for r in range(40 - len(taken[g])) for _ in range(1 + r % 2)]
    pairs = spark.createDataFrame([(g, p) for g, ps in taken.items() for p in ps] + [(None, 3), (2, None)], "g int, p int")
    asks = spark.createDataFrame([*wants, (None, 1, "x"), (3, None, "y")], "g int, r int, note string")
    sizes = None
    if counted:
        sizes = pairs.select("g").unionByName(asks.select("g")).groupBy("g").agg(F.count(F.lit(1)).alias("rows"))
    got = ordering.nth_missing(pairs, asks, "g", "p", "r", block=4, sizes=sizes, most=most)
    free = {g: [p for p in range(40) if p not in ps] for g, ps in taken.items()}
    assert got.columns == ["g", "r", "note", "position"]
    assert sorted(map(tuple, got.collect())) == sorted((g, r, note, free[g][r]) for g, r, note in wants)


def test_narrow_rows_of_small_groups_are_not_merged_into_one_task(spark):
    pairs = spark.range(400).select((F.col("id") % 40).alias("g"), F.floor(F.col("id") / 40).cast("bigint").alias("p"))
    asks = pairs.select("g", F.col("p").alias("r"))
    got = ordering.nth_missing(pairs, asks, "g", "p", "r")
    # Both sides travel together, once.
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    assert tasks(got) == 4 and {r.position - r.r for r in got.collect()} == {10}
