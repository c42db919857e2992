"""Counts of free products are spread over the tasks that the session sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from depotlens.operators import recommend


def tasks(df):
    return df.select(F.spark_partition_id()).distinct().count()


def test_counts_of_a_customer_do_not_fill_one_task(spark):
    bought = spark.range(400).select((F.col("id") % 40).alias("customer_id"), (F.col("id") % 7).alias("product_id"))
    catalogue = spark.range(6).select(F.col("id").alias("product_id"))
    got = recommend.not_purchased_counts(bought, catalogue)
    assert tasks(got) == 4
    want = {c: len({i % 7 for i in range(400) if i % 40 == c} - {6}) for c in range(40)}
    assert {r.customer_id: (r.n_bought, r.n_free) for r in got.collect()} == {c: (n, 6 - n) for c, n in want.items()}
