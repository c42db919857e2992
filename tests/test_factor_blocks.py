"""Factors are sent to as many blocks as tasks run at once."""

from __future__ import annotations

import pytest

from depotlens.operators import recommend


def test_factor_blocks_do_not_follow_shuffle_partitions(spark, monkeypatch):
    class Asked(Exception):
        pass

    def als(**options):
        raise Asked(options["numUserBlocks"], options["numItemBlocks"])

    monkeypatch.setattr(recommend, "ALS", als)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        with pytest.raises(Asked) as asked:
            recommend.als_implicit(spark.createDataFrame([(1, 1, 1.0)], "customer_id int, product_id int, weight double"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    blocks = max(10, spark.sparkContext.defaultParallelism)
    assert asked.value.args == (blocks, blocks)
