"""Written frames leave no shuffle files behind."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from depotlens.session import CLEANUP, settle


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_a_settled_frame_removes_its_shuffle(spark):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP)
    frame = spark.range(1000).repartition(7, "id").groupBy((F.col("id") % 13).alias("k")).count()
    first = settle(frame)
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(CLEANUP) == setting
    # The same frame can be run again.
    assert sorted(settle(frame).collect()) == sorted(first.collect()) and frame.count() == 13
