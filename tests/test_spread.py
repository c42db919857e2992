"""Steps that hold a table of their rows keep the tasks that the session sets, however few bytes their shuffle has."""

from __future__ import annotations

from pyspark.sql import functions as F

from depotlens.sources.star_schema import StarSchemaFeeds


def tasks(df):
    return df.select(F.spark_partition_id()).distinct().count()


def test_stock_of_pairs_is_not_merged_into_one_task(spark, tmp_path):
    rows = [(i % 40, i % 50, float(1 + i % 7), float(i)) for i in range(400)] + [(None, 1, 2.0, 3.0), (None, 1, 4.0, 5.0)]
    lines = spark.createDataFrame(rows, "l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    stock = StarSchemaFeeds(spark, str(tmp_path)).inventory
    assert tasks(stock.select("pharmacy_id", "product_id", "current_stock")) == 4
    assert stock.count() == 201
    assert [r.current_stock for r in stock.where("product_id is null").collect()] == [6]
