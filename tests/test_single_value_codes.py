"""A column of one value is coded without a join that meets all rows with all."""

from __future__ import annotations

from pyspark.sql import functions as F

from depotlens.operators.ordering import factorize_many


def test_constants_are_coded_without_a_nested_loop(spark):
    df = spark.createDataFrame([(1, "b", None), (2, None, None), (3, "a", None)], "id int, word string, n string")
    df = df.select("*", F.lit("same").alias("fixed"), F.lit(None).cast("int").alias("none"))
    got = factorize_many(df, {"fixed": "f", "word": "w", "n": "e"})
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.id, r.f, r.w, r.e) for r in got.collect()) == [(1, 0, 2, 0), (2, 0, 0, 0), (3, 0, 1, 0)]
    assert dict(got.dtypes)["f"] == dict(got.dtypes)["w"] == "bigint"
    assert factorize_many(df, {"none": "c"}).select("c").distinct().first().c is None
