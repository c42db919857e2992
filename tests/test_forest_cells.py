"""Forests are trained on cells of like rows, and node scores are compiled."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from depotlens.operators import forests, inventory, splits, trees
from depotlens.session import settle


def test_cuts_lie_between_all_values_or_at_even_steps():
    assert forests.cuts_of([]) == [] and forests.cuts_of([3.0, 3.0]) == []
    assert forests.cuts_of([1.0, 2.0, 2.0, 4.0]) == [1.5, 3.0]
    many = forests.cuts_of(np.arange(1000.0))
    assert len(many) == 31 and np.allclose(np.diff(many), 31.25, atol=1)
    # Half of the rows share a value, the cuts behind it still differ.
    skewed = forests.cuts_of([0.0] * 500 + list(range(1, 501)))
    assert 10 <= len(skewed) <= 31 and skewed[0] == 0.5


def test_draws_are_poisson():
    means = np.repeat([1, 7, 50_000], 2000)
    drawn = forests.poisson(means, forests._uniforms(np.arange(6000), 5))
    for mean in (1, 7, 50_000):
        own = drawn[means == mean]
        assert own.mean() == pytest.approx(mean, rel=0.05) and own.var() == pytest.approx(mean, rel=0.1)
        assert abs(np.corrcoef(own[:, 0], own[:, 1])[0, 1]) < 0.1


def stock(spark, copies: int):
    rows = spark.range(400 * copies).select(
        (F.col("id") % 400).alias("k"), F.col("id").cast("string").alias("inventory_id")
    )
    return settle(
        rows.select(
            "inventory_id",
            ((F.col("k") % 20 < 6) & (F.col("k") % 3 != 0)).cast("bigint").alias("will_expire_30d"),
            (F.col("k") % 20).cast("double").alias("current_stock"),
            F.when(F.col("k") % 50 != 0, (F.col("k") % 7) / 7).alias("stock_pct"),
            F.concat(F.lit("T"), F.col("k") % 3).alias("category"),
        )
    )


def test_trees_are_trained_on_cells(spark, monkeypatch):
    rows, seen = stock(spark, 30), []
    monkeypatch.setattr(forests, "settle", lambda df: seen.append(made := settle(df)) or made)
    model, columns, metrics = inventory.train_writeoff_classifier(rows, id_columns=["inventory_id"], trees=5)
    assert rows.count() == 12_000 and seen[0].count() <= 20 * 8 * 3 * 2
    draws = seen[0].select(F.explode("draws").alias("n")).agg(F.sum("n")).first()[0]
    assert draws == pytest.approx(5 * 9600, rel=0.05)
    forest = model.stages[-1]
    assert forest.getNumTrees == 5 and forest.numClasses == 2 and len({t.toDebugString.split("\n", 1)[1] for t in forest.trees}) > 1
    assert metrics.first()["pr_auc"] > 0.8
    scored = inventory.risk_by_nodes(model, inventory.predict_writeoff_risk(model, rows, columns), columns)
    assert scored.where("abs(risk_score - node_score) > 1e-9 or node_score is null").isEmpty()
    # No function of arrays walks the nodes row by row.
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan and "CASE WHEN" in plan


def test_a_tree_without_a_positive_row_knows_both_classes(spark):
    rows = stock(spark, 1).withColumn("will_expire_30d", (F.col("inventory_id").cast("int") < 6).cast("bigint"))
    model, columns, _ = inventory.train_writeoff_classifier(settle(rows), id_columns=["inventory_id"], trees=12)
    assert {t.numClasses for t in model.stages[-1].trees} == {2}


def test_few_cuts_meet_the_rows_without_a_shuffle(spark):
    rows = stock(spark, 2)
    train, held = splits.stratified_split(rows, "will_expire_30d", 0.25, 1, ["inventory_id"])
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert held.count() == 200 and train.count() == 600
