"""Models against what their published numbers give: node tables, group-wise weights, normal equations."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from depotlens.operators import groupwise, recommend, trees
from depotlens.session import settle


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_node_table_gives_the_model_score(spark, kind):
    draw = random.Random(2)
    rows = [(i, draw.random(), draw.randint(0, 9) * 1.0) for i in range(300)]
    table = spark.createDataFrame([(i, a, b, float(a * b > 2 or b == 3)) for i, a, b in rows], "id int, a double, b double, label double")
    if kind == "forest":
        last = RandomForestClassifier(numTrees=7, maxDepth=4, seed=3)
    else:
        last = GBTRegressor(maxIter=4, maxDepth=3, seed=3)
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), last]).fit(table)
    nodes = settle(trees.node_table(spark, model))
    assert nodes.where("node = 0").count() == (7 if kind == "forest" else 4)
    scored = trees.score_by_nodes(trees.with_features(model, table), nodes, mean=kind == "forest")
    got = {r["id"]: r["node_score"] for r in scored.collect()}
    for row in model.transform(table).collect():
        want = row["probability"][1] if kind == "forest" else row["prediction"]
        assert got[row["id"]] == pytest.approx(want, abs=1e-9)


def test_a_tree_of_one_leaf(spark):
    table = spark.createDataFrame([(1.0, 0.0), (2.0, 0.0)], "a double, label double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a"], outputCol="features"), GBTRegressor(maxIter=1)]).fit(table)
    scored = trees.score_by_nodes(trees.with_features(model, table), trees.node_table(spark, model))
    assert [r["node_score"] for r in scored.collect()] == [0.0, 0.0]


def labelled(spark, customers: range):
    """Items of a customer are good by their place among its own; a large level of the customer hides it."""
    draw = random.Random(customers.start)
    rows = []
    for c in customers:
        level = 100 * draw.random()
        for p in range(12):
            pull = draw.random()
            rows.append((c, p, level + pull, draw.random(), int(pull > 0.7)))
    return spark.createDataFrame(rows, "customer_id int, product_id int, pull double, noise double, label int")


def ndcg(spark, ranked, held) -> float:
    truth = held.where("label = 1")
    return recommend.evaluate_recommendations(ranked, truth, 5).first()["ndcg_at_k"]


def test_group_ranker_beats_the_point_wise_one_on_held_out_customers(spark):
    train, held = settle(labelled(spark, range(0, 60))), settle(labelled(spark, range(1000, 1040)))
    columns = ["pull", "noise"]
    weights = settle(groupwise.train_group_ranker(train, columns))
    by_groups = groupwise.rank_in_groups(weights, held, 5)
    pointwise = recommend.rank_candidates(recommend.train_ranker(train, columns, iterations=5), held, 5)
    found, plain = ndcg(spark, by_groups, held), ndcg(spark, pointwise, held)
    assert found > 0.95 and found > plain + 0.1
    table = {r["feature"]: r["weight"] for r in weights.collect()}
    assert table["pull"] > 10 * abs(table["noise"])
    for row in by_groups.collect():
        assert row["score"] == pytest.approx(sum(table[c] * row[c] for c in columns))


def test_pairs_are_within_groups_and_linear(spark):
    rows = [(1, p, float(p), int(p < 3)) for p in range(20)] + [(2, p, float(p), 1) for p in range(5)] + [(3, 1, 0.0, 1), (3, 2, 1.0, 0), (4, 1, 1.0, None)]
    table = spark.createDataFrame(rows, "customer_id int, product_id int, x double, label int")
    pairs = [(r[0], r.better[0], r.worse[0]) for r in groupwise.pairs_in_groups(table, ["x"]).collect()]
    assert len(pairs) == len(set(pairs)) == 17 + 1
    assert {p for p in pairs if p[0] == 3} == {(3, 0.0, 1.0)} and all(p[0] != 2 for p in pairs)
    assert all(b < 3 <= w for c, b, w in pairs if c == 1)
    assert {b for c, b, _ in pairs if c == 1} == {0.0, 1.0, 2.0} and len({w for c, _, w in pairs if c == 1}) == 17
    alone = table.where("customer_id = 2")
    assert [r.weight for r in groupwise.train_group_ranker(alone, ["x"]).collect()] == [0.0]


def test_normal_equations_and_loss_by_hand(spark):
    draw = np.random.default_rng(5)
    cells = {(u, i): float(draw.integers(1, 4)) for u in range(12) for i in range(8) if draw.random() < 0.4}
    weights = settle(spark.createDataFrame([(u, i, w) for (u, i), w in cells.items()], "customer_id int, product_id int, weight double"))
    model = recommend.als_implicit(weights, factors=3, iterations=4)
    x = {r.id: np.array(r.features, float) for r in model.userFactors.collect()}
    y = {r.id: np.array(r.features, float) for r in model.itemFactors.collect()}
    shared = sum(np.outer(v, v) for v in y.values())
    for row in recommend.als_residuals(model, weights).collect():
        mine = [(i, w) for (u, i), w in cells.items() if u == row.customer_id]
        left = shared + sum(w * np.outer(y[i], y[i]) for i, w in mine) + 0.01 * len(mine) * np.eye(3)
        right = sum((1 + w) * y[i] for i, w in mine)
        gap = np.linalg.norm(left @ x[row.customer_id] - right) / np.linalg.norm(right)
        assert row.n_items == len(mine) and row.residual == pytest.approx(gap, abs=1e-9) and gap < 1e-3
    loss = sum((1 + cells.get((u, i), 0)) * (((u, i) in cells) - x[u] @ y[i]) ** 2 for u in x for i in y)
    for side, place in ((x, 0), (y, 1)):
        loss += sum(0.01 * sum(k[place] == n for k in cells) * (v @ v) for n, v in side.items())
    found = recommend.als_objective(model, weights).first()
    assert found.objective == pytest.approx(loss, rel=1e-6) and math.isclose(found.at_zero, sum(1 + w for w in cells.values()))


def test_unsolved_factors_have_a_residual(spark):
    class Shifted:
        def __init__(self, model):
            self.rank, self.itemFactors = model.rank, model.itemFactors
            self.userFactors = model.userFactors.withColumn("features", F.transform("features", lambda v: v + F.lit(0.5).cast("float")))

    weights = settle(spark.createDataFrame([(u, i, 1.0) for u in range(4) for i in range(u + 1)], "customer_id int, product_id int, weight double"))
    model = recommend.als_implicit(weights, factors=2, iterations=3)
    assert recommend.als_residuals(Shifted(model), weights).agg(F.min("residual")).first()[0] > 1e-2
