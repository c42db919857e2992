"""Pairs that the ranker cannot tell apart train and are scored once, and count as often as they occur."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from depotlens.operators import recommend
from depotlens.plans import recommendation as flows
from depotlens.session import settle


@pytest.fixture(scope="module")
def products(spark):
    # Product 3 comes twice.
    rows = [(p % 12, f"c{p % 3}", 1.5 * (p % 12)) for p in range(12)] + [(3, "c0", 9.0)]
    return settle(spark.createDataFrame(rows, "product_id bigint, category string, unit_price double"))


@pytest.fixture(scope="module")
def base(spark):
    rows = [(c, p, int((c + p) % 4 > 0), None if p == 5 else 1 + c % 2) for c in range(60) for p in range(12) if (c * p) % 5 < 2]
    return settle(spark.createDataFrame(rows, "customer_id bigint, product_id bigint, label bigint, interaction_count bigint"))


def scores(df):
    return sorted((r.customer_id, r.product_id, round(r.score, 9)) for r in df.collect())


def test_weighted_rows_train_and_score_as_the_pairs(base, products):
    rows, columns = recommend.ranker_features(base, products)
    each = recommend.train_ranker(rows, columns, iterations=3)
    groups = recommend.like_pairs(base, "label")
    weighted, names = recommend.ranker_features(groups, products)
    assert names == columns and groups.agg(F.sum(recommend.PAIRS)).first()[0] == base.count() > 3 * groups.count()
    model = recommend.train_ranker(weighted, names, iterations=3)
    alike = model.transform(recommend.ranker_features(recommend.like_pairs(base), products)[0])
    assert scores(recommend.of_each_pair(base, alike, "score")) == scores(each.transform(rows))


def test_the_flow_trains_on_distinct_rows(base, products, monkeypatch):
    seen = []
    train = recommend.train_ranker
    monkeypatch.setattr(recommend, "train_ranker", lambda rows, *a, **b: (seen.append(rows), train(rows, *a, **b))[1])
    flows.ranker_recommendations(base, products, 3, iterations=2)
    pairs, rows = (df.where("product_id <> 3") for df in (recommend.with_negatives(base, products), seen[0]))
    assert rows.agg(F.sum(recommend.PAIRS)).first()[0] == pairs.count()
    assert rows.count() == pairs.select("product_id", "interaction_count", "label").distinct().count()
