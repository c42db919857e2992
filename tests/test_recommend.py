from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from depotlens.operators import factors, recommend
from depotlens.plans import recommendation as flows


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        (f"i{c}-{p}-{n}", c, p, "purchased" if (c + p) % 3 else "viewed", n)
        for c in range(30)
        for n, p in enumerate(sorted({(c * 7 + j * 3) % 25 for j in range(1 + c % 8)}))
    ]
    df = spark.createDataFrame(rows, "interaction_id string, customer_id bigint, product_id bigint, action_type string, n int")
    return df.select(
        "interaction_id",
        "customer_id",
        "product_id",
        "action_type",
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, n, cast(customer_id as int))").alias(
            "interaction_timestamp"
        ),
    )


@pytest.fixture(scope="module")
def products(spark):
    return spark.range(25).select(
        F.col("id").alias("product_id"),
        F.concat(F.lit("c"), F.col("id") % 4).alias("category"),
        F.concat(F.lit("t"), F.col("id") % 3).alias("therapeutic_category"),
        F.lit("Low Value").alias("price_tier"),
        F.when(F.col("id") % 2 == 0, "OTC").otherwise("Rx").alias("regulatory_class"),
        (F.col("id") * 1.5 + 3).alias("unit_price"),
        (F.col("id") % 7 * 1.0).alias("margin_percentage"),
        (F.col("id") % 2 == 1).alias("is_prescription"),
    )


def test_ranking_metrics_known_values(spark):
    predictions = spark.createDataFrame(
        [("u1", "miss", 1), ("u1", "hit", 2), ("u1", "other", 3)], "customer_id string, product_id string, rank int"
    )
    truth = spark.createDataFrame([("u1", "hit"), ("u2", "x")], "customer_id string, product_id string")
    row = recommend.evaluate_recommendations(predictions, truth, 3).first()
    assert row.precision_at_k == pytest.approx(1 / 3) and row.recall_at_k == 1.0
    assert row.ndcg_at_k == pytest.approx(1 / math.log2(3))


def test_repeated_item_counts_once_for_precision_and_each_time_for_dcg(spark):
    predictions = spark.createDataFrame(
        [("u", "a", 1), ("u", "a", 2)], "customer_id string, product_id string, rank int"
    )
    truth = spark.createDataFrame([("u", "a")], "customer_id string, product_id string")
    row = recommend.evaluate_recommendations(predictions, truth, 2).first()
    assert (row.precision_at_k, row.recall_at_k) == (0.5, 1.0)
    assert row.ndcg_at_k == pytest.approx(1 + 1 / math.log2(3))


def test_no_common_user_gives_zeros(spark):
    predictions = spark.createDataFrame([("u", "a", 1)], "customer_id string, product_id string, rank int")
    truth = spark.createDataFrame([("v", "a")], "customer_id string, product_id string")
    assert tuple(recommend.evaluate_recommendations(predictions, truth).first()) == (0.0, 0.0, 0.0)


def test_missing_metric_is_zero(spark):
    df = spark.createDataFrame([(0.5,)], "precision_at_k double")
    assert tuple(recommend.offline_metrics(df).first()) == (0.5, 0.0, 0.0)


def test_weights_of_actions(spark):
    df = spark.createDataFrame(
        [(1, 1, a) for a in ("purchased", "added", "viewed", "searched", "other", "purchased")],
        "customer_id int, product_id int, action_type string",
    )
    assert recommend.interaction_weights(df).first().weight == 2.9
    assert recommend.interaction_weights(df.drop("action_type")).first().weight == 6.0


def test_training_base_reads_either_time_column(spark, events):
    late = events.withColumnRenamed("interaction_timestamp", "timestamp")
    assert recommend.training_base(late).count() == recommend.training_base(events).count()


def test_seen_items_are_left_out_also_for_heavy_customers(spark, events):
    heavy = spark.range(24).select(
        F.concat(F.lit("h"), "id").alias("interaction_id"),
        F.lit(99).cast("bigint").alias("customer_id"),
        F.col("id").alias("product_id"),
        F.lit("purchased").alias("action_type"),
        F.expr("timestamp_ntz'2024-02-01 00:00:00'").alias("interaction_timestamp"),
    )
    rows = events.unionByName(heavy)
    found = flows.factor_recommendations(rows, 5, factors=4, iterations=2)
    assert found.join(rows, ["customer_id", "product_id"]).count() == 0
    counts = dict(found.groupBy("customer_id").count().collect())
    assert counts[99] == 1 and all(n == 5 for c, n in counts.items() if c != 99)


def test_text_ids_are_coded_and_decoded(spark, events):
    named = events.withColumns(
        {c: F.concat(F.lit(c[0].upper()), F.lpad(F.col(c).cast("string"), 3, "0")) for c in ("customer_id", "product_id")}
    )
    found = flows.factor_recommendations(named, 5, factors=4, iterations=2, filter_seen=False)
    row = found.orderBy("customer_id", "rank").first()
    assert row.customer_id == "C000" and row.product_id.startswith("P") and row["rank"] == 1
    arrays = recommend.recommendation_arrays(found).orderBy("customer_id").first()
    assert len(arrays.recommended_item_codes) == 5 == len(arrays.recommended_scores)


def test_rank_catalogue_equals_scoring_every_pair(spark, events, products):
    base = recommend.training_base(events)
    rows, columns = recommend.ranker_features(recommend.with_negatives(base, products), products)
    model = recommend.train_ranker(rows, columns, iterations=3)
    got = recommend.rank_catalogue(model, base, base, products, k=6)
    grid = base.select("customer_id").distinct().crossJoin(products.select("product_id"))  # small fixture
    pairs = grid.join(base.drop("label"), ["customer_id", "product_id"], "left").fillna(0, ["interaction_count"])
    scored, _ = recommend.ranker_features(pairs, products)
    want = recommend.rank_candidates(model, scored, 6)
    columns = ["customer_id", "product_id", "rank"]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))


def test_rank_candidates_without_groups_takes_the_best_overall(spark, events, products):
    base = recommend.training_base(events)
    rows, columns = recommend.ranker_features(base, products)
    model = recommend.train_ranker(rows, columns, iterations=2)
    assert recommend.rank_candidates(model, rows.drop("customer_id"), 7).count() == 7


def test_all_models_are_judged_by_the_same_metrics(spark, events, products):
    got = flows.compare_recommenders(events, products, 3)
    assert {(r.model, r.metric) for r in got.collect()} == {
        (m, f"val_{n}_at_k") for m in ("item_similarity", "als", "ranker") for n in ("precision", "recall", "ndcg")
    }
    assert got.filter((F.col("value") < 0) | (F.col("value") > 1)).count() == 0


@pytest.mark.parametrize("per_block", [3, 8, 1000])
def test_top_inner_products_equal_brute_force(spark, per_block):
    chance = np.random.default_rng(2)
    lengths = np.r_[np.full(10, 5.0), chance.uniform(0.01, 1, 30)]
    items = {i: (chance.normal(size=3) * lengths[i]).astype("float32") for i in range(40)}
    items[39] = items[38]
    users = {u: (chance.normal(size=3).astype("float32"), w) for u, w in enumerate([1, 2, 5, 17, 40, 64] * 3)}
    got = factors.top_inner_products(
        spark.createDataFrame([(u, v.tolist(), w) for u, (v, w) in users.items()], "user bigint, vector array<float>, wanted int"),
        spark.createDataFrame([(i, v.tolist()) for i, v in items.items()], "item bigint, item_vector array<float>"),
        items_per_block=per_block,
    ).collect()
    for user, (vector, wanted) in users.items():
        score = {i: float(v.astype(float) @ vector.astype(float)) for i, v in items.items()}
        best = sorted(score, key=lambda i: (-round(score[i], 9), i))[:wanted]
        found = {r.item: r.score for r in got if r.user == user}
        assert len([r for r in got if r.user == user]) == len(found)
        assert sorted(found, key=lambda i: (-round(found[i], 9), i))[:wanted] == best


def test_factors_equal_scoring_every_pair(spark, events):
    weights = recommend.interaction_weights(events)
    model = recommend.als_implicit(weights, factors=4, iterations=2)
    got = recommend.mf_topk_all_items(model, weights, 3)
    user = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    item = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    for row in got.collect():
        ranked = sorted((float(user[row.customer_id] @ v) for v in item.values()), reverse=True)
        assert row.score == pytest.approx(ranked[row["rank"] - 1])


def test_factor_model_takes_any_whole_number_id(spark, events):
    """Ids beyond 32 bits are coded for the model and come back as they were."""
    far = events.withColumn("customer_id", F.col("customer_id") + (1 << 32))
    found = flows.factor_recommendations(far, k=2, factors=4, iterations=2).select("customer_id").distinct().collect()
    assert found and all(r.customer_id >= 1 << 32 for r in found)
