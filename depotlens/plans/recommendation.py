"""Recommendation flows: train on the earlier events, recommend, judge on the later ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.operators import recommend
from depotlens.operators.splits import VALIDATION_FRACTION, temporal_split
from depotlens.session import settle

EVENT_COLUMNS = ("interaction_id", "customer_id", "product_id", "action_type", "interaction_timestamp")


def split_events(
    interactions: DataFrame, fraction: float = VALIDATION_FRACTION
) -> tuple[DataFrame, DataFrame]:
    """Temporal split of interactions that are first written out, since the cut reads them repeatedly."""
    events = settle(interactions.select(*EVENT_COLUMNS))
    return temporal_split(events, fraction, tie_columns=["interaction_id"])


def _within_int(df: DataFrame, *columns: str) -> list[str]:
    """Whole-number columns whose values all fit into 32 bits, as the factor model needs."""
    kinds = dict(df.dtypes)
    whole = [c for c in columns if kinds[c] in ("int", "bigint", "smallint", "tinyint")]
    if not whole:
        return []
    bounds = df.agg(*[f(c).cast("bigint").alias(f"{name}_{c}") for c in whole for name, f in (("a", F.min), ("b", F.max))]).first()
    return [c for c in whole if (bounds[f"a_{c}"] or 0) >= -(1 << 31) and (bounds[f"b_{c}"] or 0) < 1 << 31]


def coded(weights: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Weights with whole-number ids, and the code table of every column that had to be coded."""
    tables = {}
    ready = _within_int(weights, "customer_id", "product_id")
    for column in ("customer_id", "product_id"):
        if column not in ready:
            tables[column] = recommend.id_codes(weights, column)
            weights = (
                weights.join(tables[column], column).drop(column).withColumnRenamed(f"{column}_code", column)
            )
    return weights, tables


def decoded(recommendations: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    for column, codes in tables.items():
        names = codes.withColumnsRenamed({column: "_name", f"{column}_code": column})
        recommendations = (
            recommendations.join(names, column).drop(column).withColumnRenamed("_name", column)
        )
    return recommendations


def factor_recommendations(
    interactions: DataFrame,
    k: int = recommend.EVALUATION_K,
    factors: int = 32,
    iterations: int = 10,
    filter_seen: bool = True,
) -> DataFrame:
    """Top k items of every customer by implicit factors, without those already interacted with."""
    weights, tables = coded(settle(recommend.interaction_weights(interactions)))
    if tables:
        weights = settle(weights)
    model = recommend.als_implicit(weights, factors, iterations)
    if filter_seen:
        found = recommend.recommend_for_users(model, weights, k, seen=weights)
    else:
        found = recommend.mf_topk_all_items(model, weights, k)
    return decoded(found, tables)


def ranker_recommendations(
    base: DataFrame, products: DataFrame, k: int = recommend.EVALUATION_K, iterations: int = 20
) -> DataFrame:
    """Top k of the catalogue for every customer with a purchase, by boosted trees."""
    base, products = settle(base), settle(products)
    # Negatives of a product differ in nothing that the ranker sees.
    pairs = recommend.like_pairs(recommend.with_negatives(base, products), "label")
    rows, columns = recommend.ranker_features(pairs, products)
    model = recommend.train_ranker(settle(rows), columns, iterations=iterations)
    return recommend.rank_catalogue(model, base.filter(F.col("label") == 1), base, products, k)


def compare_recommenders(
    interactions: DataFrame, products: DataFrame, k: int = recommend.EVALUATION_K, ranker_iterations: int = 20
) -> DataFrame:
    """(model, metric, value) of item similarity, factors and ranker under one split."""
    train, later = split_events(interactions)
    truth = settle(recommend.purchases_truth(later))
    neighbours = recommend.item_similarity(products, k)
    lists = {
        "item_similarity": recommend.anchor_recommendations(train, truth, neighbours),
        "als": factor_recommendations(train, k),
        "ranker": ranker_recommendations(recommend.training_base(train), products, k, ranker_iterations),
    }
    return recommend.compare_models(
        {
            name: recommend.offline_metrics(recommend.evaluate_recommendations(found, truth, k))
            for name, found in lists.items()
        }
    )
