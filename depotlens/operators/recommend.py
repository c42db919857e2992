"""Recommendation: training base, weights, factor models, negatives, ranker and offline metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.functions.columns import (
    first_true,
    hash_number,
    resolve_column,
    sum_exact,
    to_number,
)
from depotlens.operators.factor_fit import ALS, FactorModel, Side, block_count, cells, gram_of, loss_of, packed_factors, residuals_of
from depotlens.operators.factors import top_inner_products
from depotlens.operators.neighbours import feature_vector, item_knn_cosine, standardize
from depotlens.operators.ordering import (
    dense_codes,
    factorize_many,
    last_per_group,
    nth_missing,
    spread,
    topk_per_group,
    with_position,
)
from depotlens.session import discard, settle

# Weights of customer actions and evaluation protocol.
ACTION_WEIGHTS = {"purchased": 1.0, "added": 0.5, "viewed": 0.2, "searched": 0.1}
OTHER_ACTION_WEIGHT = 0.1
EVALUATION_K = 10
EVALUATION_USERS = 500
NEGATIVES_PER_POSITIVE = 2
NEIGHBOURS = 10

# Product attributes used as features.
PRODUCT_CATEGORIES = ("category", "therapeutic_category", "price_tier", "regulatory_class")
PRODUCT_NUMBERS = ("unit_price", "margin_percentage", "is_prescription")


# --- interactions ------------------------------------------------------------------------


def action_filter(interactions: DataFrame, action: str = "purchased") -> DataFrame:
    if "action_type" not in interactions.columns:
        return interactions
    return interactions.filter(F.col("action_type") == action)


def distinct_pairs(df: DataFrame) -> DataFrame:
    """Distinct customer-product pairs, as text ids."""
    return df.select(
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("product_id").cast("string").alias("product_id"),
    ).distinct()


def purchases_truth(validation: DataFrame) -> DataFrame:
    return distinct_pairs(action_filter(validation))


def training_base(interactions: DataFrame) -> DataFrame:
    """Per customer and product: bought or not, last moment, number of interactions."""
    moment = resolve_column(interactions, "interaction_timestamp", "timestamp")
    bought = F.when(F.col("action_type") == "purchased", 1).otherwise(0).cast("bigint")
    return interactions.groupBy("customer_id", "product_id").agg(
        F.max(bought).alias("label"),
        F.max(moment).alias("last_interaction_timestamp"),
        F.count(F.lit(1)).alias("interaction_count"),
    )


def action_weight(df: DataFrame) -> Column:
    if "action_type" not in df.columns:
        return F.lit(1.0)
    return first_true(
        [(F.col("action_type") == action, weight) for action, weight in ACTION_WEIGHTS.items()],
        OTHER_ACTION_WEIGHT,
    )


def interaction_weights(interactions: DataFrame, weight_column: str | None = None) -> DataFrame:
    """Sum of weights per (customer, product): the filled cells of the user-item matrix."""
    # Action weights have one decimal, so their sum is rounded to be free of row order.
    total = F.sum(weight_column) if weight_column else sum_exact(action_weight(interactions), 1)
    return interactions.groupBy("customer_id", "product_id").agg(total.alias("weight"))


def user_item_counts(weights: DataFrame) -> DataFrame:
    return weights.agg(
        F.countDistinct("customer_id").alias("n_users"),
        F.countDistinct("product_id").alias("n_items"),
        F.count(F.lit(1)).alias("n_nonzero"),
    )


def id_codes(df: DataFrame, column: str) -> DataFrame:
    """(id, code): whole-number codes of ids in id order."""
    return dense_codes(df, column)


def cap_users(truth: DataFrame, n: int) -> DataFrame:
    """Rows of the first n customers: a bounded evaluation sample, all other rows are dropped."""
    users = truth.select("customer_id").distinct().orderBy("customer_id").limit(n)
    return truth.join(users, "customer_id", "left_semi")


# --- content features --------------------------------------------------------------------


def product_features_matrix(products: DataFrame) -> DataFrame:
    """product_id, coded categories (``<name>_enc``) and numbers, missing values as 0."""
    out = factorize_many(products, {c: f"{c}_enc" for c in PRODUCT_CATEGORIES if c in products.columns})
    numbers = [c for c in PRODUCT_NUMBERS if c in products.columns]
    kinds = dict(products.dtypes)
    cleaned = {
        c: F.col(c).cast("int").cast("double") if kinds[c] == "boolean" else to_number(c) for c in numbers
    }
    codes = {c: F.col(c).cast("double") for c in matrix_columns(products) if c.endswith("_enc")}
    return out.select(
        "product_id", *[F.coalesce(v, F.lit(0.0)).alias(c) for c, v in {**codes, **cleaned}.items()]
    )


def matrix_columns(products: DataFrame) -> list[str]:
    coded = [f"{c}_enc" for c in PRODUCT_CATEGORIES if c in products.columns]
    return coded + [c for c in PRODUCT_NUMBERS if c in products.columns]


def item_similarity(products: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """Nearest products by standardised content features."""
    columns = matrix_columns(products)
    scaled = standardize(product_features_matrix(products), *columns)
    return item_knn_cosine(scaled.select("product_id", feature_vector(columns).alias("features")), k=k)


def last_item_per_user(interactions: DataFrame) -> DataFrame:
    """Last product of each customer; equal moments go to the higher product id."""
    moment = resolve_column(interactions, "interaction_timestamp", "timestamp")
    return last_per_group(
        interactions, "customer_id", "product_id", moment, "product_id", name="anchor_product_id"
    )


def anchor_recommendations(train: DataFrame, truth: DataFrame, neighbours: DataFrame) -> DataFrame:
    """Neighbours of the last training product, for customers that occur in the truth."""
    anchors = last_item_per_user(train).withColumn("customer_id", F.col("customer_id").cast("string"))
    judged = anchors.join(truth.select("customer_id").distinct(), "customer_id", "left_semi")
    lists = neighbours.select(
        F.col("product_id").alias("anchor_product_id"),
        F.col("similar_product_id").cast("string").alias("product_id"),
        "rank",
    )
    return judged.join(lists, "anchor_product_id").select("customer_id", "product_id", "rank")


# --- factor model ------------------------------------------------------------------------


def als_implicit(
    weights: DataFrame,
    factors: int = 64,
    iterations: int = 15,
    regularization: float = 0.01,
    seed: int = 42,
    blocks: int | None = None,
) -> FactorModel:
    """Implicit-feedback factors of summed weights with whole-number ids.

    Unless given, there are as many blocks as the session runs tasks at once, 10 at least, and more only where blocks
    would grow too large: in every half of a round a factor is sent to each block that holds one of its pairs.
    """
    blocks = blocks or max(10, weights.sparkSession.sparkContext.defaultParallelism)
    als = ALS(
        rank=factors,
        maxIter=iterations,
        regParam=regularization,
        seed=seed,
        userCol="customer_id",
        itemCol="product_id",
        ratingCol="weight",
        numUserBlocks=blocks,
        numItemBlocks=blocks,
    )
    return als.fit(weights)


def _inner(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda t, x: t + x)


def _known_cells(weights: DataFrame) -> DataFrame:
    """(own, other, weight) of the filled cells whose ids a model can know."""
    ids = [F.col(c).try_cast("int") == F.col(c) for c in ("customer_id", "product_id")]
    return cells(weights.where((F.col("weight").cast("double") > 0) & ids[0] & ids[1]), "customer_id", "product_id", "weight", "double")


def _met(model: FactorModel, weights: DataFrame, found, schema: str) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """What ``found``, made from the items' sum of outer products, gives for every block of users; both sides' sums."""
    ratings = _known_cells(weights)
    blocks = block_count(ratings, max(10, weights.sparkSession.sparkContext.defaultParallelism))
    side = Side(ratings, blocks)
    users, items = (packed_factors(f, model.rank, blocks) for f in (model.userFactors, model.itemFactors))
    sums = gram_of(items, model.rank), gram_of(users, model.rank)
    made = side.visit(items, model.rank, found(sums[0]), schema, own=users)
    discard(side.packed, users, items)
    return made, *sums


def als_residuals(model: FactorModel, weights: DataFrame, regularization: float = 0.01) -> DataFrame:
    """(customer_id, n_items, residual): how far a user's factors are from solving its normal equations.

    With item factors Y fixed and confidences 1 + c, the factors x of a user solve
    (Y'Y + sum c y y' + regularization n) x = sum (1 + c) y over its n items; the residual is the length of the
    difference of both sides by that of the right one. Y'Y is shared and summed once.
    """
    schema = "customer_id int, n_items bigint, residual double"
    found, _, _ = _met(model, weights, lambda items: residuals_of(items, regularization), schema)
    return found.withColumn("customer_id", F.col("customer_id").cast(weights.schema["customer_id"].dataType))


def als_objective(model: FactorModel, weights: DataFrame, regularization: float = 0.01) -> DataFrame:
    """(objective, at_zero): the loss that the factors minimise over all cells, filled or not, and that of zero factors.

    Cells without a weight cost the square of their score: together the sum of x' (Y'Y) x over all users.
    """
    parts, items, users = _met(model, weights, lambda _: loss_of(regularization), "objective double, at_zero double")
    every = float((items * users).sum())
    return parts.agg((F.sum("objective") + every).alias("objective"), F.sum("at_zero").alias("at_zero"))


def recommend_for_users(
    model: FactorModel, users: DataFrame, k: int = EVALUATION_K, seen: DataFrame | None = None
) -> DataFrame:
    """Top k items per user that the model knows, without items already seen if ``seen`` is given."""
    wanted = users.select(F.col("customer_id").alias("id")).distinct()
    return recommend_from_factors(model.userFactors.join(wanted, "id", "left_semi"), model.itemFactors, k, seen)


def recommend_from_factors(
    user_factors: DataFrame, item_factors: DataFrame, k: int = EVALUATION_K, seen: DataFrame | None = None
) -> DataFrame:
    """Top k items of every user by inner product of given factors (id, features); ties go to the lower item.

    A user with n seen items needs its k + n best to keep k, so lists are as long as each user's own
    history asks for.
    """
    asking = user_factors.select(
        F.col("id").cast("bigint").alias("user"), F.col("features").alias("vector"), F.lit(k).alias("wanted")
    )
    if seen is not None:
        pairs = seen.select(F.col("customer_id").alias("user"), F.col("product_id").alias("item")).distinct()
        counts = pairs.groupBy("user").agg(F.count(F.lit(1)).alias("n_seen"))
        asking = asking.join(counts, "user", "left").withColumn(
            "wanted", F.lit(k) + F.coalesce("n_seen", F.lit(0))
        )
    items = item_factors.select(
        F.col("id").cast("bigint").alias("item"), F.col("features").alias("item_vector")
    )
    scored = top_inner_products(asking, items)
    if seen is not None:
        scored = scored.join(pairs, ["user", "item"], "left_anti")
    best = topk_per_group(scored, "user", k, F.col("score").desc(), F.col("item"), rank="rank")
    return best.select(
        F.col("user").alias("customer_id"), F.col("item").alias("product_id"), "score", "rank"
    )


def mf_topk_all_items(model: FactorModel, users: DataFrame, k: int = EVALUATION_K) -> DataFrame:
    """Top k over all items for each known user, seen items included; unknown users get no rows."""
    return recommend_for_users(model, users, k)


def recommendation_arrays(recommendations: DataFrame) -> DataFrame:
    """One row per user: item ids and scores in rank order."""
    entry = F.struct("rank", "product_id", "score")
    return (
        recommendations.groupBy("customer_id")
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        .select(
            "customer_id",
            F.col("entries.product_id").alias("recommended_item_codes"),
            F.col("entries.score").alias("recommended_scores"),
        )
    )


# --- negatives and ranker ----------------------------------------------------------------


def not_purchased_counts(bought: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Per customer: number of catalogue products not bought."""
    size = catalogue.select("product_id").distinct().agg(F.count(F.lit(1)).alias("n"))
    known = bought.select("customer_id", "product_id").join(catalogue.select("product_id"), "product_id", "left_semi")
    # Pairs hardly repeat, so tasks in front of the shuffle would hold almost every pair to reduce little.
    counts = spread(known, "customer_id").groupBy("customer_id").agg(F.countDistinct("product_id").alias("n_bought"))
    return counts.select("customer_id", "n_bought", (size.scalar() - F.col("n_bought")).alias("n_free"))


def negative_samples(
    base: DataFrame, products: DataFrame, per_positive: int = NEGATIVES_PER_POSITIVE, seed: int = 42
) -> DataFrame:
    """Positive rows' customers with products they did not buy, ``per_positive`` for each bought one.

    A draw picks ranks among the free products without replacement, and the ranks are then resolved
    to products. No customer-by-product grid is built.
    """
    catalogue = settle(dense_codes(products, "product_id", "code"))
    positives = settle(
        base.filter(F.col("label") == 1)
        .select("customer_id", "product_id")
        .distinct()
        .join(catalogue, "product_id", "left")
    )
    bought = positives.filter(F.col("code").isNotNull()).select("customer_id", "code")
    counts = positives.groupBy("customer_id").agg(F.count("code").alias("n_bought"), F.count(F.lit(1)).alias("n_pairs"))
    sizes = counts.select("customer_id", (F.col("n_pairs") * (1 + per_positive)).alias("rows"))
    free = counts.select("customer_id", (F.lit(catalogue.count()) - F.col("n_bought")).alias("n_free"))
    free = free.filter(F.col("n_free") > 0)

    def draw(slot: Column) -> Column:
        number = hash_number(seed, "customer_id", "product_id", slot)
        # Rank among those not drawn yet, moved past every smaller rank drawn before.
        return F.pmod(number, F.col("n_free") - slot)

    def add(chosen: Column, slot: Column) -> Column:
        rank = F.aggregate(
            F.array_sort(chosen), draw(slot), lambda rank, other: F.when(rank >= other, rank + 1).otherwise(rank)
        )
        return F.when(slot < F.col("n_free"), F.concat(chosen, F.array(rank))).otherwise(chosen)

    slots = F.transform(F.sequence(F.lit(0), F.lit(per_positive - 1)), lambda i: i.cast("bigint"))
    ranks = F.aggregate(slots, F.array().cast("array<bigint>"), add)
    draws = (
        positives.join(free, "customer_id")
        .select(
            "customer_id",
            F.col("product_id").alias("positive_product_id"),
            F.posexplode(ranks).alias("slot", "free_rank"),
        )
    )
    placed = nth_missing(bought, draws, "customer_id", "code", "free_rank", "code", sizes=sizes)
    return placed.join(catalogue, "code").select(
        "customer_id",
        "product_id",
        F.lit(0).cast("bigint").alias("label"),
        "positive_product_id",
        F.col("slot").cast("bigint").alias("slot"),
    )


def with_negatives(
    base: DataFrame, products: DataFrame, per_positive: int = NEGATIVES_PER_POSITIVE, seed: int = 42
) -> DataFrame:
    """Training base with sampled negatives appended; their other columns are NULL."""
    negatives = negative_samples(base, products, per_positive, seed)
    return base.unionByName(
        negatives.select("customer_id", "product_id", "label"), allowMissingColumns=True
    )


KEYS = ("customer_id", "product_id")


def feature_names(pairs: DataFrame, label: str = "label") -> list[str]:
    """Columns of pairs that may serve as features: neither keys nor label, and no moments."""
    return [c for c, kind in pairs.dtypes if c not in (*KEYS, label) and not kind.startswith("timestamp")]


def _numeric_products(products: DataFrame) -> DataFrame:
    """product_id with every attribute as a number: text coded, the rest read as numbers."""
    kinds = dict(products.dtypes)
    features = [c for c in products.columns if c not in KEYS]
    words = [c for c in features if kinds[c] == "string"]
    out = factorize_many(products, {c: f"_{c}_code" for c in words})

    def number(column: str) -> Column:
        if column in words:
            return F.col(f"_{column}_code")
        if kinds[column] == "boolean":
            return F.coalesce(F.col(column).cast("int"), F.lit(0))
        if kinds[column] in ("date", "timestamp", "timestamp_ntz"):
            return F.coalesce(F.unix_date(F.col(column).cast("date")), F.lit(0))
        return to_number(column)

    return out.select("product_id", *[number(c).alias(c) for c in features])


def ranker_features(pairs: DataFrame, products: DataFrame) -> tuple[DataFrame, list[str]]:
    """Pairs with the attributes of their product as numbers, and the names of the features.

    Text is coded over the product table, so that a product has the same code in every call. What
    ``like_pairs`` adds is no feature.
    """
    numeric = _numeric_products(products)
    merged = pairs.join(numeric, "product_id", "left")
    own = [c for c in feature_names(pairs) if c not in (LIKE, PAIRS)]
    columns = list(dict.fromkeys([*own, *(c for c in numeric.columns if c not in KEYS)]))
    return merged.withColumns({c: to_number(c) for c in columns}), columns


#: Columns of ``like_pairs``: what the pairs of a row share, and their number.
LIKE, PAIRS = "_like", "_pairs"


def _shared(pairs: DataFrame) -> Column:
    return F.struct("product_id", *feature_names(pairs)).alias(LIKE)


def like_pairs(pairs: DataFrame, *others: str) -> DataFrame:
    """Pairs that a ranker cannot tell apart, as one row: product, the pairs' own features, ``others`` and their number.

    All other features are the product's, so these rows, weighted by their number, train as the pairs do. Before the
    product's attributes are joined there are few columns to group by, and a hot product is reduced on the map side.
    """
    groups = pairs.select(_shared(pairs), *others).groupBy(LIKE, *others).agg(F.count(F.lit(1)).alias(PAIRS))
    return groups.select(F.col(f"{LIKE}.*"), LIKE, *others, PAIRS)


def of_each_pair(pairs: DataFrame, found: DataFrame, *columns: str) -> DataFrame:
    """Pairs with columns found for their row of ``like_pairs``; unknown features are equal to each other."""
    return pairs.select("*", _shared(pairs)).join(found.select(LIKE, *columns), LIKE).drop(LIKE)


def train_ranker(
    features: DataFrame,
    columns: Sequence[str],
    label: str = "label",
    iterations: int = 20,
    seed: int = 42,
) -> PipelineModel:
    """Pointwise boosted trees; the score orders the candidates of a customer. Rows of ``like_pairs`` count as their pairs."""
    weight = {"weightCol": PAIRS} if PAIRS in features.columns else {}
    stages = [
        VectorAssembler(inputCols=list(columns), outputCol="_features"),
        GBTRegressor(
            featuresCol="_features", labelCol=label, predictionCol="score", maxIter=iterations, seed=seed, **weight
        ),
    ]
    return Pipeline(stages=stages).fit(features)


def rank_candidates(
    model: PipelineModel, candidates: DataFrame, k: int = 50, group: str = "customer_id"
) -> DataFrame:
    """Score candidate rows and keep the k best of each group, or overall without a group column."""
    scored = model.transform(candidates).drop("_features")
    order = [F.col("score").desc(), F.col("product_id")]
    if group not in scored.columns:
        return scored.orderBy(*order).limit(k)
    return topk_per_group(scored, group, k, *order, rank="rank")


def rank_catalogue(
    model: PipelineModel,
    users: DataFrame,
    base: DataFrame,
    products: DataFrame,
    k: int = EVALUATION_K,
) -> DataFrame:
    """Top k of the whole catalogue for every user, without a user-by-product grid.

    A pair without history has product attributes only, so its score is the product's own: products
    are scored and ranked once, pairs with history that share their features are scored once, and each user
    takes the best of the pairs with history and of the first k products without.
    """
    wanted = users.select("customer_id").distinct()
    history = base.drop("label").join(wanted, "customer_id", "left_semi")
    pair_columns = feature_names(history)
    rows, _ = ranker_features(like_pairs(history), products)
    known = of_each_pair(history, model.transform(rows), "score").select("customer_id", "product_id", "score")
    known = settle(known)
    blank = products.select("product_id").distinct()
    blank = blank.select("product_id", *[F.lit(0).alias(c) for c in pair_columns])
    alone, _ = ranker_features(blank, products)
    alone = model.transform(alone).select("product_id", "score")
    ranked = with_position(alone, F.col("score").desc(), F.col("product_id"), name="place")
    taken = known.join(ranked.select("product_id", "place"), "product_id").select("customer_id", "place")
    asks = wanted.select("customer_id", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("free_rank"))
    unseen = (
        nth_missing(taken, asks, "customer_id", "place", "free_rank", "place")
        .join(ranked, "place")
        .select("customer_id", "product_id", "score")
    )
    return topk_per_group(
        known.unionByName(unseen), "customer_id", k, F.col("score").desc(), F.col("product_id"), rank="rank"
    )


# --- offline metrics ---------------------------------------------------------------------


def ranking_metrics_per_user(
    predictions: DataFrame, truth: DataFrame, k: int = EVALUATION_K
) -> DataFrame:
    """Precision, recall and NDCG at k of every user with both predictions and truth.

    ``predictions`` has customer_id, product_id, rank (from 1). A repeated item counts once for
    precision and recall and at every place for DCG.
    """
    relevant = truth.select(
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("product_id").cast("string").alias("product_id"),
    ).distinct()
    shown = predictions.select(
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("product_id").cast("string").alias("product_id"),
        "rank",
    ).filter(F.col("rank") <= k)
    hits = (
        shown.join(relevant, ["customer_id", "product_id"], "left_semi")
        .groupBy("customer_id")
        .agg(
            F.countDistinct("product_id").cast("double").alias("_hits"),
            F.sum(1.0 / F.log2(F.col("rank") + 1)).alias("_dcg"),
        )
    )
    sizes = relevant.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_relevant"))
    judged = sizes.join(shown.select("customer_id").distinct(), "customer_id", "left_semi")
    ideal = F.aggregate(
        F.sequence(F.lit(1).cast("bigint"), F.least(F.col("_relevant"), F.lit(k).cast("bigint"))),
        F.lit(0.0),
        lambda total, place: total + 1.0 / F.log2(place + 1),
    )
    hit = F.coalesce("_hits", F.lit(0.0))
    return judged.join(hits, "customer_id", "left").select(
        "customer_id",
        (hit / F.lit(float(k))).alias("precision_at_k"),
        F.try_divide(hit, F.col("_relevant").cast("double")).alias("recall_at_k"),
        (F.coalesce("_dcg", F.lit(0.0)) / ideal).alias("ndcg_at_k"),
    )


def evaluate_recommendations(predictions: DataFrame, truth: DataFrame, k: int = EVALUATION_K) -> DataFrame:
    """One row: mean precision, recall and NDCG at k; zeros when no user has both sides."""
    return ranking_metrics_per_user(predictions, truth, k).agg(
        *[
            F.coalesce(F.avg(c), F.lit(0.0)).alias(c)
            for c in ("precision_at_k", "recall_at_k", "ndcg_at_k")
        ]
    )


def offline_metrics(metrics: DataFrame) -> DataFrame:
    """Shared metric names of all models; a missing metric is 0."""
    return metrics.select(
        *[
            (F.coalesce(F.col(c), F.lit(0.0)) if c in metrics.columns else F.lit(0.0)).alias(f"val_{c}")
            for c in ("precision_at_k", "recall_at_k", "ndcg_at_k")
        ]
    )


def protocol_parameters(
    train: DataFrame, validation: DataFrame, fraction: float = 0.2, k: int = EVALUATION_K
) -> DataFrame:
    """The evaluation protocol as one row, with the number of events on both sides."""
    counted = train.select(F.lit(1).alias("t"), F.lit(0).alias("v")).unionByName(
        validation.select(F.lit(0).alias("t"), F.lit(1).alias("v"))
    )
    return counted.agg(F.sum("t").alias("reco_n_train_events"), F.sum("v").alias("reco_n_val_events")).select(
        F.lit("temporal_split_interactions").alias("reco_eval_protocol"),
        F.lit(float(fraction)).alias("reco_val_fraction"),
        F.lit(k).cast("bigint").alias("reco_eval_k"),
        "reco_n_train_events",
        "reco_n_val_events",
    )


def compare_models(results: Mapping[str, DataFrame]) -> DataFrame:
    """(model, metric, value) of one-row metric tables."""
    parts = []
    for model, metrics in results.items():
        entries = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in metrics.columns]
        parts.append(
            metrics.select(F.explode(F.array(*entries)).alias("e")).select(
                F.lit(model).alias("model"), "e.metric", "e.value"
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
