"""A ranker that learns from pairs inside a group, with its weights as a table.

Only differences between a better and a worse row of the same customer count, so what all rows of a customer share
cannot mislead it. Pairs grow with the rows and not with their square: every row meets rows of the other kind at
its own place in a hash order, in parts of a group that are bounded.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotlens.functions.columns import hash_number
from depotlens.operators.neighbours import feature_vector
from depotlens.operators.ordering import topk_per_group
from depotlens.session import settle

#: Rows of a part of a group, on average.
PART_ROWS = 65_536


def pairs_in_groups(
    features: DataFrame,
    columns: Sequence[str],
    label: str = "label",
    group: str = "customer_id",
    item: str = "product_id",
    seed: int = 42,
) -> DataFrame:
    """(group, better, worse): vectors of a row with label 1 and one with label 0 of the same group.

    No pair repeats, and every row is in one whose group, or part of a group beyond PART_ROWS rows, has both labels.
    """
    rows = features.select(
        group, (F.col(label) == 1).alias("good"), feature_vector(columns).alias("vector"), hash_number(seed, group, item).alias("order")
    ).where("good is not null")
    sizes = rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).alias("parts"))
    dealt = rows.join(sizes, group).withColumn("part", F.pmod("order", F.col("parts")))
    keys = [group, "part"]
    counts = dealt.groupBy(*keys).agg(F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_bad"))
    place = F.row_number().over(Window.partitionBy(*keys, "good").orderBy("order", F.col("vector"))) - 1
    placed = dealt.withColumn("place", place).join(counts.where("n_good > 0 and n_bad > 0"), keys)
    # As many meetings as the more frequent kind has rows; the others take turns.
    meetings = F.greatest("n_good", "n_bad")
    own = F.when(F.col("good"), F.col("n_good")).otherwise(F.col("n_bad"))
    turns = F.sequence(F.col("place").cast("bigint"), meetings - 1, own)
    met = placed.select(*keys, "good", "vector", F.explode(turns).alias("meeting"))
    better = met.where("good").select(*keys, "meeting", F.col("vector").alias("better"))
    worse = met.where("not good").select(*keys, "meeting", F.col("vector").alias("worse"))
    return better.join(worse, [*keys, "meeting"]).select(group, "better", "worse")


def train_group_ranker(
    features: DataFrame,
    columns: Sequence[str],
    label: str = "label",
    group: str = "customer_id",
    item: str = "product_id",
    iterations: int = 50,
    regularization: float = 1e-4,
    seed: int = 42,
) -> DataFrame:
    """(feature, weight) that minimise the logistic loss of score differences within groups.

    Spark sums gradients over tasks in a tree. Without any pair all weights are 0.
    """
    spark = features.sparkSession
    pairs = settle(pairs_in_groups(features, columns, label, group, item, seed))
    weights = [0.0] * len(columns)
    if not pairs.isEmpty():
        apart = F.zip_with("better", "worse", lambda a, b: a - b)
        ahead = pairs.select(apart.alias("d"), F.lit(1.0).alias("label"))
        # Each pair also the other way round, so that both classes are there and no intercept is needed.
        behind = ahead.select(F.transform("d", lambda x: -x).alias("d"), F.lit(0.0).alias("label"))
        rows = ahead.unionByName(behind).select(array_to_vector("d").alias("features"), "label")
        fitted = LogisticRegression(maxIter=iterations, regParam=regularization, fitIntercept=False).fit(rows)
        weights = [float(w) for w in fitted.coefficients]
    return spark.createDataFrame(list(zip(columns, weights)), "feature string, weight double")


def weighted_score(weights: Mapping[str, float]) -> Column:
    """Sum of weight x feature, in the order of the mapping; unknown features count as 0."""
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * F.lit(weight)
    return total


def rank_in_groups(
    weights: DataFrame, candidates: DataFrame, k: int, group: str = "customer_id", item: str = "product_id"
) -> DataFrame:
    """The k best candidates of each group by published weights (one row a feature); ties go by the lower item."""
    table = {r["feature"]: r["weight"] for r in weights.collect()}
    scored = candidates.withColumn("score", weighted_score(table))
    return topk_per_group(scored, group, k, F.col("score").desc(), F.col(item), rank="rank")
