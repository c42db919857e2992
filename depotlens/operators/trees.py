"""Fitted trees as a table of nodes, and scores that follow from the table alone."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from depotlens.session import scratch_folder


def node_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(tree, weight, node, feature, threshold, left, right, value) of the tree ensemble at the end of a pipeline.

    A row whose feature is at most the threshold goes left; a leaf has no children (-1). The value is the share
    of class 1 for a classifier and the prediction for a regression. A tree's nodes are numbered from its root, 0.
    """
    ensemble = model.stages[-1]
    path = scratch_folder(spark, "model")
    ensemble.write().save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    stats = F.col("nodeData.impurityStats")
    share = F.try_divide(F.get(stats, F.lit(1)), F.aggregate(stats, F.lit(0.0), lambda total, x: total + x))
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        (share if ensemble.hasParam("probabilityCol") else F.col("nodeData.prediction")).alias("value"),
    )
    return nodes.join(weights, "tree").select("tree", "weight", "node", "feature", "threshold", "left", "right", "value")


def with_features(model: PipelineModel, rows: DataFrame, name: str = "feature_values") -> DataFrame:
    """Rows with the numbers that the pipeline's last stage reads, as an array."""
    prepared = PipelineModel(model.stages[:-1]).transform(rows)
    return prepared.withColumn(name, vector_to_array(model.stages[-1].getFeaturesCol()))


def score_by_nodes(rows: DataFrame, nodes: DataFrame, features: str = "feature_values", mean: bool = False) -> DataFrame:
    """Rows with ``node_score``: the weighted sum (or mean) of the values of the leaves that a row falls into.

    The node table, which is bounded by trees x nodes of a tree whatever the rows, comes to the driver and becomes one
    nested case per tree: these are compiled, where a walk by functions of arrays would be interpreted for each row.
    """
    trees: dict[int, dict[int, Row]] = {}
    for row in nodes.collect():
        trees.setdefault(row["tree"], {})[row["node"]] = row

    def leaf(tree: dict[int, Row], at: int) -> str:
        node = tree[at]
        if node["left"] < 0:
            return _literal(node["value"])
        value = f"get(`{features}`, {node['feature']})"
        return f"CASE WHEN {value} <= {_literal(node['threshold'])} THEN {leaf(tree, node['left'])} ELSE {leaf(tree, node['right'])} END"

    total = F.lit(0.0)
    for _, tree in sorted(trees.items()):
        total = total + F.lit(float(tree[0]["weight"])) * F.expr(leaf(tree, 0))
    return rows.withColumn("node_score", total / len(trees) if mean else total)


def _literal(value: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if value is None else f"CAST('{value!r}' AS DOUBLE)"
