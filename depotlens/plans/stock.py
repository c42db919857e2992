"""Inventory flows: replenishment and write-off risk from stock and demand tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from depotlens.operators import inventory
from depotlens.session import settle


def replenishment(
    stock: DataFrame, orders: DataFrame, as_of: str, **options: float
) -> tuple[DataFrame, DataFrame]:
    """Recommendations per stock row and their one-row summary."""
    rows = inventory.replenishment_recommendations(stock, orders, as_of, **options)
    return rows, inventory.replenishment_summary(rows)


def writeoff_risk(
    stock: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    as_of: str,
    id_columns: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Risk of every stock row and the holdout metrics; too few positives are an error."""
    features = inventory.writeoff_features(stock, as_of, orders, products).withColumn(
        "will_expire_30d", inventory.expiry_label()
    )
    features = settle(features)
    model, columns, metrics = inventory.train_writeoff_classifier(features, id_columns=id_columns)
    return inventory.predict_writeoff_risk(model, features, columns), metrics
