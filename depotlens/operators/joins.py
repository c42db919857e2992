"""Join shapes used across reports. No side is hinted: Spark broadcasts a side only when its
measured size is under the session's limit, and splits skewed partitions otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_orders_products_left(orders: DataFrame, products: DataFrame, *attributes: str) -> DataFrame:
    return orders.join(products.select("product_id", *attributes), "product_id", "left")


def join_products_orders_left(products: DataFrame, orders: DataFrame, *measures: str) -> DataFrame:
    """Every product with its order lines; a product without sales keeps one row."""
    return products.join(orders.select("product_id", *measures), "product_id", "left")


def id_membership(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows whose key occurs in the other table."""
    return df.join(other.select(F.col(other_key or key).alias(key)), key, "left_semi")


def anti_join_fk(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str, null_aware: bool = False
) -> DataFrame:
    """Child rows whose non-null key has no parent.

    ``null_aware`` follows SQL ``NOT IN``: a NULL among the parent keys leaves no violation.
    """
    keys = parent.select(F.col(parent_key).alias(key))
    missing = child.filter(F.col(key).isNotNull()).join(keys.filter(F.col(key).isNotNull()), key, "left_anti")
    if not null_aware:
        return missing
    nulls = keys.filter(F.col(key).isNull()).limit(1).agg(F.count(F.lit(1)).alias("nulls"))
    return missing.filter(nulls.scalar() == 0)


def anti_join_polymorphic(
    child: DataFrame, key: str, parents: Sequence[tuple[DataFrame, str]]
) -> DataFrame:
    """Child rows whose key is in none of the parents."""
    out = child.filter(F.col(key).isNotNull())
    for parent, parent_key in parents:
        out = anti_join_fk(out, key, parent, parent_key)
    return out


def lookup_default(
    df: DataFrame, lookup: DataFrame, key: str, value: str, default: object
) -> DataFrame:
    """Add ``value`` from a lookup table, with a default for unknown keys."""
    one_per_key = lookup.groupBy(key).agg(F.min(value).alias(value))
    return df.join(one_per_key, key, "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def merge_category(df: DataFrame, products: DataFrame, column: str) -> DataFrame:
    """Add one category per product; an unknown product gets 'unknown'."""
    one_per_product = products.groupBy("product_id").agg(F.min(column).alias(column))
    return df.join(one_per_product, "product_id", "left").withColumn(
        column, F.coalesce(F.col(column).cast("string"), F.lit("unknown"))
    )


def prefer_override(base: DataFrame, corrected: DataFrame, key: str) -> DataFrame:
    """Corrected rows replace base rows of the same key, as a whole row."""
    fields = [c for c in base.columns if c != key]
    winner = corrected.select(key, F.struct(*fields).alias("_corrected"))
    row = F.coalesce(F.col("_corrected"), F.struct(*fields)).alias("_row")
    return base.join(winner, key, "left").select(key, row).select(key, "_row.*")


def pair_docs_predictions(documents: DataFrame, predictions: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents that have a prediction."""
    return id_membership(documents, predictions, key)
