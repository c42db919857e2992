"""Catalogue browsing: schemas, tables, layers, counts and previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.functions.columns import as_column, first_true

# Layer names, and bounds of a preview.
LAYERS = ("raw", "bronze", "silver", "gold")
PREVIEW_ROWS = 200
FEWEST_PREVIEW_ROWS = 10
MOST_PREVIEW_ROWS = 2000


def layer_of_schema(schema: Column | str) -> Column:
    """Layer by the ending of a schema name."""
    name = F.lower(as_column(schema))
    return first_true([((name == layer) | name.endswith(f"_{layer}"), layer) for layer in LAYERS], "other")


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """(schema, table, type, layer), ordered; only catalogue entries pass through the driver."""
    names = [database] if database else [d.name for d in spark.catalog.listDatabases()]
    rows = [
        (name, table.name, table.tableType)
        for name in names
        for table in spark.catalog.listTables(name)
        if not table.isTemporary
    ]
    listed = spark.createDataFrame(rows, "schema string, table string, type string")
    return listed.withColumn("layer", layer_of_schema("schema")).orderBy("schema", "table")


def table_row_count(spark: SparkSession, table: str) -> int:
    return spark.table(table).count()


def preview_table(
    df: DataFrame,
    limit: int = PREVIEW_ROWS,
    *order: str,
    fewest: int = FEWEST_PREVIEW_ROWS,
    most: int = MOST_PREVIEW_ROWS,
) -> DataFrame:
    """A look at a table, ``limit`` rows but ``fewest`` to ``most``; with ``order`` the same rows every time."""
    rows = max(fewest, min(most, limit))
    return (df.orderBy(*order) if order else df).limit(rows)
