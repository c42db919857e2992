"""Sinks: raw, scored and document tables, delimited and JSON files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.operators.documents import nest_fields, nested_fields, ocr_documents
from depotlens.sources.readers import CSV_FORMAT, RAW_PREFIX, add_lineage


def write_raw(
    df: DataFrame,
    table: str,
    schema: str,
    source: str,
    batch_id: str,
    mode: str = "append",
    prefix: str = RAW_PREFIX,
) -> str:
    """Save a table with lineage columns; returns the table name."""
    name = f"{schema}.{prefix}{table}"
    add_lineage(df, source, batch_id).write.mode(mode).saveAsTable(name)
    return name


def verify_counts(spark: SparkSession, *tables: str) -> DataFrame:
    """(table, rows) of every table; a table that cannot be read has NULL rows."""
    out = None
    for name in tables:
        if spark.catalog.tableExists(name):
            counted = spark.table(name).agg(F.count(F.lit(1)).alias("rows"))
        else:
            counted = spark.range(1).select(F.lit(None).cast("bigint").alias("rows"))
        part = counted.select(F.lit(name).alias("table"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


def write_csv_all(
    tables: Mapping[str, DataFrame], folder: str, mode: str = "overwrite", bytes_per_file: int = 1 << 27
) -> None:
    """Each table as ``<folder>/<name>.csv``, a directory of part files with headers.

    A file ends after as many rows as have ``bytes_per_file`` on average; one pass over the table sizes them.
    """
    for name, df in tables.items():
        line = F.octet_length(F.to_csv(F.struct(*df.columns), CSV_FORMAT)) + 1
        n, size = df.agg(F.count(F.lit(1)), F.sum(line.cast("bigint"))).first()
        rows = max(1, n * bytes_per_file // size) if size else 1
        df.write.mode(mode).options(header=True, maxRecordsPerFile=rows, **CSV_FORMAT).csv(f"{folder}/{name}.csv")


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_scored_table(df: DataFrame, table: str, stamp: str = "scored_at") -> None:
    """Replace a result table, stamped with the time of the run."""
    df.withColumn(stamp, F.current_timestamp()).write.mode("overwrite").saveAsTable(table)


def write_catalog_table(df: DataFrame, table: str) -> bool:
    """Replace a table; an empty frame leaves it as it is and returns False."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").saveAsTable(table)
    return True


def write_ocr_json(pages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON document per line, pages in page order."""
    ocr_documents(pages).write.mode(mode).json(path)


def write_field_json(
    fields: DataFrame, path: str, mode: str = "overwrite", folder_per_document: bool = False
) -> None:
    """Nested JSON of every row with a doc_id.

    One document per line, led by its doc_id, so that the number of files follows the data volume.
    ``folder_per_document`` writes ``doc_id=<id>/`` folders instead, for small hand-over packages.
    """
    kept = fields.filter(F.col("doc_id").isNotNull())
    if folder_per_document:
        nest_fields(kept).write.mode(mode).partitionBy("doc_id").text(path)
    else:
        kept.select(F.col("doc_id"), nested_fields(kept).alias("d")).select("doc_id", "d.*").write.mode(mode).json(path)
