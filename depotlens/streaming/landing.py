"""Incremental raw ingest: the same stateless steps as the batch load, over newly landed files.

Nothing here keeps state: a file is read once, marked, projected and appended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from depotlens.operators.bronze import to_bronze
from depotlens.sources.readers import CSV_FORMAT, add_lineage
from depotlens.sources.schemas import TABLE_DDL


def read_landing(
    spark: SparkSession, folder: str, table: str, files_per_trigger: int = 1000
) -> DataFrame:
    """Stream of a table's landed CSV files with the table's own schema."""
    return (
        spark.readStream.schema(TABLE_DDL[table])
        .options(header=True, maxFilesPerTrigger=files_per_trigger, **CSV_FORMAT)
        .csv(folder)
    )


def append_bronze(
    spark: SparkSession,
    folder: str,
    table: str,
    target: str,
    checkpoint: str,
    source: str = "landing",
    batch_id: str = "stream",
) -> StreamingQuery:
    """Append every new file of ``folder`` to a bronze Parquet table and stop when none is left."""
    rows = to_bronze(add_lineage(read_landing(spark, folder, table), source, batch_id), table)
    return (
        rows.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
