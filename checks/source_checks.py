"""Checks of sources and sinks: given tables are written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.document_checks import _fields
from checks.feeds_sql import CTE, query
from depotlens.operators import documents
from depotlens.session import checkpoint_folder
from depotlens.sources import readers, writers
from depotlens.sources.schemas import DOCUMENT_FIELDS, DOCUMENT_GROUPS, DOCUMENT_HEADER


def _scratch(feeds) -> str:
    return f"{checkpoint_folder(feeds.spark)}/files-{uuid.uuid4().hex}"


def _csv(feeds):
    folder = _scratch(feeds)
    writers.write_csv_all({"orders": feeds.orders, "suppliers": feeds.suppliers}, folder)
    return readers.scan_csv_tables(feeds.spark, folder)["orders"]


def _csv_texts(feeds):
    """Long texts with quotes and line breaks through delimited files."""
    folder = _scratch(feeds)
    docs = feeds.table("documents")
    writers.write_csv_all({"documents": docs}, folder)
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return readers.scan_csv(feeds.spark, f"{folder}/documents.csv", schema)


def _csv_inferred(feeds):
    folder = _scratch(feeds)
    writers.write_csv_all({"suppliers": feeds.suppliers}, folder)
    found = readers.scan_csv_tables(feeds.spark, folder, infer=True)["suppliers"]
    return found.withColumn("lead_time_days", F.col("lead_time_days").cast("bigint")).withColumn(
        "supplier_id", F.col("supplier_id").cast("bigint")
    )


def _parquet(feeds):
    path = _scratch(feeds)
    writers.write_parquet(feeds.orders, path)
    return readers.scan_parquet(feeds.spark, path)


def _fallback(feeds):
    """Order dates of every seventh order are unreadable in the file."""
    folder = _scratch(feeds)
    day = F.when(F.col("order_id") % 7 == 0, F.lit("soon")).otherwise(F.col("order_date").cast("string"))
    writers.write_csv_all({"orders": feeds.orders.withColumn("order_date", day)}, folder)
    return readers.scan_with_fallback(
        feeds.spark, "orders", ["no_such_silver_orders"], ["no_such_bronze_orders"], folder
    ).select("order_id", "product_id", "order_date")


def _pages(feeds):
    path = _scratch(feeds)
    writers.write_ocr_json(feeds.doc_pages.withColumn("doc_id", F.col("doc_id").cast("string")), path)
    docs = readers.scan_json_docs(feeds.spark, path, lines=True)
    return docs.select("doc_id", F.inline("pages"))


def _written_fields(feeds):
    path = _scratch(feeds)
    writers.write_field_json(_fields(feeds), path)
    again = readers.scan_json_docs(feeds.spark, path, f"doc_id string, {_NESTED}", lines=True)
    return documents.flatten_label(again.select("doc_id", F.to_json(F.struct("*")).alias("json")))


_NESTED = ", ".join(
    [f"{name} string" for name in DOCUMENT_HEADER]
    + [
        f"{group} struct<{', '.join(f'{m}: string' for m in members)}>"
        for group, members in DOCUMENT_GROUPS.items()
    ]
)

CTE["buyers"] = "SELECT DISTINCT o_custkey AS customer_id FROM orders"
CTE["browsers"] = "SELECT DISTINCT user_id AS customer_id FROM events"


def _buyers(feeds):
    return feeds.table("orders").select(F.col("o_custkey").alias("customer_id"))


def _browsers(feeds):
    return feeds.table("events").select(F.col("user_id").alias("customer_id"))


TEXT_IDS = "* REPLACE (CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, CAST(product_id AS VARCHAR) AS product_id"

CHECKS = {
    "write_csv_all": (
        _csv,
        # Leading and trailing spaces of delimited text survive; ids are text in the file schema.
        query(f"SELECT {TEXT_IDS}) FROM raw_orders"),
    ),
    "write_csv_texts": (_csv_texts, "SELECT * FROM documents"),
    "scan_csv_infer": (_csv_inferred, query("SELECT * FROM raw_suppliers")),
    "write_parquet": (_parquet, query("SELECT * FROM raw_orders")),
    "scan_with_fallback": (
        _fallback,
        query(
            "SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(product_id AS VARCHAR) AS product_id, "
            "CASE WHEN order_id % 7 <> 0 THEN order_date END AS order_date FROM raw_orders"
        ),
    ),
    "add_lineage": (
        lambda f: readers.add_lineage(f.suppliers, "local_csv", "local", clock=False),
        query("SELECT *, 'local_csv' AS _source, 'local' AS _batch_id FROM raw_suppliers"),
    ),
    "scan_json_docs": (
        _pages,
        query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(page AS INTEGER) AS page, text FROM doc_pages"),
    ),
    "write_field_json": (
        _written_fields,
        query(
            "SELECT CAST(doc_id AS VARCHAR) AS doc_id, "
            + ", ".join(f"coalesce({c}, '') AS {c}" for c in DOCUMENT_FIELDS)
            + " FROM field_table"
        ),
    ),
    "set_intersect": (
        lambda f: _buyers(f).intersect(_browsers(f)),
        query("SELECT customer_id FROM buyers WHERE customer_id IN (SELECT customer_id FROM browsers)"),
    ),
    "set_difference": (
        lambda f: _buyers(f).distinct().join(_browsers(f), "customer_id", "left_anti"),
        query("SELECT customer_id FROM buyers WHERE customer_id NOT IN (SELECT customer_id FROM browsers)"),
    ),
    "union_all": (
        lambda f: _buyers(f)
        .withColumn("source", F.lit("orders"))
        .unionByName(_browsers(f).withColumn("kind", F.lit("event")), allowMissingColumns=True),
        "SELECT o_custkey AS customer_id, 'orders' AS source, CAST(NULL AS VARCHAR) AS kind FROM orders "
        "UNION ALL SELECT user_id, NULL, 'event' FROM events",
    ),
}
