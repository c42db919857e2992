"""Document flow: page texts -> whole texts -> flat fields -> nested JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame

from depotlens.operators import documents


def extract_fields(
    pages: DataFrame,
    annotated: DataFrame | None = None,
    generated: DataFrame | None = None,
    mode: str = "auto",
) -> DataFrame | None:
    """Flat field rows from page texts, or from label JSON by the fallback rule of ``mode``."""
    extracted = documents.assign_fields(documents.assemble_doc_text(pages))
    labels = {
        name: None if rows is None else documents.flatten_label(rows)
        for name, rows in (("annotated", annotated), ("generated", generated))
    }
    return documents.field_source_fallback(extracted, labels["annotated"], labels["generated"], mode)


def nested_documents(pages: DataFrame) -> DataFrame:
    """(doc_id, json) of every document."""
    return documents.nest_fields(documents.assign_fields(documents.assemble_doc_text(pages)))
