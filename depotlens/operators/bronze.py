"""Bronze layer: one generic projection, and what each table selects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.sources.schemas import TABLE_COLUMNS

# Tables with a listed projection, and the entity whose `name` is renamed.
FIXED_PROJECTION = {
    "hospitals": "hospital_name",
    "pharmacies": "pharmacy_name",
    "products": "product_name",
    "orders": None,
    "inventory": None,
    "supply_chain_events": None,
}

# Raw table -> bronze model name.
BRONZE_MODELS = {
    "hospitals": "bronze_hospitals",
    "pharmacies": "bronze_pharmacies",
    "products": "bronze_products",
    "orders": "bronze_orders",
    "inventory": "bronze_inventory",
    "supply_chain_events": "bronze_supply_chain_events",
    "product_interactions": "bronze_reco_interactions",
    "substitution_events": "bronze_reco_substitutions",
    "suppliers": "bronze_suppliers",
    "warehouses": "bronze_warehouses",
    "inventory_availability": "bronze_inventory_availability",
    "expiry_batches": "bronze_expiry_batches",
    "writeoff_events": "bronze_writeoff_events",
    "purchase_orders": "bronze_purchase_orders",
    "supplier_performance": "bronze_supplier_performance",
    "warehouse_costs": "bronze_warehouse_costs",
    "competitor_products": "bronze_competitor_products",
    "competitor_price_history": "bronze_competitor_price_history",
    "store_sales": "bronze_store_sales",
    "store_attributes": "bronze_store_attributes",
    "promotions": "bronze_promotions",
}

LINEAGE = ("_ingestion_timestamp", "_source", "_batch_id")


def to_bronze(df: DataFrame, table: str, audit: bool = True) -> DataFrame:
    """Project a raw table to its bronze shape and stamp it.

    ``audit=False`` leaves out the run clock so that equal input gives equal output.
    """
    out = df
    if table in FIXED_PROJECTION:
        keep = [c for c in TABLE_COLUMNS[table] if c in df.columns]
        out = df.select(*keep, *[c for c in LINEAGE if c in df.columns])
        renamed = FIXED_PROJECTION[table]
        if renamed:
            out = out.withColumnRenamed("name", renamed)
    stamps = {"bronze_model_name": F.lit(BRONZE_MODELS[table])}
    if audit:
        stamps = {"bronze_processed_at": F.current_timestamp(), **stamps}
    return out.withColumns(stamps)
