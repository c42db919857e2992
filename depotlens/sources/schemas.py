"""Canonical table schemas, as Spark DDL."""

from __future__ import annotations

# The columns and types of the raw tables.
TABLE_DDL = {
    "pharmacies": "pharmacy_id string, name string, is_chain boolean, address string, suburb string, state string, "
    "postcode string, phone string, email string, license_number string, established_date date, "
    "pharmacist_in_charge string, trading_hours string, has_consultation_room boolean, "
    "has_vaccination_service boolean, monthly_revenue bigint, customer_count bigint",
    "hospitals": "hospital_id string, name string, hospital_type string, address string, suburb string, state string, "
    "postcode string, phone string, email string, license_number string, beds bigint, emergency_department boolean, "
    "icu_beds bigint, specialties string, accreditation_date date, monthly_budget bigint, procurement_contact string, "
    "procurement_email string",
    "suppliers": "supplier_id string, name string, region string, lead_time_days bigint",
    "warehouses": "warehouse_id string, name string, region string",
    "products": "product_id string, name string, generic_name string, category string, manufacturer string, "
    "supplier string, pbs_code string, atc_code string, unit_price double, wholesale_price double, retail_price double, "
    "is_prescription boolean, is_controlled_substance boolean, requires_cold_chain boolean, storage_type string, "
    "expiry_months bigint, batch_size bigint, minimum_order_quantity bigint, lead_time_days bigint, "
    "active_ingredient string, dosage_form string, pack_size string, created_date date, last_updated date, "
    "supplier_id string, therapeutic_category string, brand string, generic_equivalent_id string, "
    "pack_size_variants string, margin_percentage double",
    "orders": "order_id string, customer_id string, customer_type string, product_id string, order_date date, "
    "quantity bigint, unit_price double, total_amount double, discount_rate double, discounted_amount double, "
    "order_status string, payment_terms string, shipping_method string, expected_delivery date, actual_delivery date, "
    "special_instructions string, sales_rep string, created_timestamp timestamp_ntz",
    "inventory": "inventory_id string, pharmacy_id string, product_id string, current_stock bigint, "
    "reorder_level bigint, max_stock bigint, needs_reorder boolean, last_restocked date, expiry_date date, "
    "batch_number string, storage_location string, cost_per_unit double, last_movement_date date, "
    "movement_type string, movement_quantity bigint, updated_timestamp timestamp_ntz",
    "supply_chain_events": "event_id string, order_id string, event_type string, event_timestamp timestamp_ntz, "
    "location string, status string, description string, operator string, equipment_id string, temperature bigint, "
    "notes string",
    "product_interactions": "interaction_id string, customer_id string, product_id string, action_type string, "
    "timestamp timestamp_ntz, session_id string",
    "substitution_events": "substitution_id string, order_id string, requested_product_id string, "
    "substituted_product_id string, reason string, customer_accepted boolean, margin_delta double, "
    "timestamp timestamp_ntz",
    "inventory_availability": "product_id string, warehouse_id string, quantity_available bigint, "
    "lead_time_days bigint, supplier_id string, snapshot_date date",
    "expiry_batches": "batch_id string, product_id string, warehouse_id string, expiry_date date, quantity bigint, "
    "cost_basis double",
    "writeoff_events": "event_id string, product_id string, warehouse_id string, quantity bigint, reason string, "
    "cost double, timestamp timestamp_ntz",
    "purchase_orders": "po_id string, supplier_id string, product_id string, quantity bigint, order_date date, "
    "expected_delivery_date date, actual_delivery_date date, unit_cost double",
    "supplier_performance": "supplier_id string, product_id string, fill_rate double, avg_lead_time_days bigint, "
    "lead_time_std double, month date",
    "warehouse_costs": "warehouse_id string, product_id string, storage_cost double, handling_cost double, period date",
    "competitor_products": "competitor_id string, product_name string, price double, url string, scrape_date date",
    "competitor_price_history": "competitor_id string, product_name string, price double, date date",
    "store_sales": "store_id string, product_id string, date date, sales_quantity bigint, revenue double",
    "store_attributes": "store_id string, location string, region string, size_sqm bigint, store_type string, "
    "cluster_id string",
    "promotions": "promo_id string, store_id string, product_id string, start_date date, end_date date, "
    "discount_rate double",
}

TABLE_COLUMNS = {
    table: [part.strip().split(" ")[0] for part in ddl.split(",")] for table, ddl in TABLE_DDL.items()
}

# Nested form of the extracted document fields.
DOCUMENT_HEADER = ("prescription_number", "prescription_date", "expiry_date")
DOCUMENT_GROUPS = {
    "patient": ("name", "date_of_birth", "address", "medicare_number", "phone"),
    "doctor": ("name", "provider_number", "ahpra_number", "signature_date"),
    "facility": ("name", "address", "phone", "abn"),
    "medication": (
        "name",
        "dosage_form",
        "strength",
        "quantity",
        "frequency",
        "duration",
        "instructions",
        "repeats",
    ),
}
DOCUMENT_FIELDS = [
    *DOCUMENT_HEADER,
    *[f"{group}_{field}" for group, fields in DOCUMENT_GROUPS.items() for field in fields],
]
ARTICLE_DDL = (
    "title string, url string, author string, published string, summary string, tags array<string>, "
    "fetched_at string, preview string, reading_time string"
)
OCR_DDL = "doc_id string, pages array<struct<page: int, text: string>>"
