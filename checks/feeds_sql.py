"""The canonical tables as SQL common table expressions, and how a check query is put together."""

from __future__ import annotations

import re

AS_OF = "DATE '2001-08-02'"
EVENTS_AS_OF = "TIMESTAMP '2024-01-31'"


def rnd(expression: str, scale: int) -> str:
    """Decimal half-up rounding of the shortest text of a double, as Spark rounds."""
    return f"CAST(round(CAST(CAST(({expression}) AS VARCHAR) AS DECIMAL(38,15)), {scale}) AS DOUBLE)"


def sum_exact(expression: str, scale: int = 2) -> str:
    return rnd(f"sum({expression})", scale)


def avg_exact(expression: str, scale: int = 2) -> str:
    return f"({sum_exact(expression, scale)} / nullif(count({expression}), 0))"


def ratio(top: str, bottom: str, scale: int = 2, factor: int = 1) -> str:
    value = f"CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0)"
    if factor != 1:
        value = f"{value} * {factor}"
    return f"CASE WHEN {bottom} > 0 THEN {rnd(value, scale)} ELSE 0.0::DOUBLE END"


def days(start: str, end: str) -> str:
    return f"datediff('day', CAST({start} AS DATE), CAST({end} AS DATE))"


def plus(day: str, count: str) -> str:
    return f"({day} + CAST({count} AS INTEGER))"


SALE_ID = "l_orderkey || '-' || l_partkey || '-' || l_suppkey"
LINE_ID = f"{SALE_ID} || '-' || l_linenumber || '-' || CAST(l_quantity AS BIGINT)"

CTE: dict[str, str] = {}

CTE["raw_orders"] = f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Hospital' ELSE 'Pharmacy' END AS customer_type,
  l_partkey AS product_id, CAST(o_orderdate AS DATE) AS order_date,
  CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice / l_quantity AS unit_price,
  l_extendedprice AS total_amount, l_discount AS discount_rate,
  l_extendedprice * (1 - l_discount) AS discounted_amount,
  CASE WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderstatus = 'O' THEN 'Shipped'
       WHEN l_returnflag = 'R' THEN 'Cancelled' ELSE 'Pending' END AS order_status,
  ' net ' || (30 + 15 * (l_linenumber % 3)) AS payment_terms,
  o_orderpriority AS shipping_method,
  {plus('CAST(o_orderdate AS DATE)', '1 + l_suppkey % 7')} AS expected_delivery,
  CASE WHEN o_orderkey % 10 <> 0 THEN {plus('CAST(o_orderdate AS DATE)', '1 + l_partkey % 10')} END AS actual_delivery,
  CAST(NULL AS VARCHAR) AS special_instructions,
  'Rep ' || (o_custkey % 50) AS sales_rep, o_orderdate AS created_timestamp
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey"""

CTE["raw_products"] = f"""
SELECT product_id, name, generic_name, category, manufacturer, supplier, pbs_code, atc_code, unit_price,
  wholesale_price, retail_price, is_prescription, is_controlled_substance, requires_cold_chain, storage_type,
  expiry_months, batch_size, minimum_order_quantity, lead_time_days, active_ingredient, dosage_form, pack_size,
  created_date, last_updated, supplier_id, therapeutic_category, brand, generic_equivalent_id, pack_size_variants,
  (retail_price - wholesale_price) / retail_price * 100 AS margin_percentage
FROM (SELECT p_partkey AS product_id, p_name AS name, ' ' || p_name || ' generic' AS generic_name,
  p_type AS category, p_brand AS manufacturer, 'Supplier ' || (p_partkey % 100) AS supplier,
  CASE WHEN p_partkey % 5 < 3 THEN 'PBS' || p_partkey END AS pbs_code, 'A' || p_size AS atc_code,
  p_retailprice / (1 + p_size % 25) AS unit_price,
  p_retailprice / (1 + p_size % 25) * 0.7::DOUBLE AS wholesale_price,
  p_retailprice / (1 + p_size % 25) * 1.3::DOUBLE AS retail_price,
  p_partkey % 5 < 3 AS is_prescription, p_partkey % 20 = 0 AS is_controlled_substance,
  p_partkey % 7 = 0 AS requires_cold_chain,
  CASE p_partkey % 3 WHEN 0 THEN 'Frozen (-20C)' WHEN 1 THEN 'Refrigerated (2-8C)' ELSE 'Room Temperature' END AS storage_type,
  CAST(12 + p_size AS BIGINT) AS expiry_months, CAST(100 AS BIGINT) AS batch_size,
  CAST(1 + p_size AS BIGINT) AS minimum_order_quantity, 1 + p_partkey % 30 AS lead_time_days,
  p_name AS active_ingredient, p_type AS dosage_form, CAST(p_size AS VARCHAR) AS pack_size,
  {plus("DATE '1996-01-01'", 'p_partkey % 2100')} AS created_date, {AS_OF} AS last_updated,
  p_partkey % 100 AS supplier_id, 'T' || (p_partkey % 12) AS therapeutic_category, p_brand AS brand,
  CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey + 1 AS VARCHAR) END AS generic_equivalent_id,
  '[' || p_size || ', ' || (p_size * 2) || ']' AS pack_size_variants FROM part)"""

CTE["raw_pharmacies"] = f"""
SELECT c_custkey AS pharmacy_id, '  ' || c_name || ' ' AS name, c_custkey % 10 < 7 AS is_chain,
  c_custkey || ' main st' AS address, 'Suburb ' || c_nationkey AS suburb, n_name AS state,
  CAST(2000 + c_nationkey * 10 AS BIGINT) AS postcode, '02' || c_custkey AS phone,
  ' ' || c_name || '@Example.com' AS email, 'LIC' || c_custkey AS license_number,
  {plus("DATE '1970-01-01'", 'c_custkey * 37 % 11700')} AS established_date,
  'Person ' || (c_custkey % 97) AS pharmacist_in_charge, '9-5' AS trading_hours,
  c_custkey % 2 = 0 AS has_consultation_room, c_custkey % 3 = 0 AS has_vaccination_service,
  CAST(floor(c_acctbal * 50) AS BIGINT) AS monthly_revenue, c_custkey % 5000 AS customer_count
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment <> 'MACHINERY'"""

CTE["raw_hospitals"] = f"""
SELECT c_custkey AS hospital_id, c_name || ' hospital ' AS name, ' type ' || (c_custkey % 4) AS hospital_type,
  c_custkey || ' high st' AS address, 'Suburb ' || c_nationkey AS suburb, n_name AS state,
  CAST(2000 + c_nationkey * 10 AS BIGINT) AS postcode, '03' || c_custkey AS phone,
  ' ' || c_name || '@Example.com' AS email, 'HOS' || c_custkey AS license_number, c_custkey % 700 AS beds,
  CASE WHEN c_custkey % 11 <> 0 THEN c_custkey % 2 = 0 END AS emergency_department,
  c_custkey % 3 * 10 AS icu_beds, 'Cardiology, Oncology' AS specialties,
  {plus("DATE '1970-01-01'", 'c_custkey * 41 % 11700')} AS accreditation_date,
  CAST(floor(c_acctbal * 600) AS BIGINT) AS monthly_budget, 'Buyer ' || (c_custkey % 31) AS procurement_contact,
  'Buyer' || (c_custkey % 31) || '@Example.com ' AS procurement_email
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment = 'MACHINERY'"""

CTE["raw_suppliers"] = """
SELECT s_suppkey AS supplier_id, s_name AS name, r_name AS region, 1 + s_suppkey % 14 AS lead_time_days
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""

CTE["raw_warehouses"] = """
SELECT pharmacy_id AS warehouse_id, name || ' (Warehouse)' AS name, state AS region FROM raw_pharmacies"""

CTE["raw_store_attributes"] = """
SELECT pharmacy_id AS store_id, address AS location, state AS region, 50 + pharmacy_id % 251 AS size_sqm,
  'pharmacy' AS store_type,
  CASE WHEN state IN ('NSW', 'VIC', 'ACT') THEN 'C1' WHEN state IN ('QLD', 'WA', 'NT') THEN 'C2'
       WHEN state IN ('SA', 'TAS') THEN 'C3' ELSE 'C1' END AS cluster_id
FROM raw_pharmacies"""

CTE["raw_inventory"] = f"""
SELECT 'INV-' || l_suppkey || '-' || l_partkey AS inventory_id, l_suppkey AS pharmacy_id, l_partkey AS product_id,
  units AS current_stock, 5 + l_partkey % 16 AS reorder_level, 20 + l_suppkey % 80 AS max_stock,
  units <= 5 + l_partkey % 16 AS needs_reorder,
  {plus(AS_OF, '3 - ((l_partkey + l_suppkey) % 120)')} AS last_restocked,
  {plus(AS_OF, '(l_partkey * 7 + l_suppkey) % 200 - 20')} AS expiry_date,
  'B' || (l_partkey % 1000) || '-' || l_suppkey AS batch_number, ' shelf ' || (l_suppkey % 9) AS storage_location,
  amount / units AS cost_per_unit, {plus(AS_OF, '-(l_partkey % 30)')} AS last_movement_date,
  CASE WHEN l_partkey % 2 = 0 THEN 'inbound' ELSE 'outbound' END AS movement_type,
  1 + (l_partkey + l_suppkey) % 40 AS movement_quantity, CAST({AS_OF} AS TIMESTAMP) AS updated_timestamp
FROM (SELECT l_suppkey, l_partkey, CAST(sum(l_quantity) AS BIGINT) AS units, {sum_exact('l_extendedprice')} AS amount
      FROM lineitem GROUP BY l_suppkey, l_partkey)"""

CTE["raw_inventory_availability"] = f"""
SELECT s.product_id, s.warehouse_id, s.quantity_available,
  coalesce(p.lead_time_days, 7) AS lead_time_days, p.supplier_id, {AS_OF} AS snapshot_date
FROM (SELECT product_id, pharmacy_id AS warehouse_id, CAST(sum(current_stock) AS BIGINT) AS quantity_available
      FROM raw_inventory GROUP BY product_id, pharmacy_id) s
LEFT JOIN raw_products p ON s.product_id = p.product_id"""

CTE["raw_expiry_batches"] = """
SELECT batch_number AS batch_id, product_id, pharmacy_id AS warehouse_id, expiry_date, current_stock AS quantity,
  cost_per_unit * movement_quantity AS cost_basis FROM raw_inventory"""

CTE["raw_supply_chain_events"] = """
SELECT event_id, user_id AS order_id,
  CASE event_type WHEN 'click' THEN 'Picking_Started' WHEN 'view' THEN 'In_Transit' WHEN 'purchase' THEN 'Delivered'
    WHEN 'signup' THEN 'Order_Received' WHEN 'error' THEN 'Damaged' ELSE 'Unknown' END AS event_type,
  ts AS event_timestamp, ' dock ' || (user_id % 5) AS location,
  CASE event_type WHEN 'error' THEN 'Error' WHEN 'signup' THEN 'Pending' WHEN 'click' THEN 'Warning'
    ELSE 'Success' END AS status,
  props AS description, 'Op ' || (event_id % 17) AS operator, 'EQ' || (event_id % 29) AS equipment_id,
  event_id % 30 AS temperature, CAST(NULL AS VARCHAR) AS notes FROM events"""

CTE["raw_product_interactions"] = f"""
SELECT 'P-' || {LINE_ID} AS interaction_id, o_custkey AS customer_id, l_partkey AS product_id,
  ' Purchased' AS action_type, o_orderdate AS "timestamp", 'S' || l_orderkey AS session_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL
SELECT 'E-' || event_id, user_id, event_id % (SELECT count(*) FROM part),
  CASE event_type WHEN 'view' THEN 'viewed' WHEN 'click' THEN 'added_to_cart' ELSE 'searched' END, ts, 'W' || user_id
FROM events"""

CTE["raw_substitution_events"] = f"""
SELECT 'S-' || {LINE_ID} AS substitution_id, l_orderkey AS order_id, l_partkey AS requested_product_id,
  l_partkey + 1 AS substituted_product_id,
  CASE WHEN l_linestatus = 'O' THEN ' Out_Of_Stock ' ELSE 'Cost_Saving' END AS reason,
  l_quantity > 10 AS customer_accepted, l_tax - l_discount AS margin_delta, l_shipdate AS "timestamp"
FROM lineitem WHERE l_returnflag = 'R'"""

CTE["raw_writeoff_events"] = f"""
SELECT 'W-' || {SALE_ID} AS event_id, l_partkey AS product_id, l_suppkey AS warehouse_id,
  CAST(l_quantity AS BIGINT) AS quantity, CASE WHEN l_linestatus = 'O' THEN 'damaged' ELSE 'expired' END AS reason,
  l_extendedprice AS cost, l_shipdate AS "timestamp" FROM lineitem WHERE l_returnflag = 'A'"""

CTE["raw_purchase_orders"] = f"""
SELECT 'PO-' || {SALE_ID} AS po_id, l_suppkey AS supplier_id, l_partkey AS product_id,
  CAST(l_quantity AS BIGINT) AS quantity, CAST(l_shipdate AS DATE) AS order_date,
  {plus('CAST(l_shipdate AS DATE)', '7 + l_suppkey % 7')} AS expected_delivery_date,
  CASE WHEN l_linestatus = 'F' THEN {plus('CAST(l_shipdate AS DATE)', '5 + l_partkey % 11')} END AS actual_delivery_date,
  l_extendedprice / l_quantity AS unit_cost FROM lineitem"""

CTE["raw_supplier_performance"] = """
SELECT l_suppkey AS supplier_id, l_partkey AS product_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
  coalesce(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity END), 0) / sum(l_quantity) AS fill_rate,
  max(1 + l_suppkey % 14) AS avg_lead_time_days, max(l_partkey % 5) / 2.0::DOUBLE AS lead_time_std
FROM lineitem GROUP BY ALL"""

CTE["raw_warehouse_costs"] = """
SELECT l_suppkey AS warehouse_id, l_partkey AS product_id, sum(l_quantity) * 0.25::DOUBLE AS storage_cost,
  count(*) * 1.5::DOUBLE AS handling_cost, max(CAST(date_trunc('month', l_shipdate) AS DATE)) AS period
FROM lineitem GROUP BY l_suppkey, l_partkey"""

CTE["raw_competitor_products"] = f"""
SELECT p_partkey % 5 AS competitor_id, p_name AS product_name, p_retailprice AS price,
  'https://example.com/p/' || p_partkey AS url, {plus("DATE '2001-01-01'", 'p_partkey % 200')} AS scrape_date FROM part"""

CTE["raw_competitor_price_history"] = """
SELECT l_suppkey AS competitor_id, 'Part ' || l_partkey AS product_name, l_extendedprice AS price,
  CAST(l_shipdate AS DATE) AS date FROM lineitem"""

CTE["raw_store_sales"] = """
SELECT l_suppkey AS store_id, l_partkey AS product_id, CAST(l_shipdate AS DATE) AS date,
  CAST(l_quantity AS BIGINT) AS sales_quantity, l_extendedprice AS revenue FROM lineitem"""

CTE["raw_promotions"] = f"""
SELECT 'PR-' || l_orderkey || '-' || l_partkey AS promo_id, l_suppkey AS store_id, l_partkey AS product_id,
  CAST(l_shipdate AS DATE) AS start_date, {plus('CAST(l_shipdate AS DATE)', '14')} AS end_date,
  l_discount AS discount_rate FROM lineitem WHERE l_discount > 0.05"""


def query(body: str) -> str:
    """The query with every common table expression it needs, directly or through another."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTE:
            if name not in needed and re.search(rf"(?:FROM|JOIN)\s+{name}\b", text):
                visit(CTE[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n].strip()})" for n in needed) + "\n" + body.strip()
