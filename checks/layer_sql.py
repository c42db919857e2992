"""SQL of the silver and gold layers, put together from tables of fixed values.

A silver table is given by how each column is treated, its ladders of labels and its rules; a gold table by
its keys and the measures it shows. Nothing here calls the library.
"""

from __future__ import annotations

from checks.feeds_sql import AS_OF, CTE, EVENTS_AS_OF, avg_exact, days, ratio, rnd, sum_exact

# Labels from a bound on, highest first, the last label below all bounds. A + excludes the bound itself.
LADDERS = """
hospital size: 500 Large Hospital / 200 Medium Hospital / 50 Small Hospital / Very Small Hospital
hospital budget: 5000000 High Budget / 2000000 Medium Budget / Low Budget
pharmacy revenue: 300000 High Revenue / 150000 Medium Revenue / Low Revenue
pharmacy customers: 3000 High Volume / 1500 Medium Volume / Low Volume
unit price: 200 High Value / 50 Medium Value / Low Value
order quantity: 50 High Volume / 20 Medium Volume / Low Volume
order amount: 10000 High Value / 1000 Medium Value / Low Value
order discount: 0.1+ High Discount / 0.05+ Medium Discount / 0+ Low Discount / No Discount
mean discount: 0.1 High Discount / 0.05 Medium Discount / 0+ Low Discount / No Discount
stock share: 80 Overstocked / 50 Well Stocked / 20 Low Stock / Critical Stock
month revenue: 100000 High Revenue Month / 50000 Medium Revenue Month / 10000 Low Revenue Month / Minimal Revenue Month
customer value: 100000 High Value / 50000 Medium Value / 10000 Low Value / Minimal Value
product revenue: 50000 High Revenue / 10000 Medium Revenue / 0+ Low Revenue / No Sales
pharmacy orders: 100000 High Performer / 50000 Medium Performer / 0+ Low Performer / No Orders
pharmacy stock: 70 Well Stocked / 30 Adequately Stocked / 0+ Under Stocked / No Inventory Data
product orders: 100 High Volume / 20 Medium Volume / 0+ Low Volume / No Orders
product spread: 50 Widely Stocked / 10 Moderately Stocked / 0+ Limited Stock / Not Stocked
product margin: 50 High Margin / 25 Medium Margin / 0+ Low Margin / No Margin Data
event success: 90 High Reliability / 70 Medium Reliability / 0+ Low Reliability / No Event Data
customer score: 100000 5 / 50000 4 / 20000 3 / 5000 2 / 1
product score: 50000 5 / 20000 4 / 5000 3 / 1000 2 / 1
"""

# What each raw word of an event stands for.
STATUS_RANK = "SUCCESS 1, WARNING 2, ERROR 3, PENDING 4"
STATUS_TEXT = "SUCCESS Completed, WARNING Attention Required, ERROR Failed, PENDING In Progress"
EVENT_KINDS = {
    "Order Processing": "ORDER_RECEIVED PAYMENT_CONFIRMED",
    "Fulfillment": "PICKING_STARTED PICKING_COMPLETED QUALITY_CHECK PACKAGING",
    "Shipping": "SHIPPED IN_TRANSIT OUT_FOR_DELIVERY",
    "Delivery": "DELIVERED",
    "Issues": "DELIVERY_FAILED RETURNED DAMAGED LOST",
}


def _read_ladders() -> dict[str, tuple[list[tuple[str, bool, str]], str]]:
    found = {}
    for line in LADDERS.strip().splitlines():
        name, _, rest = line.partition(": ")
        *steps, last = rest.split(" / ")
        parts = [s.split(" ", 1) for s in steps]
        found[name] = [(low.rstrip("+"), low.endswith("+"), label) for low, label in parts], last
    return found


STEPS = _read_ladders()


def step(name: str, value: str, suffix: str = "") -> str:
    """The label of the first bound that ``value`` reaches."""
    steps, last = STEPS[name]
    rows = ", ".join(f"{{'low': {low}, 'beyond': {str(beyond).lower()}, 'label': '{label}{suffix}'}}" for low, beyond, label in steps)
    reached = f"list_filter([{rows}], lambda s: ({value}) > s.low OR (({value}) = s.low AND NOT s.beyond))"
    return f"coalesce({reached}[1].label, '{last}{suffix}')"


def word(pairs: dict[str, str], key: str, otherwise: str) -> str:
    """Look a word up in fixed pairs."""
    listed = ", ".join(f"'{k}': '{v}'" for k, v in pairs.items())
    return f"coalesce(MAP {{{listed}}}[{key}], '{otherwise}')"


def _pairs(text: str) -> dict[str, str]:
    return dict(part.split(" ", 1) for part in text.split(", "))


def choose(*cases: str, otherwise: str = "NULL") -> str:
    """The result of the first "condition => result" that holds."""
    for case in reversed(cases):
        condition, result = case.split(" => ")
        otherwise = f"if(coalesce({condition}, false), {result}, {otherwise})"
    return otherwise


TREATED = {
    "plain": "{0}",
    "upper": "trim(upper({0}))",
    "lower": "lower(trim({0}))",
    "text": "trim(CAST({0} AS VARCHAR))",
    "cents": None,
    "rate": None,
}


def _columns(treatments: dict[str, str]) -> str:
    """Columns by treatment; ``old=new`` renames."""
    found = []
    for how, names in treatments.items():
        for name in names.split():
            old, _, new = name.partition("=")
            form = TREATED[how] or rnd("{0}", 2 if how == "cents" else 4)
            found.append(f"{form.format('s.' + old)} AS {new or old}")
    return ", ".join(found)


def silver(
    name: str,
    treatments: dict[str, str],
    *,
    first: dict[str, str] | None = None,
    then: dict[str, str] | None = None,
    negative: dict[str, str] | None = None,
    wrong: dict[str, str] | None = None,
    shown: dict[str, str] | None = None,
    needed: str = "",
    source: str | None = None,
    model: str | None = None,
) -> str:
    """A silver table: treated and ``first`` derived columns of the raw row ``s``, columns derived from those, then rules.

    ``negative`` and ``wrong`` flags reject a row, ``shown`` flags do not; ``needed`` columns must be known.
    """
    rules = {flag: f"{column} < 0" for flag, column in (negative or {}).items()} | (wrong or {})
    flags = "".join(f", coalesce({c}, false) AS {flag}" for flag, c in {**rules, **(shown or {})}.items())
    made = "".join(f", {c} AS {n}" for n, c in (then or {}).items())
    start = "".join(f", {c} AS {n}" for n, c in (first or {}).items())
    rejects = [*rules, *(f"{c} IS NULL" for c in needed.split())]
    inner = f"SELECT {_columns(treatments)}{start} FROM {source or name.replace('silver', 'raw')} s"
    derived = f"SELECT *{made} FROM ({inner})"
    return (
        f"SELECT * FROM (SELECT *{flags}, '{model or name}' AS silver_model_name FROM ({derived}))"
        f" WHERE NOT list_contains([{', '.join(rejects)}], true)"
    )


CTE["silver_hospitals"] = silver(
    "silver_hospitals",
    {
        "plain": "hospital_id phone license_number beds emergency_department icu_beds specialties accreditation_date "
        "monthly_budget procurement_contact",
        "upper": "name=hospital_name hospital_type address suburb state",
        "lower": "email procurement_email",
        "text": "postcode",
    },
    then={
        "years_accredited": f"{days('accreditation_date', AS_OF)} / 365",
        "hospital_size_tier": step("hospital size", "beds"),
        "budget_tier": step("hospital budget", "monthly_budget"),
        "service_level": choose(
            "emergency_department AND icu_beds > 0 => 'Full Service'",
            "emergency_department => 'Emergency Only'",
            "icu_beds > 0 => 'ICU Only'",
            otherwise="'Basic Service'",
        ),
    },
    negative={
        "has_negative_beds": "beds",
        "has_negative_icu_beds": "icu_beds",
        "has_negative_budget": "monthly_budget",
        "has_future_accreditation_date": "years_accredited",
    },
    needed="hospital_name state",
)

CTE["silver_pharmacies"] = silver(
    "silver_pharmacies",
    {
        "plain": "pharmacy_id phone license_number established_date pharmacist_in_charge trading_hours has_consultation_room "
        "has_vaccination_service monthly_revenue customer_count",
        "upper": "name=pharmacy_name address suburb state",
        "lower": "email",
        "text": "postcode",
    },
    first={"pharmacy_type": "if(coalesce(s.is_chain, false), 'Chain', 'Independent')"},
    then={
        "years_in_operation": f"{days('established_date', AS_OF)} / 365",
        "revenue_tier": step("pharmacy revenue", "monthly_revenue"),
        "customer_volume_tier": step("pharmacy customers", "customer_count"),
    },
    negative={
        "has_negative_revenue": "monthly_revenue",
        "has_negative_customers": "customer_count",
        "has_future_establishment_date": "years_in_operation",
    },
    needed="pharmacy_name state",
)

MARGIN = "s.retail_price - s.wholesale_price"
CTE["silver_products"] = silver(
    "silver_products",
    {
        "plain": "product_id pbs_code atc_code is_prescription is_controlled_substance requires_cold_chain expiry_months batch_size "
        "minimum_order_quantity lead_time_days active_ingredient dosage_form pack_size supplier_id therapeutic_category brand "
        "generic_equivalent_id pack_size_variants margin_percentage created_date last_updated",
        "upper": "name=product_name generic_name category manufacturer supplier storage_type",
        "cents": "unit_price wholesale_price retail_price",
    },
    first={
        "price_tier": step("unit price", "s.unit_price"),
        "storage_classification": choose(
            "s.requires_cold_chain => 'Cold Chain Required'",
            "contains(s.storage_type, 'Frozen') => 'Frozen Storage'",
            "contains(s.storage_type, 'Refrigerated') => 'Refrigerated Storage'",
            otherwise="'Room Temperature'",
        ),
        "profit_margin": rnd(MARGIN, 2),
        "profit_margin_percentage": rnd(f"({MARGIN}) / nullif(s.retail_price, 0) * 100", 2),
    },
    then={
        "days_since_created": days("created_date", AS_OF),
        "regulatory_class": choose(
            "is_prescription AND is_controlled_substance => 'Controlled Prescription'",
            "is_prescription => 'Prescription Only'",
            otherwise="'Over the Counter'",
        ),
    },
    negative={
        "has_negative_unit_price": "unit_price",
        "has_negative_wholesale_price": "wholesale_price",
        "has_negative_retail_price": "retail_price",
        "has_negative_expiry_months": "expiry_months",
        "has_future_created_date": "days_since_created",
    },
    needed="product_name category",
)


def _orders(delivered: str) -> str:
    return silver(
        "silver_orders",
        {
            "plain": "order_id customer_id product_id order_date expected_delivery actual_delivery created_timestamp quantity "
            "special_instructions sales_rep",
            "upper": "customer_type order_status payment_terms shipping_method",
            "cents": "unit_price total_amount discounted_amount",
            "rate": "discount_rate",
        },
        first={
            "delivered_": f"coalesce({delivered} = 'DELIVERED', false)",
            "order_value_tier": step("order amount", "s.total_amount"),
            "discount_tier": step("order discount", "s.discount_rate"),
        },
        then={
            "actual_delivery_days": days("order_date", "actual_delivery"),
            "expected_delivery_days": days("order_date", "expected_delivery"),
            "delivery_delay_days": days("expected_delivery", "actual_delivery"),
            "volume_tier": step("order quantity", "quantity"),
            "delivery_performance": choose(
                "NOT delivered_ => 'In Progress'",
                f"{days('expected_delivery', 'actual_delivery')} > 0 => 'Late'",
                f"{days('expected_delivery', 'actual_delivery')} <= 0 => 'On Time'",
                otherwise="'Delivered'",
            ),
        },
        negative={
            "has_negative_quantity": "quantity",
            "has_negative_unit_price": "unit_price",
            "has_negative_total_amount": "total_amount",
            "has_negative_delivery_days": "actual_delivery_days",
        },
        wrong={"has_invalid_discount_rate": "discount_rate NOT BETWEEN 0 AND 1"},
        needed="order_id customer_id product_id",
    ).replace("SELECT * FROM (", "SELECT * EXCLUDE (delivered_) FROM (", 1)


CTE["silver_orders"] = _orders("trim(upper(s.order_status))")
CTE["literal_orders"] = _orders("s.order_status")

CTE["silver_inventory"] = silver(
    "silver_inventory",
    {
        "plain": "inventory_id pharmacy_id product_id current_stock reorder_level max_stock needs_reorder last_restocked expiry_date "
        "last_movement_date updated_timestamp batch_number movement_quantity",
        "upper": "storage_location movement_type",
        "cents": "cost_per_unit",
    },
    first={
        "days_until_expiry": days(AS_OF, "s.expiry_date"),
        "days_since_last_restock": days("s.last_restocked", AS_OF),
        "stock_percentage": f"if(coalesce(s.max_stock > 0, false), {rnd('s.current_stock / s.max_stock * 100', 2)}, 0.0::DOUBLE)",
        "stock_to_reorder_ratio": f"if(coalesce(s.reorder_level > 0, false), {rnd('s.current_stock / s.reorder_level', 2)}, NULL)",
        "stock_status": choose(
            "s.current_stock <= s.reorder_level => 'Critical Stock'",
            "2 * s.current_stock <= 3 * s.reorder_level => 'Low Stock'",
            "s.current_stock >= s.max_stock * 0.8 => 'High Stock'",
            otherwise="'Normal Stock'",
        ),
    },
    then={
        "expiry_status": choose(
            "days_until_expiry > 60 => 'Fresh Stock'",
            "days_until_expiry > 30 => 'Approaching Expiry'",
            "days_until_expiry <= 30 => 'Expiring Soon'",
            otherwise="'Fresh Stock'",
        ),
        "stock_level_tier": step("stock share", "stock_percentage"),
    },
    negative={
        "has_negative_stock": "current_stock",
        "has_negative_reorder_level": "reorder_level",
        "has_negative_max_stock": "max_stock",
        "has_future_restock_date": "days_since_last_restock",
    },
    shown={
        "reorder_alert": "current_stock <= reorder_level",
        "expiry_alert": "days_until_expiry <= 30",
        "low_stock_alert": "stock_percentage <= 10",
        "has_expired_product": "days_until_expiry < 0",
    },
    needed="inventory_id pharmacy_id product_id",
)


def _events(case: str) -> str:
    """``case`` is applied to the raw words before they are looked up."""
    status, kind = case.format("s.status"), case.format("s.event_type")
    kinds = {k: category for category, listed in EVENT_KINDS.items() for k in listed.split()}
    return silver(
        "silver_supply_chain_events",
        {
            "plain": "event_id order_id event_timestamp description operator equipment_id notes",
            "upper": "event_type location status",
        },
        first={
            "status_priority": f"CAST({word(_pairs(STATUS_RANK), status, '5')} AS BIGINT)",
            "status_description": word(_pairs(STATUS_TEXT), status, "Unknown"),
            "event_category": word(kinds, kind, "Other"),
        },
        wrong={"has_future_timestamp": f"event_timestamp > {EVENTS_AS_OF}"},
        needed="event_id order_id event_type",
    )


CTE["silver_events"] = _events("upper({0})")
CTE["literal_events"] = _events("{0}")

CTE["silver_interactions"] = silver(
    "silver_reco_interactions",
    {"plain": 'interaction_id customer_id product_id "timestamp"=interaction_timestamp session_id', "lower": "action_type=word_"},
    then={"action_type": "if(word_ = 'added_to_cart', 'added', word_)"},
    needed="interaction_id customer_id interaction_timestamp",
    source="(SELECT * FROM raw_product_interactions SEMI JOIN raw_products USING (product_id))",
).replace("SELECT * FROM (", "SELECT * EXCLUDE (word_) FROM (", 1)

_KNOWN = " ".join(
    f"SEMI JOIN (SELECT {key} AS {name} FROM {table}) USING ({name})"
    for name, key, table in (
        ("order_id", "order_id", "raw_orders"),
        ("requested_product_id", "product_id", "raw_products"),
        ("substituted_product_id", "product_id", "raw_products"),
    )
)
CTE["silver_substitutions"] = silver(
    "silver_reco_substitutions",
    {
        "plain": 'substitution_id order_id requested_product_id substituted_product_id customer_accepted "timestamp"=substitution_timestamp',
        "lower": "reason",
        "rate": "margin_delta",
    },
    source=f"(SELECT * FROM raw_substitution_events {_KNOWN})",
)

# --- gold --------------------------------------------------------------------------------

MONTH = "CAST(date_trunc('month', order_date) AS DATE)"


def _distinct(value: str, when: str = "") -> str:
    return f"count(DISTINCT {value})" + (f" FILTER (WHERE {when})" if when else "")


def _rows(when: str) -> str:
    return f"count(*) FILTER (WHERE {when})"


def _whole(value: str) -> str:
    return f"CAST(sum({value}) AS BIGINT)"


#: Measures of order rows; gold tables choose from them and name them.
ORDER_MEASURES = {
    "orders": _distinct("order_id"),
    "customers": _distinct("customer_id"),
    "products": _distinct("product_id"),
    "months": _distinct(MONTH),
    "kinds": _distinct("customer_type"),
    "units": _whole("quantity"),
    "gross": sum_exact("total_amount"),
    "net": sum_exact("discounted_amount"),
    "saved": sum_exact("total_amount - discounted_amount"),
    "mean_gross": avg_exact("total_amount"),
    "mean_net": avg_exact("discounted_amount"),
    "mean_rate": avg_exact("discount_rate", 4),
    "mean_units": "avg(quantity)",
    "first": "min(order_date)",
    "last": "max(order_date)",
    "cut_orders": _rows("discount_rate > 0"),
    "cut_value": f"coalesce({sum_exact('if(discount_rate > 0, total_amount, NULL)')}, 0)",
    "cut_rate": avg_exact("if(discount_rate > 0, discount_rate, NULL)", 4),
    **{f"{level}_volume": _rows(f"volume_tier = '{level} Volume'") for level in ("High", "Medium", "Low")},
    **{f"{level}_value": _rows(f"order_value_tier = '{level} Value'") for level in ("High", "Medium", "Low")},
}
BY_LEVEL = {f"{level.lower()}_volume_orders": f"{level}_volume" for level in ("High", "Medium", "Low")}
BY_VALUE = {f"{level.lower()}_value_orders": f"{level}_value" for level in ("High", "Medium", "Low")}


def grouped(source: str, keys: str, shown: dict[str, str], measures: dict[str, str] = ORDER_MEASURES) -> str:
    """Measures of a table by keys, each under the name of the result."""
    listed = ", ".join(f"{measures[m]} AS {name}" for name, m in shown.items())
    return f"SELECT {', '.join(keys.split())}, {listed} FROM {source} GROUP BY ALL"


def _monthly(orders: str, upper: bool) -> str:
    """Order measures by month, customer type and product kind; the labels of volume in the case they are stored."""
    volumes = {}
    for level in ("High", "Medium", "Low"):
        label = f"{level} Volume"
        volumes[f"units_{level}"] = f"CAST(coalesce(sum(quantity) FILTER (WHERE volume_tier = '{label.upper() if upper else label}'), 0) AS BIGINT)"
    kinds = "(SELECT product_id, category AS product_category, price_tier AS product_price_tier FROM silver_products)"
    return grouped(
        f"(SELECT *, {MONTH} AS order_month FROM {orders}) LEFT JOIN {kinds} USING (product_id)",
        "order_month customer_type product_category product_price_tier",
        {
            "total_orders": "orders",
            "unique_customers": "customers",
            "unique_products": "products",
            "total_quantity": "units",
            "gross_revenue": "gross",
            "net_revenue": "net",
            "total_discount_amount": "saved",
            "avg_gross_order_value": "mean_gross",
            "avg_net_order_value": "mean_net",
            "avg_discount_rate": "mean_rate",
            "avg_quantity_per_order": "mean_units",
            "discounted_orders": "cut_orders",
            "discounted_order_value": "cut_value",
            "avg_discount_rate_when_discounted": "cut_rate",
            **{f"{level.lower()}_volume_quantity": f"units_{level}" for level in ("High", "Medium", "Low")},
        },
        ORDER_MEASURES | volumes,
    )


CTE["monthly_table"] = _monthly("silver_orders", False)
CTE["literal_monthly_table"] = _monthly("literal_orders", True)


def _more(source: str, made: dict[str, str], left_out: str = "") -> str:
    """All columns of a table but some, and more."""
    out = f" EXCLUDE ({', '.join(left_out.split())})" if left_out else ""
    return f"SELECT *{out}, " + ", ".join(f"{c} AS {n}" for n, c in made.items()) + f" FROM {source}"


def financial(source: str) -> str:
    return _more(
        source,
        {
            "discount_percentage": ratio("discounted_orders", "total_orders", 2, 100),
            "discount_impact_percentage": ratio("total_discount_amount", "gross_revenue", 2, 100),
            "revenue_per_unit": ratio("gross_revenue", "total_quantity"),
            "revenue_per_customer": ratio("gross_revenue", "unique_customers"),
            "monthly_revenue_tier": step("month revenue", "gross_revenue"),
            "monthly_discount_tier": step("mean discount", "avg_discount_rate", " Month"),
            "gold_model_name": "'gold_financial_analytics'",
        },
        "avg_quantity_per_order",
    )


_CUSTOMER = grouped(
    "silver_orders",
    "customer_id customer_type",
    {
        "total_orders": "orders",
        "lifetime_gross_revenue": "gross",
        "lifetime_net_revenue": "net",
        "lifetime_discount_amount": "saved",
        "avg_order_value": "mean_gross",
        "avg_discount_rate": "mean_rate",
        "first_order_date": "first",
        "last_order_date": "last",
        "active_months": "months",
    },
)
CTE["customer_table"] = _more(
    f"({_CUSTOMER})",
    {
        "customer_value_tier": step("customer value", "lifetime_gross_revenue"),
        "discount_behavior_tier": step("mean discount", "avg_discount_rate", " User"),
    },
)

CTE["product_sales"] = grouped(
    "silver_orders",
    "product_id",
    {
        "total_orders": "orders",
        "unique_customers": "customers",
        "total_quantity_sold": "units",
        "total_revenue": "gross",
        "total_discounted_revenue": "net",
        "total_discount_amount": "saved",
        "avg_quantity_per_order": "mean_units",
        "avg_order_value": "mean_gross",
        "avg_discount_rate": "mean_rate",
        "first_order_date": "first",
        "last_order_date": "last",
        "active_months": "months",
        "customer_types_count": "kinds",
        **BY_LEVEL,
    },
)


def _listed(columns: str, alias: str = "") -> str:
    """Columns by name; ``old=new`` renames."""
    found = (c.partition("=") for c in columns.split())
    return ", ".join(f"{alias}{old}" + (f" AS {new}" if new else "") for old, _, new in found)


def _filled(alias: str, counts: str, amounts: str = "") -> str:
    """Counts and amounts with 0 for unknown ones; ``old=new`` renames."""
    parts = [(c, "0") for c in counts.split()] + [(c, "0.0::DOUBLE") for c in amounts.split()]
    named = ((*c.partition("="), zero) for c, zero in parts)
    return ", ".join(f"coalesce({alias}{old}, {zero}) AS {new or old}" for old, _, new, zero in named)


PRICES = "unit_price wholesale_price retail_price profit_margin profit_margin_percentage"
PRODUCT_FINANCIALS = (
    f"SELECT {_listed('product_id product_name category price_tier ' + PRICES, 'p.')}, "
    f"{_filled('s.', 'total_orders unique_customers')}, "
    f"{_listed('total_quantity_sold total_revenue=gross_revenue total_discounted_revenue=net_revenue total_discount_amount avg_discount_rate', 's.')}, "
    f"{rnd('s.total_quantity_sold * p.profit_margin', 2)} AS total_profit, "
    f"{rnd('s.avg_quantity_per_order * p.profit_margin', 4)} AS avg_profit_per_order, "
    f"{step('product revenue', 's.total_revenue')} AS revenue_tier, {step('mean discount', 's.avg_discount_rate')} AS discount_tier "
    "FROM silver_products p LEFT JOIN product_sales s USING (product_id)"
)

CTE["pharmacy_sales"] = grouped(
    "(SELECT * FROM silver_orders WHERE customer_type = 'PHARMACY')",
    "customer_id customer_type",
    {
        "total_orders": "orders",
        "total_quantity_ordered": "units",
        "total_order_value": "gross",
        "total_discounted_value": "net",
        "avg_order_value": "mean_gross",
        "avg_discount_rate": "mean_rate",
        "first_order_date": "first",
        "last_order_date": "last",
        "unique_products_ordered": "products",
        "active_months": "months",
    },
)

#: Measures of stock rows.
STOCK_MEASURES = {
    "products": _distinct("product_id"),
    "pharmacies": _distinct("pharmacy_id"),
    "units": _whole("current_stock"),
    "worth": sum_exact("current_stock * cost_per_unit"),
    "reorders": _rows("reorder_alert"),
    "expiring": _rows("expiry_alert"),
    "share": avg_exact("stock_percentage"),
    "mean_units": "avg(current_stock)",
    "mean_days": "avg(days_until_expiry)",
}
CTE["pharmacy_stock"] = grouped(
    "silver_inventory",
    "pharmacy_id",
    {
        "total_products_in_stock": "products",
        "total_current_stock": "units",
        "total_inventory_value": "worth",
        "products_needing_reorder": "reorders",
        "products_expiring_soon": "expiring",
        "avg_stock_percentage": "share",
    },
    STOCK_MEASURES,
)
CTE["product_stock"] = grouped(
    "silver_inventory",
    "product_id",
    {
        "pharmacies_stocking": "pharmacies",
        "total_stock_across_pharmacies": "units",
        "total_inventory_value": "worth",
        "avg_stock_per_pharmacy": "mean_units",
        "avg_stock_percentage": "share",
        "pharmacies_needing_reorder": "reorders",
        "pharmacies_with_expiring_stock": "expiring",
        "avg_days_until_expiry": "mean_days",
    },
    STOCK_MEASURES,
)


def _ratios(*given: str) -> str:
    """Guarded ratios from "name = top / bottom" or "name = 100 * top / bottom"."""
    found = []
    for text in given:
        name, _, rest = text.partition(" = ")
        factor, _, rest = rest.rpartition(" * ")
        top, bottom = rest.split(" / ")
        found.append(f"{ratio(top, bottom, 2, int(factor or 1))} AS {name}")
    return ", ".join(found)


GOLD_PHARMACY = (
    "SELECT "
    + _listed(
        "pharmacy_id pharmacy_name pharmacy_type state suburb years_in_operation revenue_tier customer_volume_tier monthly_revenue "
        "customer_count has_consultation_room has_vaccination_service",
        "p.",
    )
    + ", "
    + _filled(
        "o.",
        "total_orders total_quantity_ordered unique_products_ordered active_months",
        "total_order_value total_discounted_value avg_order_value avg_discount_rate",
    )
    + ", "
    + _filled(
        "i.",
        "total_products_in_stock total_current_stock products_needing_reorder products_expiring_soon",
        "total_inventory_value avg_stock_percentage",
    )
    + ", "
    + _ratios(
        "revenue_per_order = o.total_order_value / o.total_orders",
        "revenue_per_customer = o.total_order_value / p.customer_count",
        "avg_quantity_per_order = o.total_quantity_ordered / o.total_orders",
        "reorder_percentage = 100 * i.products_needing_reorder / i.total_products_in_stock",
        "expiry_risk_percentage = 100 * i.products_expiring_soon / i.total_products_in_stock",
    )
    + f", {step('pharmacy orders', 'o.total_order_value')} AS performance_tier"
    + f", {step('pharmacy stock', 'i.avg_stock_percentage')} AS inventory_health, 'gold_pharmacy_performance' AS gold_model_name"
    + " FROM silver_pharmacies p LEFT JOIN pharmacy_sales o ON o.customer_id = p.pharmacy_id"
    + " LEFT JOIN pharmacy_stock i ON i.pharmacy_id = p.pharmacy_id"
)

GOLD_PRODUCT = (
    "SELECT "
    + _listed(
        "product_id product_name generic_name category manufacturer supplier regulatory_class price_tier storage_classification "
        f"is_prescription is_controlled_substance requires_cold_chain expiry_months minimum_order_quantity lead_time_days {PRICES}",
        "p.",
    )
    + ", "
    + _filled(
        "o.",
        "total_orders unique_customers total_quantity_sold active_months customer_types_count",
        "total_revenue total_discounted_revenue avg_quantity_per_order avg_order_value avg_discount_rate",
    )
    + ", "
    + _filled(
        "i.",
        "pharmacies_stocking total_stock_across_pharmacies pharmacies_needing_reorder pharmacies_with_expiring_stock",
        "total_inventory_value avg_stock_per_pharmacy avg_stock_percentage avg_days_until_expiry",
    )
    + ", "
    + _ratios(
        "revenue_per_order = o.total_revenue / o.total_orders",
        "orders_per_customer = o.total_orders / o.unique_customers",
        "revenue_per_unit_sold = o.total_revenue / o.total_quantity_sold",
        "reorder_percentage = 100 * i.pharmacies_needing_reorder / i.pharmacies_stocking",
        "expiry_risk_percentage = 100 * i.pharmacies_with_expiring_stock / i.pharmacies_stocking",
        "avg_orders_per_month = o.total_orders / o.active_months",
        "avg_quantity_per_month = o.total_quantity_sold / o.active_months",
    )
    + "".join(
        f", {step(ladder, value)} AS {name}"
        for name, ladder, value in (
            ("revenue_tier", "product revenue", "o.total_revenue"),
            ("volume_tier", "product orders", "o.total_orders"),
            ("distribution_tier", "product spread", "i.pharmacies_stocking"),
            ("margin_tier", "product margin", "p.profit_margin_percentage"),
        )
    )
    + ", 'gold_product_performance' AS gold_model_name FROM silver_products p"
    + " LEFT JOIN product_sales o ON o.product_id = p.product_id LEFT JOIN product_stock i ON i.product_id = p.product_id"
)


def _bit(condition: str) -> str:
    return f"CAST(coalesce({condition}, false) AS BIGINT)"


FULFILLMENT_COLUMNS = (
    "order_id customer_id customer_type product_id order_date expected_delivery actual_delivery order_status "
    "shipping_method total_amount quantity delivery_performance delivery_delay_days volume_tier order_value_tier"
).split()
CTE["fulfillment_table"] = _more(
    f"(SELECT {', '.join(FULFILLMENT_COLUMNS)} FROM silver_orders)",
    {
        "is_delivered": _bit("order_status = 'DELIVERED'"),
        "is_on_time_delivery": _bit("order_status = 'DELIVERED' AND delivery_delay_days <= 0"),
        "is_cancelled": _bit("order_status = 'CANCELLED'"),
        "is_significantly_delayed": _bit("delivery_delay_days > 7"),
    },
)

_EVENTS_BY_STATUS = {"successful": "SUCCESS", "failed": "ERROR", "warning": "WARNING"}
CTE["event_table"] = _more(
    "("
    + grouped(
        "silver_events",
        "order_id",
        {n: n for n in ("total_events", "first_event_timestamp", "last_event_timestamp", "event_categories_count")}
        | {f"{n}_events": n for n in _EVENTS_BY_STATUS},
        {
            "total_events": _distinct("event_id"),
            "first_event_timestamp": "min(event_timestamp)",
            "last_event_timestamp": "max(event_timestamp)",
            "event_categories_count": _distinct("event_category"),
            **{n: _distinct("event_id", f"status = '{status}'") for n, status in _EVENTS_BY_STATUS.items()},
        },
    )
    + ")",
    {
        f"event_{rate}_rate": ratio(f"{n}_events", "total_events", 2, 100)
        for rate, n in (("success", "successful"), ("failure", "failed"), ("warning", "warning"))
    },
)

_ORDERS_BY_STATE = {
    "delivered_orders": "is_delivered",
    "on_time_orders": "is_on_time_delivery",
    "cancelled_orders": "is_cancelled",
    "significantly_delayed_orders": "is_significantly_delayed",
}
MONTHLY_FULFILLMENT = grouped(
    f"(SELECT *, {MONTH} AS order_month FROM fulfillment_table)",
    "order_month",
    {
        "total_orders": "orders",
        "total_order_value": "gross",
        "avg_delivery_delay_days": "delay",
        "unique_customers": "customers",
        "unique_products": "products",
        **{n: n for n in _ORDERS_BY_STATE},
    },
    ORDER_MEASURES
    | {"delay": "avg(delivery_delay_days)"}
    | {n: _distinct("order_id", f"{flag} = 1") for n, flag in _ORDERS_BY_STATE.items()},
)

GOLD_SUPPLY = (
    "SELECT f.*, "
    + _filled("e.", "total_events successful_events failed_events warning_events event_categories_count")
    + ", "
    + _listed("first_event_timestamp last_event_timestamp event_success_rate event_failure_rate event_warning_rate", "e.")
    + f", {days('e.first_event_timestamp', 'e.last_event_timestamp')} * 24 AS fulfillment_duration_hours, "
    + choose(
        "f.is_delivered = 0 AND f.is_cancelled = 1 => 'Cancelled'",
        "f.is_delivered = 0 => 'In Progress'",
        "f.is_on_time_delivery = 1 => 'Excellent'",
        "f.delivery_delay_days > 7 => 'Poor'",
        "f.delivery_delay_days > 2 => 'Fair'",
        "f.delivery_delay_days <= 2 => 'Good'",
        otherwise="'Poor'",
    )
    + f" AS overall_performance, {step('event success', 'e.event_success_rate')} AS reliability_tier, "
    + choose(
        *(
            f"f.{late} OR e.event_failure_rate > {rate} => '{label} Risk'"
            for label, late, rate in (
                ("High", "is_significantly_delayed = 1", 20),
                ("Medium", "delivery_delay_days > 3", 10),
                ("Low", "delivery_delay_days > 0", 0),
            )
        ),
        otherwise="'No Risk'",
    )
    + " AS risk_level, 'gold_supply_chain_performance' AS gold_model_name"
    + " FROM fulfillment_table f LEFT JOIN event_table e ON e.order_id = f.order_id"
)

_CUSTOMER_FEATURES = grouped(
    "silver_orders",
    "customer_id customer_type",
    {
        "total_orders": "orders",
        "unique_products_ordered": "products",
        "total_quantity_ordered": "units",
        "total_order_value": "gross",
        "total_discounted_value": "net",
        "avg_order_value": "mean_gross",
        "avg_discount_rate": "mean_rate",
        "first_order_date": "first",
        "last_order_date": "last",
        "active_months": "months",
        **BY_LEVEL,
        **BY_VALUE,
        "discounted_orders": "cut_orders",
        "avg_discount_when_discounted": "cut_rate",
    },
)
CTE["customer_feature_table"] = _more(
    f"({_CUSTOMER_FEATURES})",
    {
        "customer_age_days": days("first_order_date", AS_OF),
        "days_since_last_order": days("last_order_date", AS_OF),
        "orders_per_month": "coalesce(CAST(total_orders AS DOUBLE) / nullif(active_months, 0), if(total_orders > 0, NULL, 0))",
        "customer_value_score": f"CAST({step('customer score', 'total_order_value')} AS BIGINT)",
    },
)

CTE["product_feature_table"] = (
    "SELECT "
    + _listed(
        "product_id product_name category price_tier regulatory_class storage_classification unit_price profit_margin_percentage "
        "is_prescription is_controlled_substance requires_cold_chain expiry_months minimum_order_quantity lead_time_days",
        "p.",
    )
    + ", "
    + _filled("s.", "total_orders unique_customers active_months=active_sale_months " + " ".join(BY_LEVEL))
    + ", "
    + _listed(
        "total_quantity_sold total_revenue avg_quantity_per_order avg_order_value avg_discount_rate first_order_date=first_sale_date "
        "last_order_date=last_sale_date",
        "s.",
    )
    + f", CAST({step('product score', 's.total_revenue')} AS BIGINT) AS product_performance_score"
    + " FROM silver_products p LEFT JOIN product_sales s ON s.product_id = p.product_id"
)

#: Score of a stock row from least share and least days until expiry.
STOCK_SCORES = ((5, 80, 90), (4, 60, 60), (3, 40, 30), (2, 20, 15))
CTE["inventory_feature_table"] = (
    "SELECT "
    + _listed(
        "pharmacy_id product_id current_stock reorder_level max_stock stock_percentage stock_to_reorder_ratio days_until_expiry "
        "days_since_last_restock stock_status expiry_status stock_level_tier reorder_alert expiry_alert low_stock_alert"
    )
    + ", CAST("
    + choose(*(f"stock_percentage >= {share} AND days_until_expiry >= {left} => {score}" for score, share, left in STOCK_SCORES), otherwise="1")
    + " AS BIGINT) AS inventory_health_score FROM silver_inventory"
)

_TAKEN = "total_orders unique_customers avg_order_value avg_discount_rate " + " ".join(BY_LEVEL)
GOLD_ML = (
    "SELECT c.* EXCLUDE (first_order_date, last_order_date), "
    f"p.* EXCLUDE ({', '.join((_TAKEN + ' first_sale_date last_sale_date').split())}), "
    + _listed(" ".join(f"{n}=product_{n}" for n in _TAKEN.split()), "p.")
    + ", i.* EXCLUDE (pharmacy_id, product_id), "
    + f"{_bit('c.days_since_last_order > 90')} AS is_churn_risk, {_bit('i.reorder_alert OR i.expiry_alert')} AS needs_attention, "
    + "['Low Value', 'Medium Value', 'High Value']"
    + "[1 + CAST(least(c.customer_value_score, p.product_performance_score) >= 3 AS INTEGER)"
    + " + CAST(least(c.customer_value_score, p.product_performance_score) >= 4 AS INTEGER)] AS customer_product_value_tier, "
    + "'gold_ml_ready_dataset' AS gold_model_name"
    + " FROM (SELECT customer_id, product_id FROM silver_orders UNION SELECT pharmacy_id, product_id FROM silver_inventory) pairs"
    + " JOIN customer_feature_table c USING (customer_id) JOIN product_feature_table p USING (product_id)"
    + " LEFT JOIN inventory_feature_table i ON i.pharmacy_id = pairs.customer_id AND i.product_id = pairs.product_id"
)
