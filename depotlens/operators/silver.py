"""Silver layer: cleaned labels, derived measures, tiers, quality flags and reject rules.

Each function takes bronze tables and an ``as_of`` date and returns the accepted rows. Rules treat
an unknown value as acceptable: only a known violation rejects a row. Two label comparisons exist
in a literal form as well: ``compat=True`` compares the raw label with the upper-case constant, so
that mixed-case input falls through to the default label.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.functions.columns import (
    as_date,
    clean_lower,
    clean_upper,
    days_between,
    first_true,
    flag,
    tier,
    trim_cast,
)

# Thresholds of the business rules.
HIGH_VOLUME_QUANTITY = 50
MEDIUM_VOLUME_QUANTITY = 20
EXPIRY_WARNING_DAYS = 30
REORDER_ALERT_THRESHOLD = 0.1

# Supply-chain event vocabulary.
EVENT_CATEGORIES = {
    "Order Processing": ["ORDER_RECEIVED", "PAYMENT_CONFIRMED"],
    "Fulfillment": ["PICKING_STARTED", "PICKING_COMPLETED", "QUALITY_CHECK", "PACKAGING"],
    "Shipping": ["SHIPPED", "IN_TRANSIT", "OUT_FOR_DELIVERY"],
    "Delivery": ["DELIVERED"],
    "Issues": ["DELIVERY_FAILED", "RETURNED", "DAMAGED", "LOST"],
}
STATUS_PRIORITY = {"SUCCESS": 1, "WARNING": 2, "ERROR": 3, "PENDING": 4}
STATUS_DESCRIPTION = {
    "SUCCESS": "Completed",
    "WARNING": "Attention Required",
    "ERROR": "Failed",
    "PENDING": "In Progress",
}
ACTION_ALIASES = {"added_to_cart": "added"}


def reject_flags(df: DataFrame, *flags: str) -> DataFrame:
    """Keep the rows on which no flag is raised."""
    keep = ~F.col(flags[0])
    for name in flags[1:]:
        keep = keep & ~F.col(name)
    return df.filter(keep)


def not_null_filter(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(subset=list(keys))


def _finish(
    df: DataFrame,
    model: str,
    flags: Mapping[str, Column],
    required: tuple[str, ...],
    audit: bool,
    extra_flags: Mapping[str, Column] | None = None,
) -> DataFrame:
    out = df.withColumns({**flags, **(extra_flags or {})})
    out = not_null_filter(reject_flags(out, *flags), *required)
    stamps = {"silver_model_name": F.lit(model)}
    if audit:
        stamps = {"silver_processed_at": F.current_timestamp(), **stamps}
    return out.drop("bronze_model_name").withColumns(stamps)


def silver_hospitals(bronze: DataFrame, as_of: str, audit: bool = True) -> DataFrame:
    cleaned = bronze.withColumns(
        {
            **{
                name: clean_upper(name)
                for name in ("hospital_name", "hospital_type", "address", "suburb", "state")
            },
            "postcode": trim_cast("postcode"),
            "email": clean_lower("email"),
            "procurement_email": clean_lower("procurement_email"),
            "years_accredited": days_between("accreditation_date", as_date(as_of)) / 365,
            "hospital_size_tier": tier(
                "beds",
                [(500, "Large Hospital"), (200, "Medium Hospital"), (50, "Small Hospital")],
                "Very Small Hospital",
            ),
            "budget_tier": tier(
                "monthly_budget", [(5_000_000, "High Budget"), (2_000_000, "Medium Budget")], "Low Budget"
            ),
            "service_level": first_true(
                [
                    (F.col("emergency_department") & (F.col("icu_beds") > 0), "Full Service"),
                    (F.col("emergency_department"), "Emergency Only"),
                    (F.col("icu_beds") > 0, "ICU Only"),
                ],
                "Basic Service",
            ),
        }
    )
    return _finish(
        cleaned,
        "silver_hospitals",
        {
            "has_negative_beds": flag(F.col("beds") < 0),
            "has_negative_icu_beds": flag(F.col("icu_beds") < 0),
            "has_negative_budget": flag(F.col("monthly_budget") < 0),
            "has_future_accreditation_date": flag(F.col("years_accredited") < 0),
        },
        ("hospital_name", "state"),
        audit,
    )


def silver_pharmacies(bronze: DataFrame, as_of: str, audit: bool = True) -> DataFrame:
    cleaned = bronze.withColumns(
        {
            **{name: clean_upper(name) for name in ("pharmacy_name", "address", "suburb", "state")},
            "pharmacy_type": first_true([(F.col("is_chain"), "Chain")], "Independent"),
            "postcode": trim_cast("postcode"),
            "email": clean_lower("email"),
            "years_in_operation": days_between("established_date", as_date(as_of)) / 365,
            "revenue_tier": tier(
                "monthly_revenue", [(300_000, "High Revenue"), (150_000, "Medium Revenue")], "Low Revenue"
            ),
            "customer_volume_tier": tier(
                "customer_count", [(3000, "High Volume"), (1500, "Medium Volume")], "Low Volume"
            ),
        }
    ).drop("is_chain")
    return _finish(
        cleaned,
        "silver_pharmacies",
        {
            "has_negative_revenue": flag(F.col("monthly_revenue") < 0),
            "has_negative_customers": flag(F.col("customer_count") < 0),
            "has_future_establishment_date": flag(F.col("years_in_operation") < 0),
        },
        ("pharmacy_name", "state"),
        audit,
    )


def silver_products(bronze: DataFrame, as_of: str, audit: bool = True) -> DataFrame:
    margin = F.col("retail_price") - F.col("wholesale_price")
    cleaned = bronze.withColumns(
        {
            # Read before cleaning: tiers, storage class and margins follow the raw values.
            "price_tier": tier("unit_price", [(200, "High Value"), (50, "Medium Value")], "Low Value"),
            "regulatory_class": first_true(
                [
                    (F.col("is_prescription") & F.col("is_controlled_substance"), "Controlled Prescription"),
                    (F.col("is_prescription"), "Prescription Only"),
                ],
                "Over the Counter",
            ),
            "storage_classification": first_true(
                [
                    (F.col("requires_cold_chain"), "Cold Chain Required"),
                    (F.col("storage_type").like("%Frozen%"), "Frozen Storage"),
                    (F.col("storage_type").like("%Refrigerated%"), "Refrigerated Storage"),
                ],
                "Room Temperature",
            ),
            "profit_margin": F.round(margin, 2),
            "profit_margin_percentage": F.round(F.try_divide(margin, F.col("retail_price")) * 100, 2),
            "days_since_created": days_between("created_date", as_date(as_of)),
            **{
                name: clean_upper(name)
                for name in (
                    "product_name",
                    "generic_name",
                    "category",
                    "manufacturer",
                    "supplier",
                    "storage_type",
                )
            },
            **{name: F.round(name, 2) for name in ("unit_price", "wholesale_price", "retail_price")},
        }
    )
    return _finish(
        cleaned,
        "silver_products",
        {
            "has_negative_unit_price": flag(F.col("unit_price") < 0),
            "has_negative_wholesale_price": flag(F.col("wholesale_price") < 0),
            "has_negative_retail_price": flag(F.col("retail_price") < 0),
            "has_negative_expiry_months": flag(F.col("expiry_months") < 0),
            "has_future_created_date": flag(F.col("days_since_created") < 0),
        },
        ("product_name", "category"),
        audit,
    )


def silver_orders(bronze: DataFrame, audit: bool = True, compat: bool = False) -> DataFrame:
    delay = days_between("expected_delivery", "actual_delivery")
    delivered = (F.col("order_status") if compat else clean_upper("order_status")) == "DELIVERED"
    cleaned = bronze.withColumns(
        {
            "customer_type": clean_upper("customer_type"),
            "volume_tier": tier(
                "quantity",
                [(HIGH_VOLUME_QUANTITY, "High Volume"), (MEDIUM_VOLUME_QUANTITY, "Medium Volume")],
                "Low Volume",
            ),
            "order_value_tier": tier(
                "total_amount", [(10_000, "High Value"), (1_000, "Medium Value")], "Low Value"
            ),
            "discount_tier": tier(
                "discount_rate",
                [(0.1, "High Discount"), (0.05, "Medium Discount"), (0, "Low Discount")],
                "No Discount",
                strict=True,
            ),
            "delivery_performance": first_true(
                [
                    (delivered & (delay <= 0), "On Time"),
                    (delivered & (delay > 0), "Late"),
                    (delivered & delay.isNull(), "Delivered"),
                ],
                "In Progress",
            ),
            "actual_delivery_days": days_between("order_date", "actual_delivery"),
            "expected_delivery_days": days_between("order_date", "expected_delivery"),
            "delivery_delay_days": delay,
            **{name: F.round(name, 2) for name in ("unit_price", "total_amount", "discounted_amount")},
            "discount_rate": F.round("discount_rate", 4),
            **{name: clean_upper(name) for name in ("order_status", "payment_terms", "shipping_method")},
        }
    )
    return _finish(
        cleaned,
        "silver_orders",
        {
            "has_negative_quantity": flag(F.col("quantity") < 0),
            "has_negative_unit_price": flag(F.col("unit_price") < 0),
            "has_negative_total_amount": flag(F.col("total_amount") < 0),
            "has_invalid_discount_rate": flag((F.col("discount_rate") < 0) | (F.col("discount_rate") > 1)),
            "has_negative_delivery_days": flag(F.col("actual_delivery_days") < 0),
        },
        ("order_id", "customer_id", "product_id"),
        audit,
    )


def silver_inventory(bronze: DataFrame, as_of: str, audit: bool = True) -> DataFrame:
    stock, reorder, full = F.col("current_stock"), F.col("reorder_level"), F.col("max_stock")
    days_left = days_between(as_date(as_of), "expiry_date")
    percentage = F.when(full > 0, F.round(stock / full * 100, 2)).otherwise(F.lit(0.0))
    cleaned = bronze.withColumns(
        {
            "storage_location": clean_upper("storage_location"),
            "movement_type": clean_upper("movement_type"),
            "cost_per_unit": F.round("cost_per_unit", 2),
            "days_until_expiry": days_left,
            "stock_percentage": percentage,
            "stock_to_reorder_ratio": F.when(reorder > 0, F.round(stock / reorder, 2)),
            "days_since_last_restock": days_between("last_restocked", as_date(as_of)),
            "stock_status": first_true(
                [
                    (stock <= reorder, "Critical Stock"),
                    (stock <= reorder * F.lit(1.5), "Low Stock"),
                    (stock >= full * F.lit(0.8), "High Stock"),
                ],
                "Normal Stock",
            ),
            "expiry_status": first_true(
                [
                    (days_left <= EXPIRY_WARNING_DAYS, "Expiring Soon"),
                    (days_left <= EXPIRY_WARNING_DAYS * 2, "Approaching Expiry"),
                ],
                "Fresh Stock",
            ),
            "stock_level_tier": tier(
                percentage, [(80, "Overstocked"), (50, "Well Stocked"), (20, "Low Stock")], "Critical Stock"
            ),
            "reorder_alert": flag(stock <= reorder),
            "expiry_alert": flag(days_left <= EXPIRY_WARNING_DAYS),
            "low_stock_alert": flag(percentage <= F.lit(REORDER_ALERT_THRESHOLD * 100)),
        }
    )
    return _finish(
        cleaned,
        "silver_inventory",
        {
            "has_negative_stock": flag(stock < 0),
            "has_negative_reorder_level": flag(reorder < 0),
            "has_negative_max_stock": flag(full < 0),
            "has_future_restock_date": flag(F.col("days_since_last_restock") < 0),
        },
        ("inventory_id", "pharmacy_id", "product_id"),
        audit,
        extra_flags={"has_expired_product": flag(days_left < 0)},
    )


def _vocabulary(value: Column, words: Mapping[str, object], otherwise: object) -> Column:
    return first_true([(value == word, label) for word, label in words.items()], otherwise)


def silver_supply_chain_events(
    bronze: DataFrame, as_of: str, audit: bool = True, compat: bool = False
) -> DataFrame:
    """``as_of`` is the last accepted moment: later events are rejected."""
    status = F.col("status") if compat else clean_upper("status")
    kind = F.col("event_type") if compat else clean_upper("event_type")
    cleaned = bronze.withColumns(
        {
            "event_type": clean_upper("event_type"),
            "location": clean_upper("location"),
            "status": clean_upper("status"),
            "status_priority": _vocabulary(status, STATUS_PRIORITY, 5).cast("bigint"),
            "event_category": first_true(
                [(kind.isin(words), label) for label, words in EVENT_CATEGORIES.items()], "Other"
            ),
            "status_description": _vocabulary(status, STATUS_DESCRIPTION, "Unknown"),
        }
    ).drop("temperature")
    return _finish(
        cleaned,
        "silver_supply_chain_events",
        {"has_future_timestamp": flag(F.col("event_timestamp") > F.lit(as_of).cast("timestamp_ntz"))},
        ("event_id", "order_id", "event_type"),
        audit,
    )


def _known(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key exists in the parent; a repeated parent key repeats nothing."""
    return df.join(parent.select(F.col(parent_key).alias(key)), key, "left_semi")


def silver_reco_interactions(bronze: DataFrame, bronze_products: DataFrame, audit: bool = True) -> DataFrame:
    action = clean_lower(F.col("action_type").cast("string"))
    for spelling, name in ACTION_ALIASES.items():
        action = F.when(action == spelling, F.lit(name)).otherwise(action)
    rows = not_null_filter(
        bronze.withColumnRenamed("timestamp", "interaction_timestamp"),
        "interaction_id",
        "customer_id",
        "product_id",
        "interaction_timestamp",
    )
    columns = ["interaction_id", "customer_id", "product_id", action.alias("action_type")]
    columns += ["interaction_timestamp", "session_id"]
    columns += [c for c in ("bronze_processed_at",) if c in bronze.columns]
    return _stamp(
        _known(rows, "product_id", bronze_products, "product_id").select(*columns),
        "silver_reco_interactions",
        audit,
    )


def silver_reco_substitutions(
    bronze: DataFrame, bronze_orders: DataFrame, bronze_products: DataFrame, audit: bool = True
) -> DataFrame:
    rows = not_null_filter(
        bronze, "substitution_id", "order_id", "requested_product_id", "substituted_product_id"
    )
    for role in ("requested_product_id", "substituted_product_id"):
        rows = _known(rows, role, bronze_products, "product_id")
    rows = _known(rows, "order_id", bronze_orders, "order_id")
    columns = [
        "substitution_id",
        "order_id",
        "requested_product_id",
        "substituted_product_id",
        clean_lower(F.col("reason").cast("string")).alias("reason"),
        "customer_accepted",
        F.round(F.col("margin_delta").cast("double"), 4).alias("margin_delta"),
        F.col("timestamp").alias("substitution_timestamp"),
    ]
    columns += [c for c in ("bronze_processed_at",) if c in bronze.columns]
    return _stamp(rows.select(*columns), "silver_reco_substitutions", audit)


def _stamp(df: DataFrame, model: str, audit: bool) -> DataFrame:
    stamps = {"silver_model_name": F.lit(model)}
    if audit:
        stamps = {"silver_processed_at": F.current_timestamp(), **stamps}
    return df.withColumns(stamps)
