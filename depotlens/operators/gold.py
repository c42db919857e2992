"""Gold layer: KPI tables over silver tables.

Facts are aggregated to the grain of the report before any join, so that no join repeats fact rows
and a hot customer or product is reduced on the map side. Sums of money are rounded to the decimals
their inputs carry, which makes every measure independent of row order and of task retries. Reports
with distinct counts read their fact table twice, so give them stored silver tables.

Volume and value labels are compared as silver writes them; ``compat=True`` compares them with their
upper-case spelling instead, which matches nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.functions.columns import (
    as_date,
    as_int_flag,
    avg_exact,
    count_when,
    days_between,
    first_true,
    flag,
    guarded_ratio,
    month_start,
    sum_exact,
    sum_when,
    tier,
)
from depotlens.operators.silver import EVENT_CATEGORIES


def _labelled(name: str, label: str, compat: bool) -> Column:
    return F.col(name) == (label.upper() if compat else label)


def _zero(name: str, value: object = 0) -> Column:
    return F.coalesce(F.col(name), F.lit(value).cast("double" if isinstance(value, float) else "bigint"))


def _grouped(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Column],
    distinct: Mapping[str, Column | str],
    values: DataFrame | None = None,
) -> DataFrame:
    """Measures and distinct counts per group, computed apart and joined on the group.

    The distinct values come from ``values`` where measures are summed from an aggregate already.

    In one aggregate Spark would shuffle a row with room for every measure per distinct value. Apart,
    the measures are reduced on the map side and only (group, value) pairs travel for the counts.
    Both sides are partitioned by the keys already. Groups with NULL keys are matched as well.
    """
    source = df if values is None else values
    counts = source.groupBy(*keys).agg(*[F.countDistinct(value).alias(name) for name, value in distinct.items()])
    counts = counts.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = F.lit(True)
    nullable = {f.name for f in df.schema.fields if f.nullable}
    for k in keys:
        # Entity keys are never NULL after silver; report labels may be.
        exact = k not in nullable or k.endswith("_id")
        same = same & (F.col(k) == F.col(f"_{k}") if exact else F.col(k).eqNullSafe(F.col(f"_{k}")))
    sums = df.groupBy(*keys).agg(*measures)
    return sums.join(counts, same).drop(*[f"_{k}" for k in keys])


def _gold(df: DataFrame, model: str, audit: bool) -> DataFrame:
    stamps = {"gold_model_name": F.lit(model)}
    if audit:
        stamps = {"gold_processed_at": F.current_timestamp(), **stamps}
    return df.withColumns(stamps)


DISCOUNT_STEPS = (0.1, 0.05)


def _discount_tier(rate: Column | str, suffix: str) -> Column:
    subject = F.col(rate) if isinstance(rate, str) else rate
    return first_true(
        [
            (subject >= DISCOUNT_STEPS[0], f"High Discount{suffix}"),
            (subject >= DISCOUNT_STEPS[1], f"Medium Discount{suffix}"),
            (subject > 0, f"Low Discount{suffix}"),
        ],
        f"No Discount{suffix}",
    )


# --- financial analytics -----------------------------------------------------------------


def _partial_financials(orders: DataFrame, compat: bool) -> DataFrame:
    """Sums and counts by month, customer type and product, from which the report's measures follow."""
    cut = F.col("discount_rate") > 0
    added = {
        "quantity": F.col("quantity"),
        "gross": F.col("total_amount"),
        "net": F.col("discounted_amount"),
        "saved": F.col("total_amount") - F.col("discounted_amount"),
        "rate": F.col("discount_rate"),
        "cut_gross": F.when(cut, F.col("total_amount")),
        "cut_rate": F.when(cut, F.col("discount_rate")),
    }
    volumes = {level: _labelled("volume_tier", f"{level} Volume", compat) for level in ("High", "Medium", "Low")}
    return orders.groupBy(month_start("order_date").alias("order_month"), "customer_type", "product_id").agg(
        *[F.sum(c).alias(f"{name}_sum") for name, c in added.items()],
        *[F.count(c).alias(f"{name}_n") for name, c in added.items()],
        *[sum_when(c, "quantity").alias(f"{level}_sum") for level, c in volumes.items()],
    )


def monthly_financials(orders: DataFrame, products: DataFrame, compat: bool = False) -> DataFrame:
    """Month x customer type x product category x price tier.

    Order lines are summed by product before they meet the products; beside that only distinct
    (product, order) and (product, customer) values are read, in one pass.
    """
    kinds = products.select(
        "product_id",
        F.col("category").alias("product_category"),
        F.col("price_tier").alias("product_price_tier"),
    )
    keys = ("order_month", "customer_type", "product_category", "product_price_tier")
    sums = _partial_financials(orders, compat).join(kinds, "product_id", "left")

    def total(name: str, scale: int = 2) -> Column:
        return F.round(F.sum(f"{name}_sum"), scale)

    def mean(name: str, scale: int = 2) -> Column:
        return F.try_divide(total(name, scale), F.sum(f"{name}_n").cast("double"))

    measures = [
        F.sum("quantity_sum").alias("total_quantity"),
        total("gross").alias("gross_revenue"),
        total("net").alias("net_revenue"),
        total("saved").alias("total_discount_amount"),
        mean("gross").alias("avg_gross_order_value"),
        mean("net").alias("avg_net_order_value"),
        mean("rate", 4).alias("avg_discount_rate"),
        F.try_divide(F.sum("quantity_sum").cast("double"), F.sum("quantity_n").cast("double")).alias("avg_quantity_per_order"),
        *[F.sum(f"{level}_sum").alias(f"{level.lower()}_volume_quantity") for level in ("High", "Medium", "Low")],
        F.sum("cut_rate_n").alias("discounted_orders"),
        F.coalesce(total("cut_gross"), F.lit(0.0)).alias("discounted_order_value"),
        mean("cut_rate", 4).alias("avg_discount_rate_when_discounted"),
        F.count("product_id").alias("unique_products"),
    ]
    values = orders.select(
        month_start("order_date").alias("order_month"), "customer_type", "product_id", "order_id", "customer_id"
    ).join(kinds, "product_id", "left")
    distinct = {"total_orders": "order_id", "unique_customers": "customer_id"}
    return _grouped(sums, keys, measures, distinct, values)


def gold_financial_analytics(
    orders: DataFrame, products: DataFrame, audit: bool = True, compat: bool = False
) -> DataFrame:
    report = monthly_financials(orders, products, compat).drop("avg_quantity_per_order")
    return _gold(
        report.withColumns(
            {
                "discount_percentage": guarded_ratio("discounted_orders", "total_orders", 2, 100),
                "discount_impact_percentage": guarded_ratio("total_discount_amount", "gross_revenue", 2, 100),
                "revenue_per_unit": guarded_ratio("gross_revenue", "total_quantity"),
                "revenue_per_customer": guarded_ratio("gross_revenue", "unique_customers"),
                "monthly_revenue_tier": tier(
                    "gross_revenue",
                    [
                        (100_000, "High Revenue Month"),
                        (50_000, "Medium Revenue Month"),
                        (10_000, "Low Revenue Month"),
                    ],
                    "Minimal Revenue Month",
                ),
                "monthly_discount_tier": _discount_tier("avg_discount_rate", " Month"),
            }
        ),
        "gold_financial_analytics",
        audit,
    )


def customer_financials(orders: DataFrame) -> DataFrame:
    totals = _grouped(
        orders,
        ("customer_id", "customer_type"),
        [
            sum_exact("total_amount").alias("lifetime_gross_revenue"),
            sum_exact("discounted_amount").alias("lifetime_net_revenue"),
            sum_exact(F.col("total_amount") - F.col("discounted_amount")).alias("lifetime_discount_amount"),
            avg_exact("total_amount").alias("avg_order_value"),
            avg_exact("discount_rate", 4).alias("avg_discount_rate"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        ],
        {"total_orders": "order_id", "active_months": month_start("order_date")},
    )
    return totals.withColumns(
        {
            "customer_value_tier": tier(
                "lifetime_gross_revenue",
                [(100_000, "High Value"), (50_000, "Medium Value"), (10_000, "Low Value")],
                "Minimal Value",
            ),
            "discount_behavior_tier": _discount_tier("avg_discount_rate", " User"),
        }
    )


def product_financials(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Sales per product; a product's profit is its margin times the units sold."""
    sales = _grouped(
        orders,
        ("product_id",),
        [
            F.sum("quantity").alias("total_quantity_sold"),
            F.avg("quantity").alias("_avg_quantity"),
            sum_exact("total_amount").alias("gross_revenue"),
            sum_exact("discounted_amount").alias("net_revenue"),
            sum_exact(F.col("total_amount") - F.col("discounted_amount")).alias("total_discount_amount"),
            avg_exact("discount_rate", 4).alias("avg_discount_rate"),
        ],
        {"total_orders": "order_id", "unique_customers": "customer_id"},
    )
    attributes = products.select(
        "product_id",
        "product_name",
        "category",
        "price_tier",
        "unit_price",
        "wholesale_price",
        "retail_price",
        "profit_margin",
        "profit_margin_percentage",
    )
    revenue = F.col("gross_revenue")
    return (
        attributes.join(sales, "product_id", "left")
        .withColumns(
            {
                "total_orders": _zero("total_orders"),
                "unique_customers": _zero("unique_customers"),
                "total_profit": F.round(F.col("total_quantity_sold") * F.col("profit_margin"), 2),
                "avg_profit_per_order": F.round(F.col("_avg_quantity") * F.col("profit_margin"), 4),
                "revenue_tier": first_true(
                    [
                        (revenue >= 50_000, "High Revenue"),
                        (revenue >= 10_000, "Medium Revenue"),
                        (revenue > 0, "Low Revenue"),
                    ],
                    "No Sales",
                ),
                "discount_tier": _discount_tier("avg_discount_rate", ""),
            }
        )
        .drop("_avg_quantity")
    )


# --- pharmacy performance ----------------------------------------------------------------


def customer_type_filter(orders: DataFrame, customer_type: str = "PHARMACY") -> DataFrame:
    return orders.filter(F.col("customer_type") == customer_type)


def pharmacy_orders(orders: DataFrame) -> DataFrame:
    return _grouped(
        customer_type_filter(orders),
        ("customer_id", "customer_type"),
        [
            F.sum("quantity").alias("total_quantity_ordered"),
            sum_exact("total_amount").alias("total_order_value"),
            sum_exact("discounted_amount").alias("total_discounted_value"),
            avg_exact("total_amount").alias("avg_order_value"),
            avg_exact("discount_rate", 4).alias("avg_discount_rate"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        ],
        {
            "total_orders": "order_id",
            "unique_products_ordered": "product_id",
            "active_months": month_start("order_date"),
        },
    )


def pharmacy_inventory(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("pharmacy_id").agg(
        F.countDistinct("product_id").alias("total_products_in_stock"),
        F.sum("current_stock").alias("total_current_stock"),
        sum_exact(F.col("current_stock") * F.col("cost_per_unit")).alias("total_inventory_value"),
        count_when(F.col("reorder_alert")).alias("products_needing_reorder"),
        count_when(F.col("expiry_alert")).alias("products_expiring_soon"),
        avg_exact("stock_percentage").alias("avg_stock_percentage"),
    )


def gold_pharmacy_performance(
    pharmacies: DataFrame, orders: DataFrame, inventory: DataFrame, audit: bool = True
) -> DataFrame:
    sales = pharmacy_orders(orders).drop("customer_type", "first_order_date", "last_order_date")
    value, stocked = F.col("total_order_value"), F.col("avg_stock_percentage")
    joined = (
        pharmacies.select(
            "pharmacy_id",
            "pharmacy_name",
            "pharmacy_type",
            "state",
            "suburb",
            "years_in_operation",
            "revenue_tier",
            "customer_volume_tier",
            "monthly_revenue",
            "customer_count",
            "has_consultation_room",
            "has_vaccination_service",
        )
        .join(sales.withColumnRenamed("customer_id", "pharmacy_id"), "pharmacy_id", "left")
        .join(pharmacy_inventory(inventory), "pharmacy_id", "left")
    )
    # Ratios read the joined values, before missing ones become 0.
    report = joined.withColumns(
        {
            "revenue_per_order": guarded_ratio("total_order_value", "total_orders"),
            "revenue_per_customer": guarded_ratio("total_order_value", "customer_count"),
            "avg_quantity_per_order": guarded_ratio("total_quantity_ordered", "total_orders"),
            "reorder_percentage": guarded_ratio(
                "products_needing_reorder", "total_products_in_stock", 2, 100
            ),
            "expiry_risk_percentage": guarded_ratio(
                "products_expiring_soon", "total_products_in_stock", 2, 100
            ),
            "performance_tier": first_true(
                [
                    (value >= 100_000, "High Performer"),
                    (value >= 50_000, "Medium Performer"),
                    (value > 0, "Low Performer"),
                ],
                "No Orders",
            ),
            "inventory_health": first_true(
                [
                    (stocked >= 70, "Well Stocked"),
                    (stocked >= 30, "Adequately Stocked"),
                    (stocked > 0, "Under Stocked"),
                ],
                "No Inventory Data",
            ),
        }
    ).withColumns(
        {
            **{
                name: _zero(name)
                for name in (
                    "total_orders",
                    "total_quantity_ordered",
                    "unique_products_ordered",
                    "active_months",
                    "total_products_in_stock",
                    "total_current_stock",
                    "products_needing_reorder",
                    "products_expiring_soon",
                )
            },
            **{
                name: _zero(name, 0.0)
                for name in (
                    "total_order_value",
                    "total_discounted_value",
                    "avg_order_value",
                    "avg_discount_rate",
                    "total_inventory_value",
                    "avg_stock_percentage",
                )
            },
        }
    )
    return _gold(report, "gold_pharmacy_performance", audit)


# --- product performance -----------------------------------------------------------------


def product_orders(orders: DataFrame) -> DataFrame:
    return _grouped(
        orders,
        ("product_id",),
        [
            F.sum("quantity").alias("total_quantity_sold"),
            sum_exact("total_amount").alias("total_revenue"),
            sum_exact("discounted_amount").alias("total_discounted_revenue"),
            F.avg("quantity").alias("avg_quantity_per_order"),
            avg_exact("total_amount").alias("avg_order_value"),
            avg_exact("discount_rate", 4).alias("avg_discount_rate"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        ],
        {
            "total_orders": "order_id",
            "unique_customers": "customer_id",
            "active_months": month_start("order_date"),
            "customer_types_count": "customer_type",
        },
    )


def product_inventory(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("product_id").agg(
        F.countDistinct("pharmacy_id").alias("pharmacies_stocking"),
        F.sum("current_stock").alias("total_stock_across_pharmacies"),
        sum_exact(F.col("current_stock") * F.col("cost_per_unit")).alias("total_inventory_value"),
        F.avg("current_stock").alias("avg_stock_per_pharmacy"),
        avg_exact("stock_percentage").alias("avg_stock_percentage"),
        count_when(F.col("reorder_alert")).alias("pharmacies_needing_reorder"),
        count_when(F.col("expiry_alert")).alias("pharmacies_with_expiring_stock"),
        F.avg("days_until_expiry").alias("avg_days_until_expiry"),
    )


# Columns of the report, in its order.
PRODUCT_ATTRIBUTES = (
    "product_id",
    "product_name",
    "generic_name",
    "category",
    "manufacturer",
    "supplier",
    "regulatory_class",
    "price_tier",
    "storage_classification",
    "unit_price",
    "wholesale_price",
    "retail_price",
    "profit_margin",
    "profit_margin_percentage",
    "is_prescription",
    "is_controlled_substance",
    "requires_cold_chain",
    "expiry_months",
    "minimum_order_quantity",
    "lead_time_days",
)


def gold_product_performance(
    products: DataFrame, orders: DataFrame, inventory: DataFrame, audit: bool = True
) -> DataFrame:
    revenue, count = F.col("total_revenue"), F.col("total_orders")
    stocking, margin = F.col("pharmacies_stocking"), F.col("profit_margin_percentage")
    joined = (
        products.select(*PRODUCT_ATTRIBUTES)
        .join(product_orders(orders).drop("first_order_date", "last_order_date"), "product_id", "left")
        .join(product_inventory(inventory), "product_id", "left")
    )
    report = joined.withColumns(
        {
            "revenue_per_order": guarded_ratio("total_revenue", "total_orders"),
            "orders_per_customer": guarded_ratio("total_orders", "unique_customers"),
            "revenue_per_unit_sold": guarded_ratio("total_revenue", "total_quantity_sold"),
            "reorder_percentage": guarded_ratio("pharmacies_needing_reorder", "pharmacies_stocking", 2, 100),
            "expiry_risk_percentage": guarded_ratio(
                "pharmacies_with_expiring_stock", "pharmacies_stocking", 2, 100
            ),
            "revenue_tier": first_true(
                [
                    (revenue >= 50_000, "High Revenue"),
                    (revenue >= 10_000, "Medium Revenue"),
                    (revenue > 0, "Low Revenue"),
                ],
                "No Sales",
            ),
            "volume_tier": first_true(
                [(count >= 100, "High Volume"), (count >= 20, "Medium Volume"), (count > 0, "Low Volume")],
                "No Orders",
            ),
            "distribution_tier": first_true(
                [
                    (stocking >= 50, "Widely Stocked"),
                    (stocking >= 10, "Moderately Stocked"),
                    (stocking > 0, "Limited Stock"),
                ],
                "Not Stocked",
            ),
            "margin_tier": first_true(
                [(margin >= 50, "High Margin"), (margin >= 25, "Medium Margin"), (margin > 0, "Low Margin")],
                "No Margin Data",
            ),
            "avg_orders_per_month": guarded_ratio("total_orders", "active_months"),
            "avg_quantity_per_month": F.when(
                F.col("total_quantity_sold") > 0, guarded_ratio("total_quantity_sold", "active_months")
            ).otherwise(F.lit(0.0)),
        }
    ).withColumns(
        {
            **{
                name: _zero(name)
                for name in (
                    "total_orders",
                    "unique_customers",
                    "total_quantity_sold",
                    "active_months",
                    "customer_types_count",
                    "pharmacies_stocking",
                    "total_stock_across_pharmacies",
                    "pharmacies_needing_reorder",
                    "pharmacies_with_expiring_stock",
                )
            },
            **{
                name: _zero(name, 0.0)
                for name in (
                    "total_revenue",
                    "total_discounted_revenue",
                    "avg_quantity_per_order",
                    "avg_order_value",
                    "avg_discount_rate",
                    "total_inventory_value",
                    "avg_stock_per_pharmacy",
                    "avg_stock_percentage",
                    "avg_days_until_expiry",
                )
            },
        }
    )
    return _gold(report, "gold_product_performance", audit)


# --- supply chain ------------------------------------------------------------------------


def order_fulfillment(orders: DataFrame) -> DataFrame:
    delivered = F.col("order_status") == "DELIVERED"
    return orders.select(
        "order_id",
        "customer_id",
        "customer_type",
        "product_id",
        "order_date",
        "expected_delivery",
        "actual_delivery",
        "order_status",
        "shipping_method",
        "total_amount",
        "quantity",
        "delivery_performance",
        "delivery_delay_days",
        "volume_tier",
        "order_value_tier",
        as_int_flag(delivered).alias("is_delivered"),
        as_int_flag(delivered & (F.col("delivery_delay_days") <= 0)).alias("is_on_time_delivery"),
        as_int_flag(F.col("order_status") == "CANCELLED").alias("is_cancelled"),
        as_int_flag(F.col("delivery_delay_days") > 7).alias("is_significantly_delayed"),
    )


def event_summary(events: DataFrame) -> DataFrame:
    """Per order: distinct events by status, first and last moment, rates in per cent.

    Rows are reduced to one per event first; statuses and categories are small fixed vocabularies, so
    their distinct counts are sums of flags.
    """

    def seen(condition: Column) -> Column:
        return F.max(F.when(condition, 1).otherwise(0).cast("bigint"))

    statuses = {"successful_events": "SUCCESS", "failed_events": "ERROR", "warning_events": "WARNING"}
    categories = [*EVENT_CATEGORIES, "Other"]
    per_event = events.groupBy("order_id", "event_id").agg(
        *[seen(F.col("status") == status).alias(name) for name, status in statuses.items()],
        *[seen(F.col("event_category") == c).alias(f"_category_{i}") for i, c in enumerate(categories)],
        F.min("event_timestamp").alias("_first"),
        F.max("event_timestamp").alias("_last"),
    )
    kinds = [F.max(f"_category_{i}") for i in range(len(categories))]
    counts = per_event.groupBy("order_id").agg(
        F.count("event_id").alias("total_events"),
        *[F.sum(name).alias(name) for name in statuses],
        F.min("_first").alias("first_event_timestamp"),
        F.max("_last").alias("last_event_timestamp"),
        sum(kinds[1:], kinds[0]).alias("event_categories_count"),
    )
    return counts.withColumns(
        {
            "event_success_rate": guarded_ratio("successful_events", "total_events", 2, 100),
            "event_failure_rate": guarded_ratio("failed_events", "total_events", 2, 100),
            "event_warning_rate": guarded_ratio("warning_events", "total_events", 2, 100),
        }
    )


def monthly_fulfillment(orders: DataFrame) -> DataFrame:
    """Per month: distinct orders by outcome, value, mean delay, customers and products.

    Lines are reduced to one row per month and order first, which makes the order counts sums of flags.
    """
    outcomes = {
        "delivered_orders": "is_delivered",
        "on_time_orders": "is_on_time_delivery",
        "cancelled_orders": "is_cancelled",
        "significantly_delayed_orders": "is_significantly_delayed",
    }
    lines = order_fulfillment(orders).withColumn("order_month", month_start("order_date"))
    per_order = lines.groupBy("order_month", "order_id").agg(
        *[F.max(column).alias(name) for name, column in outcomes.items()],
        sum_exact("total_amount").alias("_value"),
        F.sum("delivery_delay_days").alias("_delay"),
        F.count("delivery_delay_days").alias("_delays"),
    )
    totals = per_order.groupBy("order_month").agg(
        F.count("order_id").alias("total_orders"),
        *[F.sum(name).alias(name) for name in outcomes],
        sum_exact("_value").alias("total_order_value"),
        F.try_divide(F.sum("_delay").cast("double"), F.sum("_delays").cast("double")).alias(
            "avg_delivery_delay_days"
        ),
    )
    people = lines.groupBy(F.col("order_month").alias("_month")).agg(
        F.countDistinct("customer_id").alias("unique_customers"),
        F.countDistinct("product_id").alias("unique_products"),
    )
    return totals.join(people, F.col("order_month").eqNullSafe(F.col("_month"))).drop("_month")


def gold_supply_chain_performance(orders: DataFrame, events: DataFrame, audit: bool = True) -> DataFrame:
    delay, failing = F.col("delivery_delay_days"), F.col("event_failure_rate")
    success = F.col("event_success_rate")
    delivered = F.col("is_delivered") == 1
    report = (
        order_fulfillment(orders)
        .join(event_summary(events), "order_id", "left")
        .withColumns(
            {
                "fulfillment_duration_hours": days_between("first_event_timestamp", "last_event_timestamp") * 24,
                "overall_performance": first_true(
                    [
                        (delivered & (F.col("is_on_time_delivery") == 1), "Excellent"),
                        (delivered & (delay <= 2), "Good"),
                        (delivered & (delay <= 7), "Fair"),
                        (delivered, "Poor"),
                        (F.col("is_cancelled") == 1, "Cancelled"),
                    ],
                    "In Progress",
                ),
                "reliability_tier": first_true(
                    [
                        (success >= 90, "High Reliability"),
                        (success >= 70, "Medium Reliability"),
                        (success > 0, "Low Reliability"),
                    ],
                    "No Event Data",
                ),
                "risk_level": first_true(
                    [
                        ((F.col("is_significantly_delayed") == 1) | (failing > 20), "High Risk"),
                        ((delay > 3) | (failing > 10), "Medium Risk"),
                        ((delay > 0) | (failing > 0), "Low Risk"),
                    ],
                    "No Risk",
                ),
                **{
                    name: _zero(name)
                    for name in (
                        "total_events",
                        "successful_events",
                        "failed_events",
                        "warning_events",
                        "event_categories_count",
                    )
                },
            }
        )
    )
    return _gold(report, "gold_supply_chain_performance", audit)


# --- machine-learning features -----------------------------------------------------------


def _order_cells(orders: DataFrame, compat: bool) -> DataFrame:
    """Sums, counts and days by customer, type, product and month, from which both sides' features follow.

    All measures sit in one array of doubles (counts and sums of whole numbers are exact below 2**53), so
    the customer side, the product side and the pairs all ask for whole cells: the shuffle of the cells is
    then the same in each, and Spark runs it once. Keys come beside them; a hot customer or product is
    reduced on the map side.
    """
    cut = F.col("discount_rate") > 0
    day = F.unix_date("order_date")
    measures = {
        "lines": F.count(F.lit(1)),
        "quantities": F.count("quantity"),
        "totals": F.count("total_amount"),
        "rates": F.count("discount_rate"),
        "cuts": count_when(cut),
        **{f"{level} Volume": count_when(_labelled("volume_tier", f"{level} Volume", compat)) for level in ("High", "Medium", "Low")},
        **{f"{level} Value": count_when(_labelled("order_value_tier", f"{level} Value", compat)) for level in ("High", "Medium", "Low")},
        "quantity": F.sum("quantity"),
        "first": F.min(day),
        "last": F.max(day),
        "total": F.sum("total_amount"),
        "net": F.sum("discounted_amount"),
        "rate": F.sum("discount_rate"),
        "cut_rate": F.sum(F.when(cut, F.col("discount_rate"))),
    }
    assert tuple(measures) == _CELL_MEASURES
    keys = ("customer_id", "customer_type", "product_id", month_start("order_date").alias("order_month"))
    return orders.groupBy(*keys).agg(F.array(*[c.cast("double") for c in measures.values()]).alias("measures"))


# Order of the measures of a cell.
_CELL_MEASURES = (
    "lines",
    "quantities",
    "totals",
    "rates",
    "cuts",
    "High Volume",
    "Medium Volume",
    "Low Volume",
    "High Value",
    "Medium Value",
    "Low Value",
    "quantity",
    "first",
    "last",
    "total",
    "net",
    "rate",
    "cut_rate",
)


def _of_cell(name: str) -> Column:
    return F.get("measures", F.lit(_CELL_MEASURES.index(name)))


def _cell_count(name: str) -> Column:
    return F.sum(_of_cell(name)).cast("bigint")


def _cell_sum(name: str, scale: int = 2) -> Column:
    return F.round(F.sum(_of_cell(name)), scale)


def _cell_mean(name: str, held: str, scale: int = 2) -> Column:
    return F.try_divide(_cell_sum(name, scale), F.sum(_of_cell(held)))


def _cell_day(bound: Callable[[Column], Column], name: str) -> Column:
    return F.date_from_unix_date(bound(_of_cell(name)).cast("int"))


def _by_key(
    cells: DataFrame,
    orders: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Column],
    distinct: Mapping[str, str],
) -> DataFrame:
    """Measures and distinct values of the cells by key, and ``total_orders``, which alone needs the lines."""
    held = cells.where(_of_cell("lines") > 0)
    parts = [
        held.groupBy(*keys).agg(*[F.countDistinct(value).alias(name) for name, value in distinct.items()]),
        orders.groupBy(*keys).agg(F.countDistinct("order_id").alias("total_orders")),
    ]
    found = cells.groupBy(*keys).agg(*measures)
    for part in parts:
        other = part.withColumnsRenamed({k: f"_{k}" for k in keys})
        same = F.lit(True)
        for k in keys:
            # Entity keys are never NULL after silver; a customer type may be.
            same = same & (F.col(k) == F.col(f"_{k}") if k.endswith("_id") else F.col(k).eqNullSafe(F.col(f"_{k}")))
        found = found.join(other, same).drop(*[f"_{k}" for k in keys])
    return found


def _value_score(revenue: Column, steps: tuple[int, int, int, int]) -> Column:
    return tier(revenue, list(zip(steps, (5, 4, 3, 2))), 1).cast("bigint")


def customer_features(orders: DataFrame, as_of: str, compat: bool = False) -> DataFrame:
    return _customer_features(_order_cells(orders, compat), orders, as_of)


def _customer_features(cells: DataFrame, orders: DataFrame, as_of: str) -> DataFrame:
    labels = [f"{level} {kind}" for kind in ("Volume", "Value") for level in ("High", "Medium", "Low")]
    return (
        _by_key(
            cells,
            orders,
            ("customer_id", "customer_type"),
            [
                _cell_count("quantity").alias("total_quantity_ordered"),
                _cell_sum("total").alias("total_order_value"),
                _cell_sum("net").alias("total_discounted_value"),
                _cell_mean("total", "totals").alias("avg_order_value"),
                _cell_mean("rate", "rates", 4).alias("avg_discount_rate"),
                _cell_day(F.min, "first").alias("first_order_date"),
                _cell_day(F.max, "last").alias("last_order_date"),
                *[_cell_count(label).alias(f"{label.lower().replace(' ', '_')}_orders") for label in labels],
                _cell_count("cuts").alias("discounted_orders"),
                _cell_mean("cut_rate", "cuts", 4).alias("avg_discount_when_discounted"),
            ],
            {"unique_products_ordered": "product_id", "active_months": "order_month"},
        )
        .withColumns(
            {
                "customer_age_days": days_between("first_order_date", as_date(as_of)),
                "days_since_last_order": days_between("last_order_date", as_date(as_of)),
                "orders_per_month": F.when(
                    F.col("total_orders") > 0,
                    F.try_divide(F.col("total_orders").cast("double"), F.col("active_months").cast("double")),
                ).otherwise(F.lit(0.0)),
                "customer_value_score": _value_score(
                    F.col("total_order_value"), (100_000, 50_000, 20_000, 5_000)
                ),
            }
        )
    )


# Columns of the report, in its order.
FEATURE_ATTRIBUTES = (
    "product_id",
    "product_name",
    "category",
    "price_tier",
    "regulatory_class",
    "storage_classification",
    "unit_price",
    "profit_margin_percentage",
    "is_prescription",
    "is_controlled_substance",
    "requires_cold_chain",
    "expiry_months",
    "minimum_order_quantity",
    "lead_time_days",
)


def product_features(orders: DataFrame, products: DataFrame, compat: bool = False) -> DataFrame:
    return _product_features(_order_cells(orders, compat), orders, products)


def _product_features(cells: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    sales = _by_key(
        cells,
        orders,
        ("product_id",),
        [
            _cell_count("quantity").alias("total_quantity_sold"),
            _cell_sum("total").alias("total_revenue"),
            F.try_divide(F.sum(_of_cell("quantity")), F.sum(_of_cell("quantities"))).alias("avg_quantity_per_order"),
            _cell_mean("total", "totals").alias("avg_order_value"),
            _cell_mean("rate", "rates", 4).alias("avg_discount_rate"),
            _cell_day(F.min, "first").alias("first_sale_date"),
            _cell_day(F.max, "last").alias("last_sale_date"),
            *[_cell_count(f"{level} Volume").alias(f"{level.lower()}_volume_orders") for level in ("High", "Medium", "Low")],
        ],
        {"unique_customers": "customer_id", "active_sale_months": "order_month"},
    )
    counts = (
        "total_orders",
        "unique_customers",
        "active_sale_months",
        "high_volume_orders",
        "medium_volume_orders",
        "low_volume_orders",
    )
    return (
        products.select(*FEATURE_ATTRIBUTES)
        .join(sales, "product_id", "left")
        .withColumns(
            {
                **{name: _zero(name) for name in counts},
                "product_performance_score": _value_score(
                    F.col("total_revenue"), (50_000, 20_000, 5_000, 1_000)
                ),
            }
        )
    )


def inventory_features(inventory: DataFrame) -> DataFrame:
    pct, days = F.col("stock_percentage"), F.col("days_until_expiry")
    return inventory.select(
        "pharmacy_id",
        "product_id",
        "current_stock",
        "reorder_level",
        "max_stock",
        "stock_percentage",
        "stock_to_reorder_ratio",
        "days_until_expiry",
        "days_since_last_restock",
        "stock_status",
        "expiry_status",
        "stock_level_tier",
        "reorder_alert",
        "expiry_alert",
        "low_stock_alert",
        first_true(
            [
                ((pct >= 80) & (days >= 90), 5),
                ((pct >= 60) & (days >= 60), 4),
                ((pct >= 40) & (days >= 30), 3),
                ((pct >= 20) & (days >= 15), 2),
            ],
            1,
        )
        .cast("bigint")
        .alias("inventory_health_score"),
    )


def related_pairs(orders: DataFrame, inventory: DataFrame) -> DataFrame:
    """Customer-product pairs with an order line or a stock row."""
    return _related(orders, inventory)


def _related(ordered: DataFrame, inventory: DataFrame) -> DataFrame:
    stocked = inventory.select(F.col("pharmacy_id").alias("customer_id"), "product_id")
    return ordered.select("customer_id", "product_id").unionByName(stocked).distinct()


# Measures whose customer and product versions share a name.
# Columns of the report, in its order.
_SHARED_MEASURES = (
    "total_orders",
    "unique_customers",
    "avg_order_value",
    "avg_discount_rate",
    "high_volume_orders",
    "medium_volume_orders",
    "low_volume_orders",
)


def gold_ml_ready_dataset(
    pairs: DataFrame | None,
    orders: DataFrame,
    products: DataFrame,
    inventory: DataFrame,
    as_of: str,
    audit: bool = True,
    compat: bool = False,
) -> DataFrame:
    """Customer, product and stock features of every given (customer_id, product_id) pair.

    The pairs are an input (None stands for ``related_pairs``, those with any activity), so the work
    grows with the pairs asked for and not with customers times products. The orders are read three
    times: whole for the cells that all measures and pairs come from, and two narrow columns for the
    distinct orders of each side. A filter of the products on their own key would reach the cells of their
    side and of the pairs, which are then made twice; stored products have none.
    """
    # Silver holds no unknown ids. Said here, no join adds it to its own copy of the cells.
    orders = orders.where(F.col("customer_id").isNotNull() & F.col("product_id").isNotNull())
    cells = _order_cells(orders, compat)
    if pairs is None:
        pairs = _related(cells.where(_of_cell("lines") > 0), inventory)
    customers = _customer_features(cells, orders, as_of).drop("first_order_date", "last_order_date")
    items = (
        _product_features(cells, orders, products)
        .drop("first_sale_date", "last_sale_date")
        .withColumnsRenamed({name: f"product_{name}" for name in _SHARED_MEASURES})
    )
    stock = inventory_features(inventory).withColumnRenamed("pharmacy_id", "customer_id")
    buyer, item = F.col("customer_value_score"), F.col("product_performance_score")
    # Stock first: it matches on the pair, by which distinct pairs are partitioned already. Products last: their
    # features are the widest and their texts the longest, and so do not travel with the pairs.
    first = ["customer_id", "product_id"]
    sides = [[c for c in side.columns if c not in first] for side in (stock, items, customers)]
    names = [*first, *sides[0], *sides[1], *sides[2]]
    report = (
        pairs.select("customer_id", "product_id")
        .join(stock, first, "left")
        .join(customers, "customer_id")
        .join(items, "product_id")
        .select(*[F.col(c) for c in names])
        .withColumns(
            {
                "is_churn_risk": as_int_flag(F.col("days_since_last_order") > 90),
                "needs_attention": as_int_flag(flag(F.col("reorder_alert")) | flag(F.col("expiry_alert"))),
                "customer_product_value_tier": first_true(
                    [
                        ((buyer >= 4) & (item >= 4), "High Value"),
                        ((buyer >= 3) & (item >= 3), "Medium Value"),
                    ],
                    "Low Value",
                ),
            }
        )
    )
    return _gold(report, "gold_ml_ready_dataset", audit)
