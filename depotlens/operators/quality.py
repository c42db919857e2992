"""Data-quality checks. Each returns the violating rows; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.functions.columns import as_date, count_when
from depotlens.operators.joins import anti_join_fk, anti_join_polymorphic


def dq_unique(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def dq_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def dq_accepted_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    return df.filter(~F.col(column).isin(list(values)))


def dq_accepted_range(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None
) -> DataFrame:
    return df.filter(_outside(column, low, high))


def _outside(column: str, low: object = None, high: object = None) -> Column:
    test = F.lit(False)
    if low is not None:
        test = test | (F.col(column) < F.lit(low))
    if high is not None:
        test = test | (F.col(column) > F.lit(high))
    return test


def dq_valid_date_range(
    df: DataFrame, column: str, start: str = "1900-01-01", end: str = "2100-12-31"
) -> DataFrame:
    return df.filter((F.col(column) < as_date(start)) | (F.col(column) > as_date(end)))


def dq_positive_value(df: DataFrame, column: str) -> DataFrame:
    return dq_accepted_range(df, column, 0)


def dq_valid_percentage(df: DataFrame, column: str) -> DataFrame:
    return dq_accepted_range(df, column, 0, 100)


def dq_valid_rate(df: DataFrame, column: str) -> DataFrame:
    return dq_accepted_range(df, column, 0, 1)


def dq_referential(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str, null_aware: bool = False
) -> DataFrame:
    """Keys of child rows without a parent, one row per child row."""
    return anti_join_fk(child.select(key), key, parent, parent_key, null_aware)


def dq_polymorphic_fk(
    child: DataFrame, key: str, parents: Sequence[tuple[DataFrame, str]]
) -> DataFrame:
    return anti_join_polymorphic(child.select(key), key, parents)


def dq_combined(
    df: DataFrame,
    column: str,
    low: float | None = None,
    high: float | None = None,
    not_null: bool = True,
) -> DataFrame:
    """Null, too low and too high values in one scan; ``rule`` names the broken rule."""
    rules = [F.when(F.col(column).isNull(), F.lit("not_null"))] if not_null else []
    if low is not None:
        rules.append(F.when(F.col(column) < F.lit(low), F.lit("min_value")))
    if high is not None:
        rules.append(F.when(F.col(column) > F.lit(high), F.lit("max_value")))
    return df.withColumn("rule", F.explode(F.array_compact(F.array(*rules))))


# The accepted words and ranges of the raw tables.
STATES = ["NSW", "VIC", "QLD", "WA", "SA", "TAS", "ACT", "NT"]
CUSTOMER_TYPES = ["Pharmacy", "Hospital"]
EVENT_STATUSES = ["Success", "Warning", "Error", "Pending"]


@dataclass(frozen=True)
class TableRules:
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: tuple[tuple[str, tuple[str, ...]], ...] = ()
    ranges: tuple[tuple[str, float | None, float | None], ...] = ()


# Which rules apply to which raw table.
RAW_RULES = {
    "pharmacies": TableRules(
        unique=("pharmacy_id",),
        not_null=("pharmacy_id", "name", "state", "is_chain", "monthly_revenue"),
        accepted=(("state", tuple(STATES)),),
        ranges=(("monthly_revenue", 0, 1_000_000),),
    ),
    "hospitals": TableRules(
        unique=("hospital_id",),
        not_null=("hospital_id", "name", "hospital_type", "state", "beds"),
        accepted=(("state", tuple(STATES)),),
        ranges=(("beds", 1, 2000),),
    ),
    "products": TableRules(
        unique=("product_id",),
        not_null=("product_id", "name", "category", "unit_price", "is_prescription"),
        ranges=(("unit_price", 0, 10_000),),
    ),
    "orders": TableRules(
        unique=("order_id",),
        not_null=(
            "order_id",
            "customer_id",
            "customer_type",
            "product_id",
            "order_date",
            "quantity",
            "total_amount",
        ),
        accepted=(("customer_type", tuple(CUSTOMER_TYPES)),),
        ranges=(("quantity", 1, 1000), ("total_amount", 0, 100_000)),
    ),
    "inventory": TableRules(
        unique=("inventory_id",),
        not_null=("inventory_id", "pharmacy_id", "product_id", "current_stock", "reorder_level"),
        ranges=(("current_stock", 0, 10_000), ("reorder_level", 0, 1000)),
    ),
    "supply_chain_events": TableRules(
        unique=("event_id",),
        not_null=("event_id", "order_id", "event_type", "event_timestamp", "status"),
        accepted=(("status", tuple(EVENT_STATUSES)),),
    ),
}

# Child table, child key, parent table, parent key.
FOREIGN_KEYS = [
    ("orders", "product_id", "products", "product_id"),
    ("inventory", "pharmacy_id", "pharmacies", "pharmacy_id"),
    ("inventory", "product_id", "products", "product_id"),
    ("supply_chain_events", "order_id", "orders", "order_id"),
    ("products", "supplier_id", "suppliers", "supplier_id"),
    ("product_interactions", "product_id", "products", "product_id"),
    ("substitution_events", "order_id", "orders", "order_id"),
    ("substitution_events", "requested_product_id", "products", "product_id"),
    ("substitution_events", "substituted_product_id", "products", "product_id"),
    ("inventory_availability", "product_id", "products", "product_id"),
    ("inventory_availability", "warehouse_id", "warehouses", "warehouse_id"),
    ("expiry_batches", "product_id", "products", "product_id"),
    ("expiry_batches", "warehouse_id", "warehouses", "warehouse_id"),
    ("writeoff_events", "product_id", "products", "product_id"),
    ("writeoff_events", "warehouse_id", "warehouses", "warehouse_id"),
    ("purchase_orders", "supplier_id", "suppliers", "supplier_id"),
    ("purchase_orders", "product_id", "products", "product_id"),
    ("supplier_performance", "supplier_id", "suppliers", "supplier_id"),
    ("supplier_performance", "product_id", "products", "product_id"),
    ("warehouse_costs", "warehouse_id", "warehouses", "warehouse_id"),
    ("warehouse_costs", "product_id", "products", "product_id"),
    ("store_sales", "store_id", "pharmacies", "pharmacy_id"),
    ("store_sales", "product_id", "products", "product_id"),
    ("store_attributes", "store_id", "pharmacies", "pharmacy_id"),
    ("promotions", "store_id", "pharmacies", "pharmacy_id"),
    ("promotions", "product_id", "products", "product_id"),
]


def _verdict(df: DataFrame) -> DataFrame:
    return df.withColumn("status", F.when(F.col("failures") > 0, F.lit("fail")).otherwise(F.lit("pass")))


def row_rule_report(df: DataFrame, table: str, rules: TableRules) -> DataFrame:
    """All row rules of a table, counted in one scan."""
    checks: dict[str, Column] = {}
    for column in rules.not_null:
        checks[f"{table}.{column}.not_null"] = F.col(column).isNull()
    for column, values in rules.accepted:
        checks[f"{table}.{column}.accepted_values"] = ~F.col(column).isin(list(values))
    for column, low, high in rules.ranges:
        checks[f"{table}.{column}.accepted_range"] = _outside(column, low, high)
    names = list(checks)
    counted = df.agg(*[count_when(checks[name]).alias(f"c{i}") for i, name in enumerate(names)])
    entries = [F.struct(F.lit(name).alias("check"), F.col(f"c{i}").alias("failures")) for i, name in enumerate(names)]
    return counted.select(F.inline(F.array(*entries)))


def dq_report(
    tables: Mapping[str, DataFrame],
    rules: Mapping[str, TableRules] = RAW_RULES,
    foreign_keys: Sequence[tuple[str, str, str, str]] = tuple(FOREIGN_KEYS),
) -> DataFrame:
    """One row per check of the given tables: name, failing rows (or keys), pass or fail."""
    parts = []
    for table, wanted in rules.items():
        if table not in tables:
            continue
        parts.append(row_rule_report(tables[table], table, wanted))
        for key in wanted.unique:
            parts.append(_failures(dq_unique(tables[table], key), f"{table}.{key}.unique"))
    for child, key, parent, parent_key in foreign_keys:
        if child in tables and parent in tables:
            parts.append(
                _orphans(tables[child], key, tables[parent], parent_key, f"{child}.{key}.references_{parent}")
            )
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return _verdict(report)


def _orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Number of child rows without a parent; a key that many rows share travels once per task."""
    counts = child.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    missing = anti_join_fk(counts, key, parent, parent_key)
    failures = F.coalesce(F.sum("_rows"), F.lit(0).cast("bigint"))
    return missing.agg(failures.alias("failures")).select(F.lit(name).alias("check"), "failures")


def _failures(violations: DataFrame, name: str) -> DataFrame:
    return violations.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check"), "failures")
