"""Checks of bronze, silver and gold tables."""

from __future__ import annotations

from checks.feeds_sql import query
from checks.layer_sql import (
    FULFILLMENT_COLUMNS,
    GOLD_ML,
    GOLD_PHARMACY,
    GOLD_PRODUCT,
    GOLD_SUPPLY,
    MONTHLY_FULFILLMENT,
    PRODUCT_FINANCIALS,
    financial,
)
from depotlens.operators import gold, silver
from depotlens.operators.bronze import BRONZE_MODELS, FIXED_PROJECTION, to_bronze
from depotlens.plans.medallion import Medallion
from depotlens.session import settle
from depotlens.sources.star_schema import AS_OF as TODAY
from depotlens.sources.star_schema import EVENTS_AS_OF as EVENTS_TODAY
from depotlens.sources.star_schema import StarSchemaFeeds

BRONZE_TABLES = list(BRONZE_MODELS)


def layers(feeds: StarSchemaFeeds, compat: bool = False) -> Medallion:
    out = Medallion(feeds, TODAY, audit=False, compat=compat)
    out.events = silver.silver_supply_chain_events(
        out.bronze("supply_chain_events"), EVENTS_TODAY, audit=False, compat=compat
    )
    return out


def _bronze(table: str):
    return lambda feeds: to_bronze(feeds[table], table, audit=False)


def _bronze_sql(table: str) -> str:
    renamed = FIXED_PROJECTION.get(table)
    columns = f"* RENAME (name AS {renamed})" if renamed else "*"
    return query(f"SELECT {columns}, '{BRONZE_MODELS[table]}' AS bronze_model_name FROM raw_{table}")


def _select(name: str) -> str:
    return query(f"SELECT * FROM {name}")


CHECKS = {
    **{BRONZE_MODELS[t]: (_bronze(t), _bronze_sql(t)) for t in BRONZE_TABLES},
    "silver_hospitals": (lambda f: layers(f).hospitals, _select("silver_hospitals")),
    "silver_pharmacies": (lambda f: layers(f).pharmacies, _select("silver_pharmacies")),
    "silver_products": (lambda f: layers(f).products, _select("silver_products")),
    "silver_orders": (lambda f: layers(f).orders, _select("silver_orders")),
    "silver_orders_literal": (lambda f: layers(f, True).orders, _select("literal_orders")),
    "silver_inventory": (lambda f: layers(f).inventory, _select("silver_inventory")),
    "silver_supply_chain_events": (lambda f: layers(f).events, _select("silver_events")),
    "silver_supply_chain_events_literal": (lambda f: layers(f, True).events, _select("literal_events")),
    "silver_reco_interactions": (lambda f: layers(f).interactions, _select("silver_interactions")),
    "silver_reco_substitutions": (lambda f: layers(f).substitutions, _select("silver_substitutions")),
    "monthly_financials": (
        lambda f: gold.monthly_financials(layers(f).stored_orders, layers(f).products),
        _select("monthly_table"),
    ),
    "gold_financial_analytics": (lambda f: layers(f).financial_analytics(), query(financial("monthly_table"))),
    "gold_financial_analytics_literal": (
        lambda f: layers(f, True).financial_analytics(),
        query(financial("literal_monthly_table")),
    ),
    "customer_financials": (lambda f: gold.customer_financials(layers(f).stored_orders), _select("customer_table")),
    "product_financials": (
        lambda f: gold.product_financials(layers(f).stored_orders, layers(f).products),
        query(PRODUCT_FINANCIALS),
    ),
    "pharmacy_orders": (lambda f: gold.pharmacy_orders(layers(f).stored_orders), _select("pharmacy_sales")),
    "pharmacy_inventory": (lambda f: gold.pharmacy_inventory(layers(f).inventory), _select("pharmacy_stock")),
    "gold_pharmacy_performance": (lambda f: layers(f).pharmacy_performance(), query(GOLD_PHARMACY)),
    "product_orders": (
        lambda f: gold.product_orders(layers(f).stored_orders),
        query(
            "SELECT * EXCLUDE (total_discount_amount, high_volume_orders, medium_volume_orders, low_volume_orders)"
            " FROM product_sales"
        ),
    ),
    "product_inventory": (lambda f: gold.product_inventory(layers(f).inventory), _select("product_stock")),
    "gold_product_performance": (lambda f: layers(f).product_performance(), query(GOLD_PRODUCT)),
    "order_fulfillment": (lambda f: gold.order_fulfillment(layers(f).orders), _select("fulfillment_table")),
    "event_summary": (lambda f: gold.event_summary(layers(f).events), _select("event_table")),
    "monthly_fulfillment": (
        lambda f: gold.monthly_fulfillment(settle(layers(f).orders.select(*FULFILLMENT_COLUMNS))),
        query(MONTHLY_FULFILLMENT),
    ),
    "gold_supply_chain_performance": (lambda f: layers(f).supply_chain_performance(), query(GOLD_SUPPLY)),
    "customer_features": (
        lambda f: gold.customer_features(layers(f).stored_orders, TODAY),
        _select("customer_feature_table"),
    ),
    "product_features": (
        lambda f: gold.product_features(layers(f).stored_orders, layers(f).products),
        _select("product_feature_table"),
    ),
    "inventory_features": (
        lambda f: gold.inventory_features(layers(f).inventory),
        _select("inventory_feature_table"),
    ),
    "gold_ml_ready_dataset": (lambda f: layers(f).ml_ready_dataset(), query(GOLD_ML)),
}
