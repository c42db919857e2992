"""Raw tables -> bronze -> silver -> gold as one lazy plan."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame

from depotlens.operators import gold, silver
from depotlens.operators.bronze import to_bronze
from depotlens.session import settle


# Silver columns that the reports with distinct counts read.
REPORT_ORDER_COLUMNS = (
    "order_id",
    "customer_id",
    "customer_type",
    "product_id",
    "order_date",
    "quantity",
    "total_amount",
    "discounted_amount",
    "discount_rate",
    "volume_tier",
    "order_value_tier",
)
REPORT_STOCK_COLUMNS = (
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
)


class Medallion:
    """Layers over raw tables. Bronze and silver are plain plans that run when a result is used.

    Reports that read orders or stock more than once first write the columns they use (``stored_orders``,
    ``stored_inventory``), when the report is asked for; ``persist_silver`` writes whole tables once instead.
    """

    def __init__(
        self, raw: Mapping[str, DataFrame], as_of: str, audit: bool = True, compat: bool = False
    ) -> None:
        self.raw = raw
        self.as_of = as_of
        self.audit = audit
        self.compat = compat
        self._written: dict[str, DataFrame] = {}

    def bronze(self, table: str) -> DataFrame:
        return to_bronze(self.raw[table], table, self.audit)

    def persist_silver(self, path: str, *tables: str) -> None:
        """Write silver tables to Parquet and let later reports read those files."""
        for table in tables:
            df = getattr(self, table)
            target = f"{path}/silver_{table}"
            df.write.mode("overwrite").parquet(target)
            self._written[table] = df.sparkSession.read.parquet(target)
            self.__dict__[table] = self._written[table]

    @cached_property
    def hospitals(self) -> DataFrame:
        return silver.silver_hospitals(self.bronze("hospitals"), self.as_of, self.audit)

    @cached_property
    def pharmacies(self) -> DataFrame:
        return silver.silver_pharmacies(self.bronze("pharmacies"), self.as_of, self.audit)

    @cached_property
    def products(self) -> DataFrame:
        return silver.silver_products(self.bronze("products"), self.as_of, self.audit)

    @cached_property
    def orders(self) -> DataFrame:
        return silver.silver_orders(self.bronze("orders"), self.audit, self.compat)

    @cached_property
    def inventory(self) -> DataFrame:
        return silver.silver_inventory(self.bronze("inventory"), self.as_of, self.audit)

    @cached_property
    def events(self) -> DataFrame:
        return silver.silver_supply_chain_events(
            self.bronze("supply_chain_events"), self.as_of, self.audit, self.compat
        )

    @cached_property
    def interactions(self) -> DataFrame:
        return silver.silver_reco_interactions(
            self.bronze("product_interactions"), self.bronze("products"), self.audit
        )

    @cached_property
    def substitutions(self) -> DataFrame:
        return silver.silver_reco_substitutions(
            self.bronze("substitution_events"), self.bronze("orders"), self.bronze("products"), self.audit
        )

    # Reports read silver more than once, so what they use of it is written first.

    @cached_property
    def stored_orders(self) -> DataFrame:
        if "orders" in self._written:
            return self._written["orders"]
        return settle(self.orders.select(*REPORT_ORDER_COLUMNS))

    @cached_property
    def stored_inventory(self) -> DataFrame:
        if "inventory" in self._written:
            return self._written["inventory"]
        return settle(self.inventory.select(*REPORT_STOCK_COLUMNS))

    @cached_property
    def stored_products(self) -> DataFrame:
        """What the feature report reads of the products; stored, they bring no filter into its readings of the orders."""
        if "products" in self._written:
            return self._written["products"]
        return settle(self.products.select(*gold.FEATURE_ATTRIBUTES))

    def financial_analytics(self) -> DataFrame:
        return gold.gold_financial_analytics(self.stored_orders, self.products, self.audit, self.compat)

    def pharmacy_performance(self) -> DataFrame:
        return gold.gold_pharmacy_performance(
            self.pharmacies, self.stored_orders, self.inventory, self.audit
        )

    def product_performance(self) -> DataFrame:
        return gold.gold_product_performance(self.products, self.stored_orders, self.inventory, self.audit)

    def supply_chain_performance(self) -> DataFrame:
        return gold.gold_supply_chain_performance(self.orders, self.events, self.audit)

    def ml_ready_dataset(self, pairs: DataFrame | None = None) -> DataFrame:
        orders, inventory = self.stored_orders, self.stored_inventory
        return gold.gold_ml_ready_dataset(
            pairs, orders, self.stored_products, inventory, self.as_of, self.audit, self.compat
        )
