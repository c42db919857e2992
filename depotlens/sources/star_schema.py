"""Canonical raw tables derived from a star schema of orders, parts, customers and web data.

Pure projections, joins and aggregates of the given Parquet tables, so every report can run over
them. ``AS_OF`` and ``EVENTS_AS_OF`` stand for "today" of the order and event tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.operators.inventory import (
    expiry_batches,
    inventory_availability,
    store_attributes_from_pharmacies,
    warehouses_from_pharmacies,
)
from depotlens.operators.ordering import spread

AS_OF = "2001-08-02"
EVENTS_AS_OF = "2024-01-31"


def _date(text: str) -> Column:
    return F.lit(text).cast("date")


def _plus(start: Column, days: Column) -> Column:
    return F.date_add(start, days.cast("int"))


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


class StarSchemaFeeds:
    """``feeds.orders`` etc. are the canonical raw tables; ``feeds.table(name)`` a given one."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    # --- orders and products -------------------------------------------------------------

    @cached_property
    def orders(self) -> DataFrame:
        """One row per order line."""
        day = F.to_date("o_orderdate")
        lines = (
            self.table("lineitem")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
        )
        return lines.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "Hospital").otherwise("Pharmacy").alias("customer_type"),
            F.col("l_partkey").alias("product_id"),
            day.alias("order_date"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
            F.col("l_extendedprice").alias("total_amount"),
            F.col("l_discount").alias("discount_rate"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("discounted_amount"),
            F.when(F.col("o_orderstatus") == "F", "Delivered")
            .when(F.col("o_orderstatus") == "O", "Shipped")
            .when(F.col("l_returnflag") == "R", "Cancelled")
            .otherwise("Pending")
            .alias("order_status"),
            _text(" net ", 30 + 15 * (F.col("l_linenumber") % 3)).alias("payment_terms"),
            F.col("o_orderpriority").alias("shipping_method"),
            _plus(day, 1 + F.col("l_suppkey") % 7).alias("expected_delivery"),
            F.when(F.col("o_orderkey") % 10 != 0, _plus(day, 1 + F.col("l_partkey") % 10)).alias("actual_delivery"),
            F.lit(None).cast("string").alias("special_instructions"),
            _text("Rep ", F.col("o_custkey") % 50).alias("sales_rep"),
            F.col("o_orderdate").alias("created_timestamp"),
        )

    @cached_property
    def products(self) -> DataFrame:
        key = F.col("p_partkey")
        price = F.col("p_retailprice") / (1 + F.col("p_size") % 25)
        wholesale, retail = price * 0.7, price * 1.3
        return self.table("part").select(
            key.alias("product_id"),
            F.col("p_name").alias("name"),
            _text(" ", F.col("p_name"), " generic").alias("generic_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("manufacturer"),
            _text("Supplier ", key % 100).alias("supplier"),
            F.when(key % 5 < 3, _text("PBS", key)).alias("pbs_code"),
            _text("A", F.col("p_size")).alias("atc_code"),
            price.alias("unit_price"),
            wholesale.alias("wholesale_price"),
            retail.alias("retail_price"),
            (key % 5 < 3).alias("is_prescription"),
            (key % 20 == 0).alias("is_controlled_substance"),
            (key % 7 == 0).alias("requires_cold_chain"),
            F.when(key % 3 == 0, "Frozen (-20C)").when(key % 3 == 1, "Refrigerated (2-8C)").otherwise(
                "Room Temperature"
            ).alias("storage_type"),
            (12 + F.col("p_size")).cast("bigint").alias("expiry_months"),
            F.lit(100).cast("bigint").alias("batch_size"),
            (1 + F.col("p_size")).cast("bigint").alias("minimum_order_quantity"),
            (1 + key % 30).alias("lead_time_days"),
            F.col("p_name").alias("active_ingredient"),
            F.col("p_type").alias("dosage_form"),
            F.col("p_size").cast("string").alias("pack_size"),
            _plus(_date("1996-01-01"), key % 2100).alias("created_date"),
            _date(AS_OF).alias("last_updated"),
            (key % 100).alias("supplier_id"),
            _text("T", key % 12).alias("therapeutic_category"),
            F.col("p_brand").alias("brand"),
            F.when(key % 4 == 0, (key + 1).cast("string")).alias("generic_equivalent_id"),
            _text("[", F.col("p_size"), ", ", F.col("p_size") * 2, "]").alias("pack_size_variants"),
            ((retail - wholesale) / retail * 100).alias("margin_percentage"),
        )

    # --- customers and stock locations ---------------------------------------------------

    def _customers(self) -> DataFrame:
        return self.table("customer").join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
        )

    @cached_property
    def pharmacies(self) -> DataFrame:
        key = F.col("c_custkey")
        return self._customers().filter(F.col("c_mktsegment") != "MACHINERY").select(
            key.alias("pharmacy_id"),
            _text("  ", F.col("c_name"), " ").alias("name"),
            (key % 10 < 7).alias("is_chain"),
            _text(key, " main st").alias("address"),
            _text("Suburb ", F.col("c_nationkey")).alias("suburb"),
            F.col("n_name").alias("state"),
            (2000 + F.col("c_nationkey") * 10).cast("bigint").alias("postcode"),
            _text("02", key).alias("phone"),
            _text(" ", F.col("c_name"), "@Example.com").alias("email"),
            _text("LIC", key).alias("license_number"),
            _plus(_date("1970-01-01"), key * 37 % 11700).alias("established_date"),
            _text("Person ", key % 97).alias("pharmacist_in_charge"),
            F.lit("9-5").alias("trading_hours"),
            (key % 2 == 0).alias("has_consultation_room"),
            (key % 3 == 0).alias("has_vaccination_service"),
            F.floor(F.col("c_acctbal") * 50).cast("bigint").alias("monthly_revenue"),
            (key % 5000).alias("customer_count"),
        )

    @cached_property
    def hospitals(self) -> DataFrame:
        key = F.col("c_custkey")
        return self._customers().filter(F.col("c_mktsegment") == "MACHINERY").select(
            key.alias("hospital_id"),
            _text(F.col("c_name"), " hospital ").alias("name"),
            _text(" type ", key % 4).alias("hospital_type"),
            _text(key, " high st").alias("address"),
            _text("Suburb ", F.col("c_nationkey")).alias("suburb"),
            F.col("n_name").alias("state"),
            (2000 + F.col("c_nationkey") * 10).cast("bigint").alias("postcode"),
            _text("03", key).alias("phone"),
            _text(" ", F.col("c_name"), "@Example.com").alias("email"),
            _text("HOS", key).alias("license_number"),
            (key % 700).alias("beds"),
            F.when(key % 11 != 0, key % 2 == 0).alias("emergency_department"),
            (key % 3 * 10).alias("icu_beds"),
            F.lit("Cardiology, Oncology").alias("specialties"),
            _plus(_date("1970-01-01"), key * 41 % 11700).alias("accreditation_date"),
            F.floor(F.col("c_acctbal") * 600).cast("bigint").alias("monthly_budget"),
            _text("Buyer ", key % 31).alias("procurement_contact"),
            _text("Buyer", key % 31, "@Example.com ").alias("procurement_email"),
        )

    @cached_property
    def suppliers(self) -> DataFrame:
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(
                F.col("s_suppkey").alias("supplier_id"),
                F.col("s_name").alias("name"),
                F.col("r_name").alias("region"),
                (1 + F.col("s_suppkey") % 14).alias("lead_time_days"),
            )
        )

    @cached_property
    def warehouses(self) -> DataFrame:
        return warehouses_from_pharmacies(self.pharmacies)

    @cached_property
    def store_attributes(self) -> DataFrame:
        size = 50 + F.col("pharmacy_id") % 251
        return store_attributes_from_pharmacies(self.pharmacies, size)

    # --- stock ---------------------------------------------------------------------------

    @cached_property
    def inventory(self) -> DataFrame:
        """Stock per supplier and part; the supplier stands for the stock location."""
        # A pair has few lines, so tasks in front of the shuffle would hold almost every line to reduce little.
        lines = self.table("lineitem").select("l_suppkey", "l_partkey", "l_quantity", "l_extendedprice")
        stock = spread(lines, "l_suppkey", "l_partkey").groupBy("l_suppkey", "l_partkey").agg(
            F.sum("l_quantity").cast("bigint").alias("units"),
            F.round(F.sum("l_extendedprice"), 2).alias("amount"),
        )
        place, item, units = F.col("l_suppkey"), F.col("l_partkey"), F.col("units")
        today = _date(AS_OF)
        return stock.select(
            _text("INV-", place, "-", item).alias("inventory_id"),
            place.alias("pharmacy_id"),
            item.alias("product_id"),
            units.alias("current_stock"),
            (5 + item % 16).alias("reorder_level"),
            (20 + place % 80).alias("max_stock"),
            (units <= 5 + item % 16).alias("needs_reorder"),
            _plus(today, -((item + place) % 120) + 3).alias("last_restocked"),
            _plus(today, (item * 7 + place) % 200 - 20).alias("expiry_date"),
            _text("B", item % 1000, "-", place).alias("batch_number"),
            _text(" shelf ", place % 9).alias("storage_location"),
            (F.col("amount") / units).alias("cost_per_unit"),
            _plus(today, -(item % 30)).alias("last_movement_date"),
            F.when(item % 2 == 0, "inbound").otherwise("outbound").alias("movement_type"),
            (1 + (item + place) % 40).alias("movement_quantity"),
            today.cast("timestamp_ntz").alias("updated_timestamp"),
        )

    @cached_property
    def inventory_availability(self) -> DataFrame:
        return inventory_availability(self.inventory, self.products, AS_OF)

    @cached_property
    def expiry_batches(self) -> DataFrame:
        return expiry_batches(self.inventory)

    # --- events --------------------------------------------------------------------------

    @cached_property
    def supply_chain_events(self) -> DataFrame:
        kind = F.col("event_type")
        return self.table("events").select(
            "event_id",
            F.col("user_id").alias("order_id"),
            F.when(kind == "click", "Picking_Started")
            .when(kind == "view", "In_Transit")
            .when(kind == "purchase", "Delivered")
            .when(kind == "signup", "Order_Received")
            .when(kind == "error", "Damaged")
            .otherwise("Unknown")
            .alias("event_type"),
            F.col("ts").alias("event_timestamp"),
            _text(" dock ", F.col("user_id") % 5).alias("location"),
            F.when(kind == "error", "Error")
            .when(kind == "signup", "Pending")
            .when(kind == "click", "Warning")
            .otherwise("Success")
            .alias("status"),
            F.col("props").alias("description"),
            _text("Op ", F.col("event_id") % 17).alias("operator"),
            _text("EQ", F.col("event_id") % 29).alias("equipment_id"),
            (F.col("event_id") % 30).alias("temperature"),
            F.lit(None).cast("string").alias("notes"),
        )

    @cached_property
    def product_interactions(self) -> DataFrame:
        bought = (
            self.table("lineitem")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                _text(
                    "P-",
                    F.col("l_orderkey"),
                    "-",
                    F.col("l_partkey"),
                    "-",
                    F.col("l_suppkey"),
                    "-",
                    F.col("l_linenumber"),
                    "-",
                    F.col("l_quantity").cast("bigint"),
                ).alias("interaction_id"),
                F.col("o_custkey").alias("customer_id"),
                F.col("l_partkey").alias("product_id"),
                F.lit(" Purchased").alias("action_type"),
                F.col("o_orderdate").alias("timestamp"),
                _text("S", F.col("l_orderkey")).alias("session_id"),
            )
        )
        parts = self.table("part").agg(F.count(F.lit(1)).alias("n"))
        kind = F.col("event_type")
        browsed = self.table("events").select(
            _text("E-", F.col("event_id")).alias("interaction_id"),
            F.col("user_id").alias("customer_id"),
            (F.col("event_id") % parts.scalar()).alias("product_id"),
            F.when(kind == "view", "viewed").when(kind == "click", "added_to_cart").otherwise("searched").alias(
                "action_type"
            ),
            F.col("ts").alias("timestamp"),
            _text("W", F.col("user_id")).alias("session_id"),
        )
        return bought.unionByName(browsed)

    @cached_property
    def substitution_events(self) -> DataFrame:
        return self.table("lineitem").filter(F.col("l_returnflag") == "R").select(
            _text(
                "S-",
                F.col("l_orderkey"),
                "-",
                F.col("l_partkey"),
                "-",
                F.col("l_suppkey"),
                "-",
                F.col("l_linenumber"),
                "-",
                F.col("l_quantity").cast("bigint"),
            ).alias("substitution_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("requested_product_id"),
            (F.col("l_partkey") + 1).alias("substituted_product_id"),
            F.when(F.col("l_linestatus") == "O", " Out_Of_Stock ").otherwise("Cost_Saving").alias("reason"),
            (F.col("l_quantity") > 10).alias("customer_accepted"),
            (F.col("l_tax") - F.col("l_discount")).alias("margin_delta"),
            F.col("l_shipdate").alias("timestamp"),
        )

    @cached_property
    def writeoff_events(self) -> DataFrame:
        return self.table("lineitem").filter(F.col("l_returnflag") == "A").select(
            _text("W-", F.col("l_orderkey"), "-", F.col("l_partkey"), "-", F.col("l_suppkey")).alias("event_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("warehouse_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.when(F.col("l_linestatus") == "O", "damaged").otherwise("expired").alias("reason"),
            F.col("l_extendedprice").alias("cost"),
            F.col("l_shipdate").alias("timestamp"),
        )

    # --- purchasing, costs, competitors, stores ------------------------------------------

    @cached_property
    def purchase_orders(self) -> DataFrame:
        day = F.to_date("l_shipdate")
        return self.table("lineitem").select(
            _text("PO-", F.col("l_orderkey"), "-", F.col("l_partkey"), "-", F.col("l_suppkey")).alias("po_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            day.alias("order_date"),
            _plus(day, 7 + F.col("l_suppkey") % 7).alias("expected_delivery_date"),
            F.when(F.col("l_linestatus") == "F", _plus(day, 5 + F.col("l_partkey") % 11)).alias(
                "actual_delivery_date"
            ),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_cost"),
        )

    @cached_property
    def supplier_performance(self) -> DataFrame:
        filled = F.when(F.col("l_linestatus") == "F", F.col("l_quantity"))
        return (
            self.table("lineitem")
            .groupBy("l_suppkey", "l_partkey", F.trunc("l_shipdate", "month").alias("month"))
            .agg(
                (F.coalesce(F.sum(filled), F.lit(0.0)) / F.sum("l_quantity")).alias("fill_rate"),
                F.max(1 + F.col("l_suppkey") % 14).alias("avg_lead_time_days"),
                (F.max(F.col("l_partkey") % 5) / F.lit(2.0)).alias("lead_time_std"),
            )
            .withColumnsRenamed({"l_suppkey": "supplier_id", "l_partkey": "product_id"})
        )

    @cached_property
    def warehouse_costs(self) -> DataFrame:
        return (
            self.table("lineitem")
            .groupBy("l_suppkey", "l_partkey")
            .agg(
                (F.sum("l_quantity") * F.lit(0.25)).alias("storage_cost"),
                (F.count(F.lit(1)) * F.lit(1.5)).alias("handling_cost"),
                F.max(F.trunc("l_shipdate", "month")).alias("period"),
            )
            .withColumnsRenamed({"l_suppkey": "warehouse_id", "l_partkey": "product_id"})
        )

    @cached_property
    def competitor_products(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            (key % 5).alias("competitor_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_retailprice").alias("price"),
            _text("https://example.com/p/", key).alias("url"),
            _plus(_date("2001-01-01"), key % 200).alias("scrape_date"),
        )

    @cached_property
    def competitor_price_history(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_suppkey").alias("competitor_id"),
            _text("Part ", F.col("l_partkey")).alias("product_name"),
            F.col("l_extendedprice").alias("price"),
            F.to_date("l_shipdate").alias("date"),
        )

    @cached_property
    def store_sales(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_suppkey").alias("store_id"),
            F.col("l_partkey").alias("product_id"),
            F.to_date("l_shipdate").alias("date"),
            F.col("l_quantity").cast("bigint").alias("sales_quantity"),
            F.col("l_extendedprice").alias("revenue"),
        )

    @cached_property
    def promotions(self) -> DataFrame:
        day = F.to_date("l_shipdate")
        return self.table("lineitem").filter(F.col("l_discount") > 0.05).select(
            _text("PR-", F.col("l_orderkey"), "-", F.col("l_partkey")).alias("promo_id"),
            F.col("l_suppkey").alias("store_id"),
            F.col("l_partkey").alias("product_id"),
            day.alias("start_date"),
            _plus(day, F.lit(14)).alias("end_date"),
            F.col("l_discount").alias("discount_rate"),
        )

    # --- documents -----------------------------------------------------------------------

    @cached_property
    def doc_pages(self) -> DataFrame:
        """Conversations as documents, their turns as pages."""
        return self.table("conversations").select(
            F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), "text"
        )

    @cached_property
    def articles(self) -> DataFrame:
        """Web pages as articles."""
        return self.table("pages").select(
            F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"),
            "url",
            F.lit("").alias("author"),
            F.lit("").alias("published"),
            F.col("html").alias("summary"),
            F.array(
                F.regexp_extract("html", r'<html lang="([a-z]+)"', 1),
                F.regexp_extract("url", r"://([^/]+)", 1),
            ).alias("tags"),
            F.lit("").alias("reading_time"),
            "page_id",
        )
