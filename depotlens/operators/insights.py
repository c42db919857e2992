"""Dashboard datasets and small analytics over raw and silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.functions.columns import avg_exact, month_start, sum_exact, week_start


def row_counter(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def revenue_by_week(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy(week_start("order_date").alias("week_start"))
        .agg(sum_exact("total_amount").alias("revenue"))
        .orderBy("week_start")
    )


def avg_price_by_week(prices: DataFrame) -> DataFrame:
    return (
        prices.groupBy(week_start("date").alias("week_start"))
        .agg(avg_exact("price").alias("avg_price"))
        .orderBy("week_start")
    )


def join_sales_stores(sales: DataFrame, stores: DataFrame) -> DataFrame:
    return sales.join(stores, "store_id")


def store_revenue_by_week(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Revenue of known stores. Sales are summed per store and week before the join."""
    weekly = sales.groupBy("store_id", week_start("date").alias("week_start")).agg(
        sum_exact("revenue").alias("revenue")
    )
    return (
        join_sales_stores(weekly, stores.select("store_id"))
        .groupBy("week_start")
        .agg(sum_exact("revenue").alias("revenue"))
        .orderBy("week_start")
    )


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """(column, value, rows) of every listed column, in one scan."""
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    return (
        df.select(F.explode(F.array(*entries)).alias("e"))
        .groupBy("e.column", "e.value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def order_totals(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        avg_exact("discounted_amount", 4).alias("avg_order_value"),
        sum_exact("discounted_amount", 4).alias("total_revenue"),
    )


def _top(df: DataFrame, keys: list[str], amount: Column, n: int) -> DataFrame:
    totals = df.groupBy(*keys).agg(amount.alias("revenue"))
    return totals.orderBy(F.col("revenue").desc(), *keys).limit(n)


def top_products(orders: DataFrame, products: DataFrame, n: int = 3) -> DataFrame:
    """The n products with the highest revenue; names are joined after the cut."""
    best = _top(orders, ["product_id"], sum_exact("discounted_amount", 4), n)
    names = products.select("product_id", F.col("name").alias("product_name"))
    return best.join(names, "product_id", "left").select("product_id", "product_name", "revenue")


def monthly_sales_tail(orders: DataFrame, n: int = 3) -> DataFrame:
    """Revenue of the last n months."""
    monthly = orders.groupBy(month_start("order_date").alias("order_month")).agg(
        sum_exact("discounted_amount", 4).alias("revenue")
    )
    return monthly.orderBy(F.col("order_month").desc()).limit(n)


def category_revenue_top(orders: DataFrame, products: DataFrame, n: int = 3) -> DataFrame:
    """The n categories with the highest revenue. Orders are summed per product before the join."""
    per_product = orders.groupBy("product_id").agg(sum_exact("discounted_amount", 4).alias("_amount"))
    named = per_product.join(products.select("product_id", "category"), "product_id")
    return _top(named, ["category"], sum_exact("_amount", 4), n)


def fk_coverage(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows, rows whose key exists in the parent, and their share."""
    counts = child.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    keys = parent.select(F.col(parent_key).alias(key)).distinct().withColumn("_found", F.lit(True))
    return (
        counts.join(keys, key, "left")
        .agg(
            F.sum("_rows").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("_found"), F.col("_rows"))), F.lit(0)).alias("matched"),
        )
        .withColumn("coverage", F.try_divide(F.col("matched").cast("double"), F.col("rows").cast("double")))
    )
