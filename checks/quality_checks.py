"""Checks of filters, joins, data quality, dashboards and catalogue operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.feeds_sql import AS_OF, avg_exact, query, sum_exact
from checks.medallion import layers
from depotlens.functions.columns import (
    clean_lower,
    clean_upper,
    discount_impact,
    generate_date_partitions,
    performance_tier,
)
from depotlens.functions.text import safe_title, search_contains, title_words, video_id
from depotlens.operators import insights, quality
from depotlens.operators.gold import customer_type_filter
from depotlens.operators.inventory import rolling_cutoff
from depotlens.operators.joins import (
    anti_join_fk,
    id_membership,
    join_orders_products_left,
    join_products_orders_left,
    lookup_default,
    prefer_override,
)
from depotlens.operators.ordering import distinct_first
from depotlens.operators.recommend import action_filter
from depotlens.operators.silver import not_null_filter, reject_flags
from depotlens.sources.catalog import layer_of_schema, preview_table
from depotlens.sources.schemas import TABLE_DDL
from depotlens.sources.star_schema import AS_OF as TODAY
from depotlens.sources.writers import verify_counts

# A parent that misses half of the products, so that references break.
PARTIAL = "p_size <= 25"


def _some_products(feeds):
    return feeds.table("part").filter(PARTIAL).select(F.col("p_partkey").alias("product_id"), "p_name")


SOME = "(SELECT p_partkey AS product_id, p_name FROM part WHERE p_size <= 25)"



# Tables with column rules, and the parent they need.
RULED_TABLES = (*quality.RAW_RULES, "suppliers")


def _report(feeds, names=RULED_TABLES):
    return quality.dq_report({name: feeds[name] for name in names})


def _report_sql(names=RULED_TABLES) -> str:
    parts = []

    def add(name: str, source: str, condition: str) -> None:
        parts.append(f"SELECT '{name}' AS \"check\", count(*) AS failures FROM {source} WHERE {condition}")

    for table, rules in quality.RAW_RULES.items():
        for column in rules.not_null:
            add(f"{table}.{column}.not_null", f"raw_{table}", f"{column} IS NULL")
        for column, values in rules.accepted:
            words = ", ".join(f"'{v}'" for v in values)
            add(f"{table}.{column}.accepted_values", f"raw_{table}", f"{column} NOT IN ({words})")
        for column, low, high in rules.ranges:
            add(f"{table}.{column}.accepted_range", f"raw_{table}", f"({column} < {low} OR {column} > {high})")
        for key in rules.unique:
            parts.append(
                f"SELECT '{table}.{key}.unique', count(*) FROM (SELECT {key} FROM raw_{table} GROUP BY 1 HAVING count(*) > 1)"
            )
    known = set(names)
    for child, key, parent, parent_key in quality.FOREIGN_KEYS:
        if child in known and parent in known:
            add(
                f"{child}.{key}.references_{parent}",
                f"raw_{child}",
                f"{key} NOT IN (SELECT {parent_key} FROM raw_{parent})",
            )
    body = "\nUNION ALL ".join(parts)
    return f"SELECT *, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM ({body})"


def _all_references(feeds):
    """Violations of every product reference against the partial parent."""
    out = None
    for child, key, parent, _ in quality.FOREIGN_KEYS:
        if parent != "products":
            continue
        found = quality.dq_referential(feeds[child], key, _some_products(feeds), "product_id")
        found = found.select(F.lit(f"{child}.{key}").alias("reference"), F.col(key).alias("missing"))
        found = found.groupBy("reference", "missing").agg(F.count(F.lit(1)).alias("rows"))
        out = found if out is None else out.unionByName(found)
    return out


ALL_REFERENCES = "\nUNION ALL ".join(
    f"SELECT '{child}.{key}' AS reference, {key} AS missing, count(*) AS rows FROM raw_{child} "
    f"WHERE {key} NOT IN (SELECT product_id FROM {SOME}) GROUP BY 2"
    for child, key, parent, _ in quality.FOREIGN_KEYS
    if parent == "products"
)


def _references(feeds):
    """Violations of every reference against its whole parent."""
    out = None
    for child, key, parent, parent_key in quality.FOREIGN_KEYS:
        found = quality.dq_referential(feeds[child], key, feeds[parent], parent_key)
        found = found.select(F.lit(f"{child}.{key}").alias("reference"), F.col(key).cast("string").alias("missing"))
        found = found.groupBy("reference", "missing").agg(F.count(F.lit(1)).alias("rows"))
        out = found if out is None else out.unionByName(found)
    return out


REFERENCES = "\nUNION ALL ".join(
    f"SELECT '{child}.{key}' AS reference, CAST({key} AS VARCHAR) AS missing, count(*) AS rows FROM raw_{child} "
    f"WHERE {key} NOT IN (SELECT {parent_key} FROM raw_{parent}) GROUP BY 2"
    for child, key, parent, parent_key in quality.FOREIGN_KEYS
)


def _text_columns(feeds):
    return feeds.table("part").select(
        "p_partkey",
        clean_upper("p_name").alias("upper_name"),
        clean_lower("p_brand").alias("lower_brand"),
        F.col("p_size").cast("string").alias("size_text"),
        F.concat("p_name", F.lit(" (Warehouse)")).alias("warehouse_name"),
        title_words(F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))).alias("title_name"),
        safe_title(F.concat(F.lit("  #1: "), F.col("p_name"), F.lit("/"), F.col("p_brand"), F.lit(" - x_y "))).alias(
            "file_title"
        ),
        F.col("p_name").like("%ring%").alias("is_ring"),
        F.col("p_type").isin("ECONOMY", "PROMO").alias("is_cheap"),
        F.col("p_size").between(10, 20).alias("is_middle"),
    )


TEXT_COLUMNS = r"""
SELECT p_partkey, trim(upper(p_name)) AS upper_name, lower(trim(p_brand)) AS lower_brand,
  CAST(p_size AS VARCHAR) AS size_text, p_name || ' (Warehouse)' AS warehouse_name,
  array_to_string([upper(w[1]) || lower(w[2:]) for w in string_split(p_name, ' ')], ' ') AS title_name,
  replace(left(trim(regexp_replace('  #1: ' || p_name || '/' || p_brand || ' - x_y ', '[^\p{L}\p{N} _-]', '', 'g')), 100), ' ', '_') AS file_title,
  p_name LIKE '%ring%' AS is_ring, p_type IN ('ECONOMY', 'PROMO') AS is_cheap, p_size BETWEEN 10 AND 20 AS is_middle
FROM part"""


def _video_links(feeds):
    key = F.col("page_id").cast("string")
    link = (
        F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("https://www.youtube.com/watch?v=v"), key, F.lit("&t=3")))
        .when(F.col("page_id") % 4 == 1, F.concat(F.lit("https://youtu.be/v"), key, F.lit("?si=9")))
        .when(F.col("page_id") % 4 == 2, F.concat(F.lit("https://www.youtube.com/embed/v"), key))
        .otherwise(F.col("url"))
    )
    return feeds.table("pages").select("page_id", video_id(link).alias("video_id"))


def _literals(feeds):
    """Amounts of every order line: discount impact and a three-step tier."""
    orders = feeds.orders
    return orders.groupBy("order_id").agg(
        F.round(F.sum("total_amount"), 2).alias("gross"), F.round(F.sum("discounted_amount"), 4).alias("net")
    ).select(
        "order_id",
        discount_impact("gross", "net").alias("impact"),
        performance_tier("gross", 200_000, 100_000).alias("performance"),
    )


def _partitions(feeds):
    """One row per month between the first and the last order, with that month's orders."""
    first, last = feeds.table("orders").agg(*(f("o_orderdate").cast("date").cast("string") for f in (F.min, F.max))).first()
    months = generate_date_partitions(feeds.spark, first, last)
    counts = feeds.table("orders").groupBy(F.trunc("o_orderdate", "month").alias("partition_date")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return months.join(counts, "partition_date", "left").select(
        "partition_date", F.coalesce("rows", F.lit(0)).alias("rows")
    )


def _override(feeds):
    base = feeds.table("part").select("p_partkey", "p_name", "p_brand")
    fixed = feeds.table("part").filter(PARTIAL).select(
        "p_partkey", F.upper("p_name").alias("p_name"), F.lit(None).cast("string").alias("p_brand")
    )
    return prefer_override(base, fixed, "p_partkey")


CHECKS = {
    # filters
    "reject_flags": (
        lambda f: reject_flags(
            f.pharmacies.withColumn("negative", F.coalesce(F.col("monthly_revenue") < 0, F.lit(False))), "negative"
        ).select("pharmacy_id", "monthly_revenue"),
        query("SELECT pharmacy_id, monthly_revenue FROM raw_pharmacies WHERE NOT coalesce(monthly_revenue < 0, false)"),
    ),
    "not_null_filter": (
        lambda f: not_null_filter(f.hospitals, "emergency_department").select("hospital_id"),
        query("SELECT hospital_id FROM raw_hospitals WHERE emergency_department IS NOT NULL"),
    ),
    "string_functions": (_text_columns, TEXT_COLUMNS),
    "video_id": (
        _video_links,
        "SELECT page_id, CASE WHEN page_id % 4 < 3 THEN 'v' || page_id END AS video_id FROM pages",
    ),
    "customer_type_filter": (
        lambda f: customer_type_filter(layers(f).orders).select("order_id", "product_id"),
        query("SELECT order_id, product_id FROM silver_orders WHERE customer_type = 'PHARMACY'"),
    ),
    "rolling_cutoff": (
        lambda f: rolling_cutoff(f.orders, "order_date", TODAY).select("order_id", "product_id", "order_date"),
        query(f"SELECT order_id, product_id, order_date FROM raw_orders WHERE order_date >= {AS_OF} - INTERVAL 90 DAY"),
    ),
    "action_filter": (
        lambda f: action_filter(layers(f).interactions).select("interaction_id"),
        query("SELECT interaction_id FROM silver_interactions WHERE action_type = 'purchased'"),
    ),
    "id_membership": (
        lambda f: id_membership(f.orders, _some_products(f), "product_id").select("order_id", "product_id"),
        query(f"SELECT order_id, product_id FROM raw_orders WHERE product_id IN (SELECT product_id FROM {SOME})"),
    ),
    "search_contains": (
        lambda f: f.table("documents").filter(search_contains("source", "SRC1")).select("doc_id", "source"),
        "SELECT doc_id, source FROM documents WHERE contains(lower(source), 'src1')",
    ),
    # joins
    "join_orders_products_left": (
        lambda f: join_orders_products_left(
            f.orders, _some_products(f).withColumnRenamed("p_name", "name"), "name"
        ).select("order_id", "product_id", "name"),
        query(
            f"SELECT order_id, o.product_id, p_name AS name FROM raw_orders o LEFT JOIN {SOME} s ON o.product_id = s.product_id"
        ),
    ),
    "join_products_orders_left": (
        lambda f: join_products_orders_left(
            f.products.select("product_id"), f.orders, "quantity"
        ),
        query("SELECT p.product_id, quantity FROM raw_products p LEFT JOIN raw_orders o ON p.product_id = o.product_id"),
    ),
    "join_sales_stores": (
        lambda f: insights.join_sales_stores(f.store_sales, f.store_attributes).select(
            "store_id", "product_id", "revenue", "cluster_id"
        ),
        query(
            "SELECT s.store_id, product_id, revenue, cluster_id FROM raw_store_sales s JOIN raw_store_attributes a "
            "ON s.store_id = a.store_id"
        ),
    ),
    "anti_join_fk": (
        lambda f: anti_join_fk(f.orders, "product_id", _some_products(f), "product_id").select(
            "order_id", "product_id"
        ),
        query(f"SELECT order_id, product_id FROM raw_orders WHERE product_id NOT IN (SELECT product_id FROM {SOME})"),
    ),
    "anti_join_polymorphic": (
        lambda f: quality.dq_polymorphic_fk(
            f.orders,
            "customer_id",
            [(layers(f).pharmacies, "pharmacy_id"), (layers(f).hospitals, "hospital_id")],
        ),
        query(
            "SELECT customer_id FROM raw_orders WHERE customer_id NOT IN (SELECT pharmacy_id FROM silver_pharmacies) "
            "AND customer_id NOT IN (SELECT hospital_id FROM silver_hospitals)"
        ),
    ),
    "lookup_default": (
        lambda f: lookup_default(
            f.table("part").select(F.col("p_partkey").alias("product_id")),
            id_membership(f.products, _some_products(f), "product_id"),
            "product_id",
            "lead_time_days",
            7,
        ),
        query(
            "SELECT p_partkey AS product_id, CASE WHEN p_size <= 25 THEN lead_time_days ELSE 7 END AS lead_time_days "
            "FROM part JOIN raw_products ON p_partkey = product_id"
        ),
    ),
    "prefer_override": (
        _override,
        "SELECT p_partkey, CASE WHEN p_size <= 25 THEN upper(p_name) ELSE p_name END AS p_name, "
        "CASE WHEN p_size > 25 THEN p_brand END AS p_brand FROM part",
    ),
    "distinct_first": (
        lambda f: distinct_first(
            f.orders.select("product_id", "order_id", "order_date"), ["product_id"], F.col("order_date"), F.col("order_id")
        ),
        query(
            "SELECT product_id, order_id, order_date FROM raw_orders QUALIFY row_number() OVER (PARTITION BY product_id "
            "ORDER BY order_date, order_id) = 1"
        ),
    ),
    # data quality
    "dq_unique": (
        lambda f: quality.dq_unique(f.orders, "order_id"),
        query("SELECT order_id, count(*) AS rows FROM raw_orders GROUP BY order_id HAVING count(*) > 1"),
    ),
    "dq_not_null": (
        lambda f: quality.dq_not_null(f.orders, "actual_delivery").select("order_id", "product_id"),
        query("SELECT order_id, product_id FROM raw_orders WHERE actual_delivery IS NULL"),
    ),
    "dq_accepted_values": (
        lambda f: quality.dq_accepted_values(f.pharmacies, "state", quality.STATES).select("pharmacy_id", "state"),
        query(
            "SELECT pharmacy_id, state FROM raw_pharmacies WHERE state NOT IN ('NSW','VIC','QLD','WA','SA','TAS','ACT','NT')"
        ),
    ),
    "dq_accepted_range": (
        lambda f: quality.dq_accepted_range(f.orders, "total_amount", 0, 100_000).select("order_id", "total_amount"),
        query("SELECT order_id, total_amount FROM raw_orders WHERE total_amount < 0 OR total_amount > 100000"),
    ),
    "dq_valid_date_range": (
        lambda f: quality.dq_valid_date_range(f.orders, "order_date", "1996-01-01", "2000-12-31").select(
            "order_id", "order_date"
        ),
        query(
            "SELECT order_id, order_date FROM raw_orders WHERE order_date < DATE '1996-01-01' OR order_date > DATE '2000-12-31'"
        ),
    ),
    "dq_positive_value": (
        lambda f: quality.dq_positive_value(f.pharmacies, "monthly_revenue").select("pharmacy_id", "monthly_revenue"),
        query("SELECT pharmacy_id, monthly_revenue FROM raw_pharmacies WHERE monthly_revenue < 0"),
    ),
    "dq_valid_percentage": (
        lambda f: quality.dq_valid_percentage(layers(f).inventory, "stock_percentage").select(
            "inventory_id", "stock_percentage"
        ),
        query(
            "SELECT inventory_id, stock_percentage FROM silver_inventory WHERE stock_percentage < 0 OR stock_percentage > 100"
        ),
    ),
    "dq_valid_rate": (
        lambda f: quality.dq_valid_rate(f.substitution_events, "margin_delta").select("substitution_id"),
        query("SELECT substitution_id FROM raw_substitution_events WHERE margin_delta < 0 OR margin_delta > 1"),
    ),
    "dq_referential_whole": (_references, query(REFERENCES)),
    "dq_referential": (_all_references, query(ALL_REFERENCES)),
    "dq_polymorphic_fk": (
        lambda f: quality.dq_polymorphic_fk(
            f.product_interactions,
            "customer_id",
            [(layers(f).pharmacies, "pharmacy_id"), (layers(f).hospitals, "hospital_id")],
        )
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("rows")),
        query(
            "SELECT customer_id, count(*) AS rows FROM raw_product_interactions WHERE customer_id NOT IN "
            "(SELECT pharmacy_id FROM silver_pharmacies) AND customer_id NOT IN (SELECT hospital_id FROM silver_hospitals) "
            "GROUP BY customer_id"
        ),
    ),
    "dq_combined": (
        lambda f: quality.dq_combined(
            f.orders.select("order_id", "product_id", F.datediff("actual_delivery", "order_date").cast("bigint").alias("d")),
            "d",
            3,
            8,
        ),
        query(
            "WITH x AS (SELECT order_id, product_id, datediff('day', order_date, actual_delivery) AS d FROM raw_orders) "
            "SELECT *, 'not_null' AS rule FROM x WHERE d IS NULL UNION ALL SELECT *, 'min_value' FROM x WHERE d < 3 "
            "UNION ALL SELECT *, 'max_value' FROM x WHERE d > 8"
        ).replace("\nWITH x AS", ",\nx AS"),
    ),
    "dq_report": (_report, query(_report_sql())),
    "dq_report_all_tables": (lambda f: _report(f, tuple(TABLE_DDL)), query(_report_sql(tuple(TABLE_DDL)))),
    # dashboards and small analytics
    "dash_total_orders": (
        lambda f: insights.row_counter(layers(f).orders, "orders"),
        query("SELECT count(*) AS orders FROM silver_orders"),
    ),
    "dash_price_rows": (
        lambda f: insights.row_counter(f.competitor_price_history),
        query("SELECT count(*) AS rows FROM raw_competitor_price_history"),
    ),
    "dash_promo_rows": (
        lambda f: insights.row_counter(f.promotions),
        query("SELECT count(*) AS rows FROM raw_promotions"),
    ),
    "dash_revenue_by_week": (
        lambda f: insights.revenue_by_week(layers(f).orders),
        query(
            f"SELECT CAST(date_trunc('week', order_date) AS DATE) AS week_start, {sum_exact('total_amount')} AS revenue "
            "FROM silver_orders GROUP BY 1 ORDER BY 1"
        ),
    ),
    "dash_avg_price_by_week": (
        lambda f: insights.avg_price_by_week(f.competitor_price_history),
        query(
            f"SELECT CAST(date_trunc('week', date) AS DATE) AS week_start, {avg_exact('price')} AS avg_price "
            "FROM raw_competitor_price_history GROUP BY 1"
        ),
    ),
    "dash_store_revenue_by_week": (
        lambda f: insights.store_revenue_by_week(f.store_sales, f.store_attributes),
        query(
            f"SELECT CAST(date_trunc('week', date) AS DATE) AS week_start, {sum_exact('revenue')} AS revenue "
            "FROM raw_store_sales s JOIN raw_store_attributes a ON s.store_id = a.store_id GROUP BY 1"
        ),
    ),
    "value_counts": (
        lambda f: insights.value_counts(f.orders, "customer_type", "order_status", "shipping_method"),
        query(
            "\nUNION ALL ".join(
                f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS rows FROM raw_orders GROUP BY {c}"
                for c in ("customer_type", "order_status", "shipping_method")
            )
        ),
    ),
    "order_totals": (
        lambda f: insights.order_totals(f.orders),
        query(
            f"SELECT count(*) AS orders, {avg_exact('discounted_amount', 4)} AS avg_order_value, "
            f"{sum_exact('discounted_amount', 4)} AS total_revenue FROM raw_orders"
        ),
    ),
    "top_products": (
        lambda f: insights.top_products(f.orders, f.products),
        query(
            f"SELECT product_id, product_name, revenue FROM (SELECT product_id, {sum_exact('discounted_amount', 4)} AS revenue "
            "FROM raw_orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3) JOIN (SELECT product_id, name AS product_name "
            "FROM raw_products) USING (product_id)"
        ),
    ),
    "monthly_sales_tail": (
        lambda f: insights.monthly_sales_tail(f.orders),
        query(
            f"SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_month, {sum_exact('discounted_amount', 4)} AS revenue "
            "FROM raw_orders GROUP BY 1 ORDER BY 1 DESC LIMIT 3"
        ),
    ),
    "category_revenue_top": (
        lambda f: insights.category_revenue_top(f.orders, f.products),
        query(
            f"SELECT category, {sum_exact('discounted_amount', 4)} AS revenue FROM raw_orders JOIN raw_products "
            "USING (product_id) GROUP BY 1 ORDER BY 2 DESC LIMIT 3"
        ),
    ),
    "fk_coverage": (
        lambda f: insights.fk_coverage(f.orders, "product_id", _some_products(f), "product_id"),
        query(
            "SELECT *, CAST(matched AS DOUBLE) / rows AS coverage FROM (SELECT count(*) AS rows, count(CASE WHEN product_id IN "
            f"(SELECT product_id FROM {SOME}) THEN 1 END) AS matched FROM raw_orders)"
        ),
    ),
    "discount_impact": (
        _literals,
        query(
            "SELECT order_id, CASE WHEN gross > 0 THEN CAST(round(CAST(CAST((CAST(gross - net AS DOUBLE) / gross * 100) AS VARCHAR) "
            "AS DECIMAL(38,15)), 2) AS DOUBLE) ELSE 0 END AS impact, "
            "CASE WHEN gross >= 200000 THEN 'High' WHEN gross >= 100000 THEN 'Medium' ELSE 'Low' END AS performance "
            f"FROM (SELECT order_id, {sum_exact('total_amount')} AS gross, {sum_exact('discounted_amount', 4)} AS net "
            "FROM raw_orders GROUP BY order_id)"
        ),
    ),
    "generate_date_partitions": (
        _partitions,
        "SELECT CAST(m.m AS DATE) AS partition_date, count(o_orderkey) AS rows FROM (SELECT unnest(generate_series("
        "date_trunc('month', (SELECT min(o_orderdate) FROM orders)), (SELECT max(o_orderdate) FROM orders), "
        "INTERVAL 1 MONTH)) AS m) m LEFT JOIN orders ON date_trunc('month', o_orderdate) = m.m GROUP BY 1",
    ),
    # catalogue
    "layer_of_schema": (
        lambda f: f.table("documents")
        .select(F.concat_ws("_", "source", F.element_at(F.array(*map(F.lit, ("raw", "bronze", "silver", "gold", "x"))), (F.col("doc_id") % 5 + 1).cast("int"))).alias("schema"))
        .select("schema", layer_of_schema("schema").alias("layer")),
        "SELECT source || '_' || l AS schema, CASE l WHEN 'x' THEN 'other' ELSE l END AS layer FROM (SELECT source, "
        "['raw', 'bronze', 'silver', 'gold', 'x'][doc_id % 5 + 1] AS l FROM documents)",
    ),
    "preview_table": (
        lambda f: preview_table(f.orders.select("order_id", "product_id", "quantity"), 200, "order_id", "product_id", "quantity"),
        query(
            "SELECT order_id, product_id, quantity FROM raw_orders ORDER BY order_id, product_id, quantity LIMIT 200"
        ),
    ),
    "verify_counts": (
        lambda f: _counts(f),
        "\nUNION ALL ".join(
            f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}"
            for t in ("customer", "orders", "lineitem", "part", "events", "documents")
        ),
    ),
}


def _counts(feeds):
    names = ("customer", "orders", "lineitem", "part", "events", "documents")
    for name in names:
        feeds.table(name).createOrReplaceTempView(name)
    return verify_counts(feeds.spark, *names)
