"""Known values and the cases where a careless rewrite changes results."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from depotlens.functions import columns as C
from depotlens.functions import text as T
from depotlens.operators import digest, documents, gold, inventory, quality, silver
from depotlens.operators.bronze import to_bronze
from depotlens.operators.joins import anti_join_fk, merge_category
from depotlens.sources.schemas import DOCUMENT_FIELDS, TABLE_DDL

TODAY = "2024-06-01"


def orders(spark, *changes):
    row = {
        "order_id": "O1",
        "customer_id": "P1",
        "customer_type": "Pharmacy",
        "product_id": "X1",
        "order_date": dt.date(2024, 5, 1),
        "quantity": 60,
        "unit_price": 10.0,
        "total_amount": 600.0,
        "discount_rate": 0.1,
        "discounted_amount": 540.0,
        "order_status": "Delivered",
        "payment_terms": "Net 30",
        "shipping_method": "Road",
        "expected_delivery": dt.date(2024, 5, 5),
        "actual_delivery": dt.date(2024, 5, 4),
        "special_instructions": None,
        "sales_rep": "A",
        "created_timestamp": dt.datetime(2024, 5, 1),
    }
    rows = [{**row, **change} for change in (changes or ({},))]
    return to_bronze(spark.createDataFrame(rows, TABLE_DDL["orders"]), "orders", audit=False)


def test_delivery_label_by_cleaned_or_by_raw_status(spark):
    bronze = orders(spark)
    assert silver.silver_orders(bronze).first().delivery_performance == "On Time"
    assert silver.silver_orders(bronze, compat=True).first().delivery_performance == "In Progress"


def test_volume_labels_count_unless_compared_literally(spark):
    clean = silver.silver_orders(orders(spark), audit=False)
    assert gold.customer_features(clean, TODAY).first().high_volume_orders == 1
    assert gold.customer_features(clean, TODAY, compat=True).first().high_volume_orders == 0


def test_unknown_quantity_is_kept_and_negative_one_rejected(spark):
    got = silver.silver_orders(orders(spark, {"quantity": None}, {"quantity": -1, "order_id": "O2"}))
    assert [r.order_id for r in got.collect()] == ["O1"]


def test_discount_tier_is_strict(spark):
    got = silver.silver_orders(
        orders(spark, {"discount_rate": 0.1}, {"discount_rate": 0.11}, {"discount_rate": 0.0}, {"discount_rate": 1.2})
    )
    assert sorted(r.discount_tier for r in got.collect()) == ["High Discount", "Medium Discount", "No Discount"]


def test_free_product_has_no_margin_percentage(spark):
    row = {c: None for c in ("generic_name", "category", "storage_type")}
    raw = spark.createDataFrame(
        [{**row, "product_id": "X", "name": "n", "category": "c", "retail_price": 0.0, "wholesale_price": 0.0, "unit_price": 1.0}],
        TABLE_DDL["products"],
    )
    got = silver.silver_products(to_bronze(raw, "products"), TODAY).first()
    assert got.profit_margin_percentage is None and got.profit_margin == 0.0


def test_pharmacy_without_orders_has_unknown_revenue_per_customer(spark):
    pharmacies = spark.createDataFrame(
        [{"pharmacy_id": "P9", "name": "n", "state": "NSW", "customer_count": 10, "monthly_revenue": 5}],
        TABLE_DDL["pharmacies"],
    )
    stock = spark.createDataFrame([], TABLE_DDL["inventory"])
    got = gold.gold_pharmacy_performance(
        silver.silver_pharmacies(to_bronze(pharmacies, "pharmacies"), TODAY),
        silver.silver_orders(orders(spark)),
        silver.silver_inventory(to_bronze(stock, "inventory"), TODAY),
    ).first()
    assert got.revenue_per_customer is None and got.revenue_per_order == 0.0
    assert got.total_orders == 0 and got.performance_tier == "No Orders" and got.inventory_health == "No Inventory Data"


def test_expired_stock_is_marked_not_rejected(spark):
    stock = spark.createDataFrame(
        [
            {"inventory_id": "I", "pharmacy_id": "P", "product_id": "X", "current_stock": 5, "reorder_level": 0,
             "max_stock": 0, "expiry_date": dt.date(2024, 1, 1)},
        ],
        TABLE_DDL["inventory"],
    )
    got = silver.silver_inventory(to_bronze(stock, "inventory"), TODAY).first()
    assert got.has_expired_product and got.stock_percentage == 0.0 and got.stock_to_reorder_ratio is None


def test_future_event_is_rejected(spark):
    events = spark.createDataFrame(
        [("E1", "O", "Shipped", dt.datetime(2024, 7, 1), "Success"), ("E2", "O", "Shipped", dt.datetime(2024, 5, 1), "success")],
        "event_id string, order_id string, event_type string, event_timestamp timestamp_ntz, status string",
    ).withColumns({c: F.lit(None).cast("string") for c in ("location", "description", "operator", "equipment_id", "notes")})
    got = silver.silver_supply_chain_events(events, TODAY).collect()
    assert [(r.event_id, r.event_category, r.status_priority) for r in got] == [("E2", "Shipping", 1)]


def test_actions_are_spelled_one_way_and_parents_do_not_repeat_rows(spark):
    rows = spark.createDataFrame(
        [("1", "c", "X", " Added_To_Cart", dt.datetime(2024, 1, 1), "s"), ("2", "c", "?", "viewed", dt.datetime(2024, 1, 1), "s")],
        TABLE_DDL["product_interactions"],
    )
    products = spark.createDataFrame([("X",), ("X",)], "product_id string")
    got = silver.silver_reco_interactions(rows, products).collect()
    assert [(r.interaction_id, r.action_type) for r in got] == [("1", "added")]


@pytest.mark.parametrize(
    "actual, guess, want", [((100, 100), (90, 110), (10, 10, 10)), ((0, -5), (1, 1), (0, 0, 0))]
)
def test_forecast_metrics(spark, actual, guess, want):
    df = spark.createDataFrame(list(zip(actual, guess)), "a int, p int")
    assert tuple(inventory.forecast_metrics(df, "a", "p").first()) == pytest.approx(want)


def test_perfect_and_empty_classification(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (1, 1, 0.9)], "y int, p int, s double")
    row = inventory.classification_metrics(df, "y", "p", "s").first()
    assert (row.accuracy, row.f1, row.pr_auc) == (1.0, 1.0, 1.0)
    none = inventory.classification_metrics(df.filter("y > 5"), "y", "p").first()
    assert (none.accuracy, none.precision, none.recall) == (0.0, 0.0, 0.0)


def test_average_precision_with_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1), (1, 0.05)], "y int, s double")
    # Thresholds .9: P=1 dR=1/3; .8: P=2/3 dR=1/3; .1: no gain; .05: P=3/5 dR=1/3.
    got = inventory.average_precision(df, "y", "s").first().pr_auc
    assert got == pytest.approx((1 + 2 / 3 + 3 / 5) / 3)


def test_replenishment_summary(spark):
    df = spark.createDataFrame([(True, 10.0), (False, 0.0), (True, 5.5)], "below_rop boolean, reorder_qty double")
    assert tuple(inventory.replenishment_summary(df).first()) == (2, 2, 15.5)
    assert tuple(inventory.replenishment_summary(df.filter("reorder_qty > 99")).first()) == (0, 0, 0.0)


def test_reorder_point_values(spark):
    row = spark.range(1).select(
        inventory.reorder_point(F.lit(2.0), F.lit(1.0), 4.0).alias("a"),
        inventory.reorder_point(F.lit(0.0), F.lit(None).cast("double"), 7.0).alias("b"),
        inventory.reorder_point(F.lit(1.0), F.lit(1.0), 0.0, 0.5).alias("c"),
    ).first()
    assert row.a == pytest.approx(8 + 2 * 1.64485362695147) and row.b == 0.0 and row.c == 0.0


def test_demand_of_one_day_has_no_spread(spark):
    df = spark.createDataFrame([("X", "W", dt.date(2024, 5, 30), 3), ("X", "W", dt.date(2024, 5, 30), 4), ("X", "W", dt.date(2023, 1, 1), 99)],
                               "product_id string, warehouse_id string, order_date date, quantity int")
    row = inventory.demand_stats(df, TODAY).first()
    assert (row.daily_demand_mean, row.daily_demand_std, row.demand_std) == (7.0, None, 0.0)


def test_label_source_is_kept_out_of_features(spark):
    assert inventory.leak_guard(["month", "days_until_expiry"]) == ["month"]
    df = spark.range(3).select(F.lit(1).alias("month"), F.lit(1).alias("days_until_expiry"), F.lit(0).alias("will_expire_30d"))
    assert inventory.risk_feature_columns(df) == ["month"]
    with pytest.raises(ValueError, match="positive"):
        inventory.train_writeoff_classifier(df)


def test_unknown_category_is_named(spark):
    df = spark.createDataFrame([("X",), ("Y",)], "product_id string")
    products = spark.createDataFrame([("X", None), ("Y", "a"), ("Y", "b")], "product_id string, category string")
    got = sorted(map(tuple, merge_category(df, products, "category").collect()))
    assert got == [("X", "unknown"), ("Y", "a")]


def test_not_in_with_a_null_parent_finds_nothing(spark):
    child = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), (None,)], "k string")
    assert anti_join_fk(child, "k", parent, "k").count() == 1
    assert anti_join_fk(child, "k", parent, "k", null_aware=True).count() == 0
    assert anti_join_fk(child, "k", parent.dropna(), "k", null_aware=True).count() == 1


def test_combined_rule_repeats_a_row_per_broken_rule(spark):
    df = spark.createDataFrame([(None,), (1,), (5,), (9,)], "v int")
    assert sorted(r.rule for r in quality.dq_combined(df, "v", 2, 8).collect()) == ["max_value", "min_value", "not_null"]


def test_report_names_failures(spark):
    report = quality.dq_report({"orders": orders(spark, {}, {}).drop("bronze_model_name")})
    got = {r.check: (r.failures, r.status) for r in report.collect()}
    assert got["orders.order_id.unique"] == (1, "fail") and got["orders.quantity.accepted_range"] == (0, "pass")


def test_columns_helpers(spark):
    row = spark.range(1).select(
        C.guarded_ratio(F.lit(1), F.lit(0)).alias("zero"),
        C.guarded_ratio(F.lit(7), F.lit(2)).alias("half"),
        C.flag(F.lit(None).cast("boolean")).alias("unknown"),
        C.clip(F.lit(5.0), 0, 1).alias("clipped"),
        C.to_number(F.lit("x")).alias("number"),
        C.week_start(F.lit("2024-05-05").cast("date")).alias("week"),
        T.video_id(F.lit("https://youtu.be/abc?t=1")).alias("video"),
        T.excerpt(F.lit("abcdef"), 3).alias("excerpt"),
        T.safe_title(F.lit(" A/B: c_d ")).alias("title"),
        T.clean_str(F.lit(float("nan")), True).alias("nan"),
        inventory.region_cluster(F.lit("QLD")).alias("cluster"),
    ).first()
    assert (row.zero, row.half, row.unknown, row.clipped, row.number) == (0.0, 3.5, False, 1.0, 0.0)
    assert row.week == dt.date(2024, 4, 29) and (row.video, row.excerpt, row.title) == ("abc", "abc…", "AB_c_d")
    assert (row.nan, row.cluster) == ("", "C2")
    with pytest.raises(ValueError):
        C.resolve_column(spark.range(1), "a", "b")
    assert C.generate_date_partitions(spark, "2024-01-15", "2024-03-01").count() == 3
    assert C.generate_date_partitions(spark, "2024-01-30", "2024-02-02", "day").count() == 4


# --- documents ---------------------------------------------------------------------------


def test_pages_come_in_page_order(spark):
    pages = spark.createDataFrame([("d", 2, "b"), ("d", 1, "a")], "doc_id string, page int, text string")
    assert documents.assemble_doc_text(pages).first().text == "a\nb"
    assert documents.ocr_json(pages).first().json == '{"doc_id":"d","pages":[{"page":1,"text":"a"},{"page":2,"text":"b"}]}'


def test_patterns_on_literal_lines(spark):
    text = "Prescription Number: RX105711\nMedicare 2123 45670 1 ABN 51 824 753 556 Tel 02 9876 5432 AHPRA: 123456 on 3/4/2024"
    df = spark.createDataFrame([("d", text)], "doc_id string, text string")
    got = {}
    for row in documents.regex_fields(df).collect():
        got.setdefault(row.label, []).append(row.value)
    assert got["MEDICARE_NUMBER"] == ["2123 45670 1"] and got["ABN"] == ["51 824 753 556"]
    assert got["PHONE_AU"] == ["02 9876 5432"] and got["AHPRA_NUMBER"] == ["123456"] and got["DATE_DMY"] == ["3/4/2024"]
    literal = [r.value for r in documents.regex_fields(df, compat=True).collect() if r.label == "PRESCRIPTION_NUMBER"]
    assert literal == ["Number", "105711"] and got["PRESCRIPTION_NUMBER"] == ["105711"]


def test_doctor_is_the_second_person_unless_titled(spark):
    df = spark.createDataFrame(
        [("a", "Dr. X", ["P", "P", "D"]), ("b", "none", ["P", "Q"]), ("c", "none", ["P"])],
        "doc_id string, text string, people array<string>",
    )
    got = {r.doc_id: (r.patient_name, r.doctor_name) for r in documents.assign_fields(df, "people").collect()}
    assert got == {"a": ("P", "D"), "b": ("P", "Q"), "c": ("P", None)}


def test_nesting_drops_unknown_columns_and_survives_the_way_back(spark):
    df = spark.createDataFrame([("d", "RX1", "Ann", "?"), (None, "x", "y", "z")],
                               "doc_id string, prescription_number string, patient_name string, unknown string")
    nested = documents.nest_fields(df)
    assert nested.count() == 1 and "unknown" not in nested.first().json
    flat = documents.flatten_label(nested).first()
    assert (flat.prescription_number, flat.patient_name, flat.facility_abn) == ("RX1", "Ann", "")
    bare = spark.createDataFrame([("d", '{"prescription_number": "R"}')], "doc_id string, json string")
    row = documents.flatten_label(bare).first()
    assert row.prescription_number == "R" and row.patient_name is None and len(row) == 1 + len(DOCUMENT_FIELDS)


def test_field_sources(spark):
    some = spark.createDataFrame([("d", "m")], "doc_id string, extraction_method string")
    label = spark.createDataFrame([("l",)], "doc_id string")
    pick = documents.field_source_fallback
    assert pick(some, label, None).first().doc_id == "d"
    assert pick(some.limit(0), label, None).first().doc_id == "l"
    assert pick(None, None, label).first().doc_id == "l"
    assert pick(None, label, None, "ocr") is None
    assert pick(some, label, None, "labels").first().doc_id == "l"


def test_page_blocks(spark):
    html = (
        "<html><script>var t='</p>';</script><p>One &amp; <b>two</b></p><!-- no --><p>Open<p>Inner</p><h3>Head</h3>"
        "<ul><li> a  b </li><li>xy</li><li>a b</li></ul></html>"
    )
    df = spark.createDataFrame([(html,), ("<div>only text</div>",), ("",), (None,)], "html string")
    got = df.select(digest.html_paragraphs("html").alias("p"), digest.html_bullets("html").alias("b")).collect()
    assert got[0].p == "One & two\n\nOpen Inner Head a  b xy a b\n\nInner\n\nHead" and got[0].b == ["a b"]
    assert [r.p for r in got[1:]] == ["only text", "", ""]


def test_digest_section_follows_the_whole_text(spark):
    text = "".join(f"<p>paragraph {i}</p>" for i in range(12)) + "<p>at last the lakes</p>"
    df = spark.createDataFrame(
        [("T", None, None, None, None, None, text)],
        "title string, url string, author string, published string, reading_time string, tags array<string>, summary string",
    )
    found = digest.digest(df, "lakes").first()
    assert found.section == "focus" and found.excerpt.endswith("at last the lakes")


def test_classifier_with_many_categories(spark):
    rows = [(i, float(i % 7), f"category {i % 1000}", int(i % 10 == 0)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, current_stock double, category string, will_expire_30d int")
    model, columns, metrics = inventory.train_writeoff_classifier(df, id_columns=["id"], trees=3)
    assert columns == ["current_stock", "category"] and 0 <= metrics.first().accuracy <= 1
    gaps = df.withColumn("category", F.lit(None).cast("string"))
    assert inventory.predict_writeoff_risk(model, gaps, columns).count() == 2000


def test_digest_entry(spark):
    items = "".join(f"<li>item {i:02d}</li>" for i in range(42))
    df = spark.createDataFrame(
        [("T", "u", "A", None, "", ["x"], f"<p>about lakes</p>{items}"), ("", None, None, None, None, None, "")],
        "title string, url string, author string, published string, reading_time string, tags array<string>, summary string",
    )
    first, second = digest.digest(df, "LAKES", most_bullets=40).orderBy("section").collect()
    assert first.section == "focus" and first.omitted_bullets == 2 and len(first.bullets) == 40
    assert "- **URL:** u" in first.markdown and "_… 2 more list items omitted_" in first.markdown
    assert second.title == "(untitled)" and "_No plain-text excerpt._" in second.markdown


def test_export_and_progress(spark):
    docs = spark.createDataFrame([("a", "{}"), ("b", "{}")], "doc_id string, json string")
    assert {(r.file, r.total_files) for r in documents.export_annotated(docs).collect()} == {("a", 2), ("b", 2)}
    reviews = spark.createDataFrame([("reviewed",), ("needs_attention",), ("open",), (None,)], "status string")
    assert documents.review_progress(reviews).first().progress == 0.5


def test_features_read_the_orders_three_times(spark, tmp_path):
    """One shuffle of cells serves measures, distinct values and pairs; two narrow reads count orders."""
    changes = [
        {"order_id": f"O{i // 2}", "customer_id": f"C{i % 3}", "product_id": f"P{i % 4}", "quantity": i, "order_date": dt.date(2024, 1 + i % 5, 3)}
        for i in range(24)
    ]
    silver.silver_orders(orders(spark, *changes, {"customer_id": "C9", "product_id": "P9", "quantity": None}), audit=False).write.parquet(f"{tmp_path}/orders")
    read = spark.read.parquet(f"{tmp_path}/orders")
    products = spark.createDataFrame(
        [(f"P{i}", *["x"] * 5, 1.0, 2.0, False, False, False, 3, 4, 5) for i in (0, 1, 2, 3, 7, 9)],
        "product_id string, product_name string, category string, price_tier string, regulatory_class string, "
        "storage_classification string, unit_price double, profit_margin_percentage double, is_prescription boolean, "
        "is_controlled_substance boolean, requires_cold_chain boolean, expiry_months int, minimum_order_quantity int, lead_time_days int",
    )
    stock = spark.createDataFrame(
        [("C1", "P7", 1, 1, 1, 50.0, 1.0, 9, 9, "a", "b", "c", True, False, False)],
        "pharmacy_id string, product_id string, current_stock int, reorder_level int, max_stock int, stock_percentage double, "
        "stock_to_reorder_ratio double, days_until_expiry int, days_since_last_restock int, stock_status string, "
        "expiry_status string, stock_level_tier string, reorder_alert boolean, expiry_alert boolean, low_stock_alert boolean",
    )
    report = gold.gold_ml_ready_dataset(None, read, products, stock, TODAY, audit=False)
    rows = {(r.customer_id, r.product_id): r for r in report.collect()}
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") <= 3
    assert rows.keys() == {(f"C{i % 3}", f"P{i % 4}") for i in range(24)} | {("C1", "P7"), ("C9", "P9")}
    for c in ("C0", "C1", "C2"):
        own = [(i, x) for i, x in enumerate(changes) if x["customer_id"] == c]
        got = rows[c, "P0"]
        assert got.total_orders == len({x["order_id"] for _, x in own})
        assert got.unique_products_ordered == len({x["product_id"] for _, x in own})
        assert got.active_months == len({x["order_date"] for _, x in own})
        assert got.total_quantity_ordered == sum(i for i, _ in own)
    bought = [x for x in changes if x["product_id"] == "P0"]
    assert rows["C0", "P0"].product_total_orders == len({x["order_id"] for x in bought})
    assert rows["C0", "P0"].product_unique_customers == 3
    assert rows["C9", "P9"].total_quantity_ordered is None and rows["C9", "P9"].total_orders == 1
    assert rows["C1", "P7"].product_total_orders == 0
    given = gold.gold_ml_ready_dataset(gold.related_pairs(read, stock), read, products, stock, TODAY, audit=False)
    assert sorted(map(str, given.collect())) == sorted(map(str, rows.values()))
