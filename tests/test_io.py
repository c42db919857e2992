"""Files, tables, catalogue and the landing stream."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from depotlens.operators.bronze import BRONZE_MODELS, to_bronze
from depotlens.plans.medallion import Medallion
from depotlens.plans.prescriptions import extract_fields, nested_documents
from depotlens.session import checkpoint_folder, release, settle
from depotlens.sources import catalog, readers, writers
from depotlens.sources.schemas import TABLE_COLUMNS, TABLE_DDL
from depotlens.sources.star_schema import AS_OF, StarSchemaFeeds
from depotlens.streaming.landing import append_bronze

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def feeds(spark):
    return StarSchemaFeeds(spark, FOLDER)


def test_every_raw_table_has_its_columns(feeds):
    assert set(BRONZE_MODELS) == set(TABLE_DDL)
    for table in TABLE_DDL:
        assert set(TABLE_COLUMNS[table]) <= set(feeds[table].columns), table


def test_csv_round_trip_and_absent_tables(spark, feeds, tmp_path):
    folder = str(tmp_path / "csv")
    writers.write_csv_all({t: feeds[t] for t in ("suppliers", "orders")}, folder)
    tables = readers.scan_csv_tables(spark, folder)
    assert set(tables) == {"suppliers", "orders"}
    assert tables["orders"].count() == feeds.orders.count()
    assert dict(tables["orders"].dtypes)["order_date"] == "date"
    assert dict(readers.scan_csv_tables(spark, folder, infer=True)["suppliers"].dtypes)["lead_time_days"] == "int"
    with pytest.raises(FileNotFoundError):
        readers.scan_csv_tables(spark, str(tmp_path / "nothing"))


def test_medallion_runs_from_csv(spark, feeds, tmp_path):
    folder = str(tmp_path / "csv")
    names = ("orders", "products", "pharmacies", "inventory")
    writers.write_csv_all({t: feeds[t] for t in names}, folder)
    raw = {t: readers.add_lineage(df, "local_csv", "local") for t, df in readers.scan_csv_tables(spark, folder).items()}
    lake = Medallion(raw, AS_OF)
    lake.persist_silver(str(tmp_path / "silver"), "orders")
    report = lake.financial_analytics()
    assert report.count() > 0 and "gold_processed_at" in report.columns
    assert {"_source", "bronze_processed_at", "silver_processed_at"} <= set(lake.products.columns)
    direct = Medallion(feeds, AS_OF, audit=False).financial_analytics()
    assert report.count() == direct.count()


def test_raw_tables_append_and_counts(spark, feeds):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop_raw")
    name = writers.write_raw(feeds.suppliers, "suppliers", "shop_raw", "test", "b1", mode="overwrite")
    writers.write_raw(feeds.suppliers, "suppliers", "shop_raw", "test", "b2")
    n = feeds.suppliers.count()
    got = {r.table: r.rows for r in writers.verify_counts(spark, name, "shop_raw.nothing").collect()}
    assert got == {name: 2 * n, "shop_raw.nothing": None}
    assert catalog.table_row_count(spark, name) == 2 * n
    listed = catalog.list_tables(spark, "shop_raw").collect()
    assert ("shop_raw", "healthcare_suppliers", "raw") in {(r.schema, r.table, r.layer) for r in listed}
    assert catalog.preview_table(spark.table(name), 3).count() == min(10, 2 * n)


def test_table_preference_and_lenient_dates(spark, tmp_path):
    spark.range(3).withColumnRenamed("id", "event_id").write.mode("overwrite").saveAsTable("bronze_writeoff_events")
    found = readers.scan_with_fallback(
        spark, "writeoff_events", ["silver_writeoff_events"], ["bronze_writeoff_events"], str(tmp_path)
    )
    assert found.count() == 3
    (tmp_path / "expiry_batches.csv").write_text(
        "batch_id,product_id,warehouse_id,expiry_date,quantity,cost_basis\nb1,X,W,2024-05-01,1,2.0\nb2,X,W,soon,1,2.0\n"
    )
    got = readers.scan_with_fallback(spark, "expiry_batches", csv_folder=str(tmp_path))
    assert dict(got.dtypes)["expiry_date"] == "date" and got.filter(F.col("expiry_date").isNull()).count() == 1
    inputs = readers.scan_inputs(spark, {"orders": {"csv_folder": str(tmp_path)}})
    assert inputs == {"orders": None}


def test_scored_and_catalogue_tables(spark):
    writers.write_scored_table(spark.range(2), "scored", "computed_at")
    assert "computed_at" in spark.table("scored").columns
    assert writers.write_catalog_table(spark.range(2), "doc_pages")
    assert not writers.write_catalog_table(spark.range(0), "doc_pages")
    assert spark.table("doc_pages").count() == 2


def test_parquet_and_settled_frames(spark, tmp_path):
    writers.write_parquet(spark.range(4), str(tmp_path / "p"))
    assert readers.scan_parquet(spark, str(tmp_path / "p")).count() == 4
    kept = settle(spark.range(5).withColumn("r", F.rand()))
    assert kept.collect() == kept.collect()
    assert checkpoint_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    where = kept.inputFiles()[0].rpartition("/")[0]
    assert readers.path_exists(spark, where)
    release(spark)
    assert not readers.path_exists(spark, where)


def test_delimited_text_with_line_breaks_comes_back_whole(spark, tmp_path):
    rows = [(1, "two\nlines, \"quoted\""), (2, "  spaces  "), (3, ""), (4, None), (5, "a\r\nb\rc"), (6, "back\\slash\\n")]
    table = spark.createDataFrame(rows, "supplier_id string, supplier_name string".replace("supplier_id string", "supplier_id int"))
    writers.write_csv_all({"t": table}, str(tmp_path), bytes_per_file=40)
    again = readers.scan_csv(spark, f"{tmp_path}/t.csv", "supplier_id int, supplier_name string")
    assert sorted(map(tuple, again.collect())) == rows
    (tmp_path / "bad.csv").write_text("supplier_id,supplier_name\n1,a\nx,b,c\n")
    with pytest.raises(Exception, match="MALFORMED"):
        readers.scan_csv(spark, f"{tmp_path}/bad.csv", "supplier_id int, supplier_name string").collect()


def test_json_documents(spark, tmp_path):
    (tmp_path / "d1.json").write_text(json.dumps({"doc_id": "d1", "pages": [{"page": 1, "text": "Rx #AB123"}]}, indent=1))
    (tmp_path / "d2.json").write_text(json.dumps({"pages": []}))
    (tmp_path / "bad.json").write_text('{"doc_id": ')
    docs = readers.scan_json_docs(spark, str(tmp_path))
    assert {r.doc_id for r in docs.collect()} == {"d1", "d2"}
    labels = readers.scan_json_labels(spark, str(tmp_path))
    assert {r.doc_id for r in labels.collect()} == {"d1", "d2"}
    pages = docs.select("doc_id", F.inline("pages"))
    assert extract_fields(pages).first().prescription_number == "AB123"
    out = tmp_path / "out"
    writers.write_ocr_json(pages, str(out / "ocr"))
    again = readers.scan_json_docs(spark, str(out / "ocr"), lines=True)
    assert again.count() == 1 and again.first().pages[0].text == "Rx #AB123"
    writers.write_field_json(extract_fields(pages), str(out / "folders"), folder_per_document=True)
    assert (out / "folders" / "doc_id=d1").is_dir()
    writers.write_field_json(extract_fields(pages), str(out / "fields"))
    assert spark.read.json(str(out / "fields")).first().prescription_number == "AB123"
    assert json.loads(nested_documents(pages).first().json)["prescription_number"] == "AB123"


def test_articles_come_in_file_order(spark, tmp_path):
    for name in ("b", "a"):
        (tmp_path / f"{name}.json").write_text(json.dumps({"title": name, "tags": ["x"]}, indent=1))
    assert [r.title for r in readers.scan_article_json(spark, str(tmp_path)).collect()] == ["a", "b"]


def test_landing_stream_appends_each_file_once(spark, feeds, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    batch = feeds.suppliers.limit(3)
    for total in (3, 6):
        batch.write.mode("append").option("header", True).csv(source)
        query = append_bronze(spark, source, "suppliers", target, state)
        query.awaitTermination()
        assert spark.read.parquet(target).count() == total
    assert set(spark.read.parquet(target).columns) == set(
        to_bronze(readers.add_lineage(feeds.suppliers, "s", "b"), "suppliers").columns
    )
