"""The write-off queries write only the columns that training and scoring read."""

from __future__ import annotations

from types import SimpleNamespace

from checks import analytics_checks
from depotlens.operators import inventory


def test_only_needed_columns_are_written(spark, monkeypatch):
    rows = spark.createDataFrame(
        [(f"I{i}", i % 40, float(i), 0.5, "T1", "long text " * 20) for i in range(40)],
        "inventory_id string, days_until_expiry bigint, current_stock double, stock_pct double, category string, storage_location string",
    )
    written = []
    settle = analytics_checks.settle
    monkeypatch.setattr(analytics_checks, "settle", lambda df: written.append(df.columns) or settle(df))
    monkeypatch.setattr(analytics_checks, "layers", lambda feeds: SimpleNamespace(inventory=rows, products=None))
    monkeypatch.setattr(analytics_checks, "_site_demand", lambda feeds: None)
    monkeypatch.setattr(inventory, "writeoff_features", lambda *given: rows)
    monkeypatch.setattr(inventory, "train_writeoff_classifier", lambda found, id_columns: (None, None, None))
    found = analytics_checks._fitted_risk(None)[0]
    assert written == [["inventory_id", "will_expire_30d", "current_stock", "stock_pct", "category"]]
    assert found.where("will_expire_30d = 1").count() == 31
