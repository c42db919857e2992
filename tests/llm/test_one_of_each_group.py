"""One document of a near-duplicate group stays, also among null and shared ids."""

from __future__ import annotations

import corpus_pipeline


def test_null_and_shared_ids(spark):
    base = [" ".join(f"{k}w{i}" for i in range(100)) for k in "abcd"]
    rows = [(None, base[0]), (None, base[0] + " x"), (None, base[0] + " y"), (7, base[1]), (7, base[1] + " x"), (8, base[1])]
    rows += [(None, base[2]), (3, base[2] + " z"), (5, base[3]), (5, base[3]), (None, ""), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, "").collect()
    assert sorted(r.text[:1] for r in kept) == ["", "", "a", "b", "c", "d"]
    assert {r.doc_id for r in kept} == {None, 7, 3, 5, 6}
