"""The corpus pipeline and the registered queries over the smallest tables."""

from __future__ import annotations

import random

import pytest

import __spark_entry__
import corpus_pipeline
from checks.compare import compare, connect
from depotlens.llm import decontaminate, language_id, piece_transducer
from depotlens.llm.queries import CHECKS
from tests.llm.test_operators import brute_contamination, brute_groups, brute_lines, library, odd_texts  # noqa: F401

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(CHECKS))
def test_registered(spark, name):
    build, sql = CHECKS[name]
    df = build(spark, FOLDER)
    if sql:
        assert compare(df, connect(FOLDER), sql) == ""
    else:
        assert df.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert {"pipeline", name} <= __spark_entry__.queries().keys()


@pytest.mark.parametrize("name", ["op6_line_dedup", "op9_decontaminate"])
def test_native_plans_hold_no_python(spark, name):
    plan = CHECKS[name][0](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan and "CartesianProduct" not in plan


def write(spark, tmp_path, rows, items):
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "r") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")


def test_stages_against_brute_force(spark, tmp_path, library):  # noqa: F811
    """What each stage keeps follows from its own input by brute force; the result from the last one."""
    draw = random.Random(12)
    item = " ".join(draw.choice("red green blue grey pink".split()) + str(k) for k in range(20))
    rows = odd_texts() + [(50, item), (51, f"other text {item}"), (52, "\n".join(odd_texts()[12][1].split("\n")[:3]))]
    write(spark, tmp_path, rows, [(1, item), (2, None)])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = rows
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), stage(spark, docs, str(tmp_path)).schema)
        if at == 0:
            found = [(r.doc_id, r.row.text) for r in language_id.identify(spark, before, whole=True).collect() if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_SHARE]
            assert {i for i, _ in found}.isdisjoint({5, 6, 7, 13}) and len(found) >= 12
            kept = found
        elif at == 1:
            kept = [(i, t) for i, n, gone, t in brute_lines(kept) if gone == 0 or gone < n]
        elif at == 2:
            kept = list(dict.fromkeys((i, t) for (i, t), g in zip(kept, brute_groups(kept, corpus_pipeline.NEAR_WIDTH, corpus_pipeline.NEAR_PERCENT)) if g[3]))
        elif at == 3:
            kept = [(i, t) for (i, t), c in zip(kept, brute_contamination(kept, [(1, item)])) if not c[5]]
        else:
            kept = [(i, library.encode(t)) for i, t in kept]
            assert sorted(map(repr, ((r.doc_id, r.token_ids) for r in docs.collect()))) == sorted(map(repr, kept))
            break
        assert docs.columns == before.columns
        assert sorted(map(repr, ((r.doc_id, r.text) for r in docs.collect()))) == sorted(map(repr, kept))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(kept) > 5


def test_columns_without_an_order_and_repeated_rows(spark):
    text = "one text of more than five words here"
    rows = [(1, text, {"a": 2}), (1, text, {"a": 1}), (2, "quite another text of some more words", {"b": 3}), (3, text + " too", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra map<string,int>")
    got = corpus_pipeline.keep_one_of_each_group(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.extra) for r in got.collect() if r.doc_id != 3) == [(1, {"a": 1}), (2, {"b": 3})]


def test_pipeline_of_an_empty_table(spark, tmp_path):
    write(spark, tmp_path, [], [(1, "a b c")])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_index_is_built_from_stored_terms(spark):
    rows = decontaminate.keyed(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string"))
    phrases = decontaminate.phrases_of(spark.createDataFrame([(1, "b c"), (2, "x y")], "item_id long, text string"))
    plans, index = decontaminate.build_index(rows, phrases)
    assert [tuple(r.phrase) for r in plans.collect()] == [("b", "c")]
    assert {r.term for r in index.collect()} == {"b", "c"}


def test_transducer_is_sent_whole():
    import pickle

    machine = piece_transducer.Transducer(piece_transducer.read_model())
    copy = pickle.loads(pickle.dumps(machine))
    assert copy.encode("Hello   world 你\n") == machine.encode("Hello   world 你\n")
