"""The training sample where texts exceed its characters."""

from __future__ import annotations

import random

from depotlens.llm import toxicity


def tables(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in texts], "doc_id long, text string")
    labels = spark.createDataFrame(sorted({(i, i % 2) for i, _ in texts}), "doc_id long, label int")
    return docs, labels


def test_a_long_text_takes_no_other_texts_place(spark):
    draw = random.Random(3)
    short = [(i, " ".join(draw.choice("abcdef") * 4 for _ in range(20))) for i in range(40)]
    for long in range(40):  # whatever its place in the order by hash
        texts = [(i, "long text " * 5000 if i == long else t) for i, t in short]
        if long in (0, 1, 17, 30):
            got = toxicity.training_sample(*tables(spark, texts), rows=30, characters=9000).collect()
            whole = {t for i, t in short if i != long}
            assert whole < {r.text for r in got} and len(got) == 40
            for label in (0, 1):
                assert sum(len(r.text) for r in got if r.label == label) <= 9000
            (cut,) = [r.text for r in got if r.text not in whole]
            assert len(cut) > 5000


def test_long_texts_share_what_short_ones_leave(spark):
    texts = [(i, str(i) * n) for i, n in ((2, 100), (4, 300), (6, 4000), (8, 90000))]
    got = toxicity.training_sample(*tables(spark, texts), characters=2400).collect()
    assert sorted(len(r.text) for r in got) == [100, 300, 999, 999]


def test_repeats_of_an_id_come_last(spark):
    texts = [(2, f"text {k}") for k in range(9)] + [(2, "text 0")] * 9 + [(4, "four"), (6, "six")]
    got = toxicity.training_sample(*tables(spark, texts), rows=4).collect()
    assert {"four", "six"} < {r.text for r in got} and len({r.text for r in got}) == len(got) == 4


def test_passages_span_the_text():
    text = "".join(chr(0x4E00 + i % 20000) for i in range(100_000))
    found = toxicity.passages(text, 5500).split("\n")
    assert found[0] == text[: len(found[0])] and found[-1] == text[-len(found[-1]) :] and all(f in text for f in found)
    assert len(found) == 5 and sum(map(len, found)) + 4 <= 5500
    assert toxicity.passages(text, 100_000) == text


def test_scores_with_one_text_above_the_bound(spark, monkeypatch):
    draw, rows = random.Random(4), []
    for i in range(300):
        words = [draw.choice("alpha beta gamma delta omega".split()) + str(draw.randrange(9)) for _ in range(20)]
        rows.append((i, " ".join(words + ["grumblor"] * (i % 2))))
    long = [(i, f"{t} " * 2000) for i, t in rows if i < 2]
    docs, labels = tables(spark, long + rows[2:])
    monkeypatch.setattr(toxicity.training_sample, "__defaults__", (1500, 60_000))
    got = toxicity.score_toxicity(spark, docs, labels, label="label").where("held_out").collect()
    # The long texts still make most of the windows; when they displaced others, 35 of 56 were right.
    assert len({r.score for r in got}) > 2 and sum(r.predicted == r.doc_id % 2 for r in got) >= 0.75 * len(got)
