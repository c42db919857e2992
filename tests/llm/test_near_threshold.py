"""Near-duplicates at other thresholds, and the pipeline's own, against brute force."""

from __future__ import annotations

import math
import random

import pytest

import corpus_pipeline
from depotlens.llm import minhash_join
from tests.llm.test_operators import brute_groups, same


def added_paragraphs(seed: int) -> list[tuple]:
    """Texts of 100 words and copies with a paragraph of 5 to 120 words appended."""
    draw, rows = random.Random(seed), []
    for i in range(60):
        words = [f"w{draw.randrange(10**6)}" for _ in range(220)]
        rows.append((10 * i, " ".join(words[:100])))
        for k, more in enumerate((5, 18, 20, 22, 25, 60, 120)):
            if (i + k) % 3 == 0:
                rows.append((10 * i + k + 1, " ".join(words[: 100 + more])))
    return rows


@pytest.mark.parametrize("width, percent", [(5, 80), (3, 50), (5, 30)])
def test_groups_at_other_thresholds(spark, width, percent):
    rows = added_paragraphs(percent)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    same(map(tuple, minhash_join.near_duplicates(table, width=width, percent=percent).collect()), brute_groups(rows, width, percent))


def test_agreements_keep_the_stated_loss():
    assert minhash_join.agreements(85) == (64, 10, 40)
    for percent in range(5, 100):
        size, prefix, least = minhash_join.agreements(percent)
        p = percent / 100
        short = sum(math.comb(size, k) * p**k * (1 - p) ** (size - k) for k in range(least))
        assert prefix <= size and short + (1 - p) ** prefix <= minhash_join.MISS


def test_stage_takes_five_words_and_four_fifths(spark):
    rows = added_paragraphs(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.keep_one_of_each_group(spark, docs, "").collect()}
    assert kept == {i for i, _, _, k in brute_groups(rows, 5, 80) if k} != {i for i, _, _, k in brute_groups(rows) if k}
