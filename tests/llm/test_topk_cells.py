"""Exact search without a join: bundles of queries hold their best while stripes of shards pass."""

from __future__ import annotations

import random

import numpy as np
import pytest

from depotlens.llm import topk_search
from tests.llm.test_operators import brute_top


@pytest.mark.parametrize("big", [False, True])
def test_bundles_and_stripes_against_brute_force(spark, monkeypatch, big):
    for name, value in (("QUERY_ROWS", 3), ("SHARD_ROWS", 5), ("BUNDLE_BLOCKS", 2), ("STRIPE_SHARDS", 4)):
        monkeypatch.setattr(topk_search, name, value)
    draw = random.Random(4)
    size = 1 << 30 if big else 4
    vectors = [(draw.randrange(200), [draw.randint(-size, size) for _ in range(3)]) for _ in range(150)]
    vectors += [(300 + i, [1, 0, 1]) for i in range(60)] + [(400, [70_000, 1]), (401, [1, 1]), (402, [1 << 40, 2])]
    table = spark.createDataFrame(vectors, "vec_id long, numbers array<long>")
    queries = {}
    for v, numbers in vectors:
        if v % 7 == 0 or v >= 400:
            queries[v] = min(queries.get(v, numbers), numbers)
    asked = spark.createDataFrame(list(queries.items()), table.schema)
    found = topk_search.search(asked, table, 6)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan
    got = sorted(map(tuple, found.collect()))
    assert got == sorted(brute_top(vectors, queries.items(), 6))


def test_running_lists_equal_one_product():
    draw = np.random.default_rng(1)
    queries, shards = draw.integers(-3, 4, (300, 5)), draw.integers(-3, 4, (20, 50, 5))
    held = topk_search._Held(np.arange(300), queries, 4)
    for i, shard in enumerate(shards):
        held.meet(np.arange(i * 50, i * 50 + 50), shard)
    scores = queries @ shards.reshape(-1, 5).T
    scores[np.arange(300), np.arange(300)] = -(1 << 40)
    for q in range(300):
        want = sorted((-s, v) for v, s in enumerate(scores[q].tolist()))[:4]
        assert [(-1 - x, v) for x, v in zip(held.less[q].tolist(), held.found[q].tolist())] == [(-s, v) for s, v in want]
