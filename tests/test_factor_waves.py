"""Factors are fitted in waves of blocks, and no wave leaves its sent factors on disk."""

from __future__ import annotations

import time

import numpy as np
import pytest

from depotlens.operators import factor_fit, recommend
from depotlens.session import settle
from tests.test_leftovers import shuffle_files


@pytest.fixture(scope="module")
def weights(spark):
    draw = np.random.default_rng(3)
    cells = [(int(u) * 7 - 50, int(i) - 5, float(draw.integers(1, 9)) / 10) for u in range(40) for i in range(25) if draw.random() < 0.2]
    cells += [(-50, 0, 0.4), (-50, 0, 0.4), (6, 1, -0.5), (100_000, 3, 0.0)]
    return settle(spark.createDataFrame(cells, "customer_id bigint, product_id bigint, weight double"))


def vectors(frame) -> dict[int, np.ndarray]:
    return {r.id: np.array(r.features) for r in frame.collect()}


def test_waves_give_the_same_factors_and_leave_no_shuffle_files(spark, weights, monkeypatch):
    before = shuffle_files(spark)
    whole = recommend.als_implicit(weights, factors=3, iterations=2)
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not [name for name in left if name.endswith(".data")]
    monkeypatch.setattr(factor_fit, "SENT_BYTES", 1)
    side = factor_fit.Side(factor_fit.cells(weights, "customer_id", "product_id", "weight"), 10)
    assert side.waves(3) == [(0, 4), (4, 8), (8, 10)]
    waved = recommend.als_implicit(weights, factors=3, iterations=2)
    for one, other in ((whole.userFactors, waved.userFactors), (whole.itemFactors, waved.itemFactors)):
        a, b = vectors(one), vectors(other)
        assert a.keys() == b.keys() and all(np.allclose(a[k], b[k], atol=1e-6) for k in a)


def test_users_solve_their_equations(spark, weights):
    model = recommend.als_implicit(weights, factors=3, iterations=2)
    x, y = vectors(model.userFactors), vectors(model.itemFactors)
    rows = weights.collect()
    assert x.keys() == {r.customer_id for r in rows} and y.keys() == {r.product_id for r in rows}
    shared = sum(np.outer(v, v) for v in y.values())
    for user in x:
        mine = [(y[r.product_id], r.weight) for r in rows if r.customer_id == user]
        left = shared + sum(abs(w) * np.outer(v, v) for v, w in mine) + 0.01 * sum(w > 0 for _, w in mine) * np.eye(3)
        right = sum((1 + w) * v * (w > 0) for v, w in mine)
        assert np.allclose(left @ x[user], right, atol=1e-4)


def test_what_is_no_number_is_an_error(spark):
    for row in ((None, 1, 1.0), (1, 1 << 40, 1.0), (1, 1, None), (1, 1, float("nan"))):
        with pytest.raises(Exception, match="known"):
            recommend.als_implicit(spark.createDataFrame([row, (1, 2, 1.0)], "customer_id bigint, product_id bigint, weight double"), 2, 1)
