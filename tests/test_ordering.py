"""Ordering helpers against brute force on small tables, with ties, copies and heavy groups."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from depotlens.operators import ordering, recommend, splits
from depotlens.operators.neighbours import item_knn_cosine


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_temporal_split_known_sizes(spark):
    df = spark.range(20).select(
        F.col("id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,cast(id as int))").alias("timestamp")
    )
    train, later = splits.temporal_split(df, 0.2)
    assert (train.count(), later.count()) == (16, 4)
    assert later.agg(F.min("timestamp")).first()[0] >= train.agg(F.max("timestamp")).first()[0]


def test_temporal_split_small_table_all_train(spark):
    df = spark.range(9).select("id", F.lit("2024-01-01").alias("timestamp"))
    train, later = splits.temporal_split(df, smallest=10)
    assert (train.count(), later.count()) == (9, 0)


def test_temporal_split_drops_missing_times(spark):
    df = spark.createDataFrame([(i, None if i % 2 else f"2024-01-{i + 1:02d}") for i in range(28)], "id int, timestamp string")
    train, later = splits.temporal_split(df, 0.25)
    assert (train.count(), later.count()) == (10, 4)


@pytest.mark.parametrize("direct", [0, 12, 1_000_000])
def test_temporal_split_of_equal_moments_and_copies(spark, monkeypatch, direct):
    """By levels to the end, by levels and then directly, and directly."""
    monkeypatch.setattr(ordering, "DIRECT_ROWS", direct)
    # A third of the rows share a moment, and half of those are copies of one row.
    data = [(i, "2024-01-01 00:00:00") for i in range(10)] + [(99, "2024-01-05 00:00:00")] * 15
    data += [(100 + i, "2024-01-05 00:00:00") for i in range(5)]
    df = spark.createDataFrame(data, "id int, t string").select("id", F.col("t").cast("timestamp_ntz").alias("timestamp"))
    for fraction in (0.1, 0.4, 0.6):
        train, later = splits.temporal_split(df, fraction)
        assert train.count() == max(1, int(30 * (1 - fraction)))
        assert Counter(rows_of(train, "id")) + Counter(rows_of(later, "id")) == Counter((i,) for i, _ in data)


def test_copies_are_made_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(ordering, "COPIES_PER_TASK", 7)
    one = spark.createDataFrame([(1,)], "id int")
    assert ordering._copies(one, 23).count() == 23
    assert ordering._copies(one, 0).count() == 0


def test_demand_split_keeps_a_row_on_each_side(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, d string").select(
        "id", F.col("d").cast("date").alias("order_date")
    )
    train, later = splits.demand_split(df, 0.0)
    assert rows_of(train, "id") == [(1,)] and rows_of(later, "id") == [(2,)]


def test_stratified_split_keeps_class_shares(spark):
    df = spark.range(100).select("id", (F.col("id") % 10 == 0).cast("int").alias("label"))
    train, held = splits.stratified_split(df, "label", 0.2, id_columns=["id"])
    assert dict(rows_of(held.groupBy("label").count(), "label", "count")) == {0: 18, 1: 2}
    assert train.count() == 80 and train.join(held, "id").count() == 0


def test_stratified_split_of_many_classes_and_null(spark):
    """Ten thousand classes of 1 to 9 rows, a null class, and a class of copies, in one plan."""
    rows = spark.range(10_000).select(F.explode(F.sequence(F.lit(1), F.col("id") % 9 + 1)).alias("n"), F.col("id").alias("label"))
    null = spark.range(25).select(F.col("id").cast("int").alias("n"), F.lit(None).cast("bigint").alias("label"))
    copies = spark.range(10).select(F.lit(1).alias("n"), F.lit(-1).cast("bigint").alias("label"))
    df = rows.unionByName(null).unionByName(copies)
    train, held = splits.stratified_split(df, "label", 0.5)
    got = dict(rows_of(held.groupBy("label").count(), "label", "count"))
    want = {i: round((i % 9 + 1) * 0.5) for i in range(10_000)} | {None: round(25 * 0.5), -1: 5}
    assert got == {c: n for c, n in want.items() if n}
    assert train.count() + held.count() == df.count()
    assert train.unionByName(held).exceptAll(df).isEmpty() and held.exceptAll(splits.stratified_split(df, "label", 0.5)[1]).isEmpty()


def test_positions_and_running_totals(spark):
    values = [random.Random(3).randrange(50) for _ in range(200)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int")
    got = dict(rows_of(ordering.with_position(df, F.col("v").desc(), F.col("id")), "id", "position"))
    want = sorted(range(200), key=lambda i: (-values[i], i))
    assert [got[i] for i in want] == list(range(200))
    per = df.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    got = dict(rows_of(ordering.running_totals(per, [F.col("v")], "n"), "v", "running_n"))
    assert got == {v: sum(1 for x in values if x <= v) for v in set(values)}


def test_factorize_codes_follow_value_order_and_nulls_are_empty_text(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "word string")
    assert sorted(rows_of(ordering.factorize(df, "word"), "word", "word_code")) == [("", 0), ("a", 1), ("b", 2), ("b", 2)]
    two = df.withColumn("other", F.lit("x"))
    coded = ordering.factorize_many(two, {"word": "w", "other": "o"})
    assert sorted(rows_of(coded, "word", "w", "o")) == [("", 0, 0), ("a", 1, 0), ("b", 2, 0), ("b", 2, 0)]


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_nth_missing(spark, block):
    chance = random.Random(5)
    taken = {g: sorted(chance.sample(range(40), n)) for g, n in ((1, 0), (2, 5), (3, 20), (4, 35))}
    wants = [(g, r) for g in taken for r in range(40 - len(taken[g]))]
    got = ordering.nth_missing(
        spark.createDataFrame([(g, p) for g, ps in taken.items() for p in ps], "g int, p int"),
        spark.createDataFrame(wants, "g int, r int"),
        "g",
        "p",
        "r",
        block=block,
    )
    free = {g: [p for p in range(40) if p not in ps] for g, ps in taken.items()}
    assert sorted(rows_of(got, "g", "r", "position")) == sorted((g, r, free[g][r]) for g, r in wants)


def test_topk_breaks_ties_by_id(spark):
    df = spark.createDataFrame([(1, i, s) for i, s in ((5, 1.0), (3, 1.0), (4, 2.0))], "g int, id int, s double")
    got = ordering.topk_per_group(df, "g", 2, F.col("s").desc(), F.col("id"), rank="rank")
    assert sorted(rows_of(got, "id", "rank")) == [(3, 2), (4, 1)]


def brute_neighbours(vectors, k):
    ids = sorted(vectors)
    unit = {}
    for i in ids:
        v = np.array(vectors[i], dtype=float)
        length = np.sqrt((v * v).sum())
        unit[i] = v / length if length else v
    out = set()
    for i in ids:
        near = sorted((round(1 - float(np.clip(unit[i] @ unit[j], -1, 1)), 9) + 0.0, j) for j in ids if j != i)
        out |= {(i, j, d, n + 1) for n, (d, j) in enumerate(near[:k])}
    return out


@pytest.mark.parametrize("per_cell", [5, 40, 10_000])
def test_knn_equals_brute_force_with_copies_and_zero_vectors(spark, per_cell, monkeypatch):
    from depotlens.operators import neighbours

    monkeypatch.setattr(neighbours, "CHUNK", 16)
    chance = np.random.default_rng(11)
    centres = chance.normal(size=(6, 4))
    vectors = {i: (centres[i % 6] + 0.05 * chance.normal(size=4)).round(3).tolist() for i in range(90)}
    for i in range(90, 130):  # a third of all rows are copies of one vector
        vectors[i] = vectors[0]
    vectors[130] = vectors[131] = [0.0] * 4
    df = spark.createDataFrame(list(vectors.items()), "product_id bigint, features array<double>")
    got = item_knn_cosine(df, k=4, vectors_per_cell=per_cell)
    found = {
        (a, b, round(d, 9) + 0.0, r)
        for a, b, d, r in rows_of(got, "product_id", "similar_product_id", "similarity_score", "rank")
    }
    assert found == brute_neighbours(vectors, 4)


def test_negatives_are_never_bought_and_never_repeat(spark):
    base = spark.createDataFrame(
        [(1, p, 1) for p in range(8)] + [(2, 0, 1), (2, 1, 0), (3, 5, 0)] + [(4, p, 1) for p in range(10)],
        "customer_id bigint, product_id bigint, label int",
    )
    products = spark.range(10).select(F.col("id").alias("product_id"))
    got = rows_of(
        recommend.negative_samples(base, products, 3), "customer_id", "positive_product_id", "product_id", "label"
    )
    per = Counter((c, p) for c, p, _, _ in got)
    # Customer 1 has two products left, so two for each of eight; customer 4 has none left.
    assert per == {**{(1, p): 2 for p in range(8)}, (2, 0): 3}
    assert all(n in (8, 9) for c, _, n, _ in got if c == 1) and all(n != 0 for c, _, n, _ in got if c == 2)
    assert len({(c, p, n) for c, p, n, _ in got}) == len(got) and {x[3] for x in got} == {0}


def test_with_negatives_appends_rows(spark):
    base = spark.createDataFrame([(1, 0, 1, 3)], "customer_id bigint, product_id bigint, label bigint, n int")
    products = spark.range(5).select(F.col("id").alias("product_id"))
    got = recommend.with_negatives(base, products)
    assert got.count() == 3 and got.filter(F.col("label") == 0).filter(F.col("n").isNull()).count() == 2
