"""A task holds the texts of a few pages, however many its Arrow batch has."""

from __future__ import annotations

import pyarrow as pa

from depotlens.functions import text
from depotlens.operators import digest


def test_a_batch_is_read_a_few_pages_at_a_time():
    taken = []

    def batches():
        for size in (0, 1000):
            taken.append(size)
            yield pa.array([f"<p>{i}</p><li>x</li>" for i in range(size)], pa.string())

    found = text._read_batches(batches())
    first = next(found)
    assert taken == [0, 1000] and len(first) == text.PAGES_AT_ONCE < 1000
    rest = [row for part in [first, *found] for row in part.to_pylist()]
    assert rest == [{"paragraphs": [str(i)], "items": ["x"]} for i in range(1000)]


def test_rows_stay_beside_their_texts(spark):
    rows = [(i, None if i % 7 == 0 else "" if i % 7 == 1 else f"<p>a{i}</p><p>b</p><li> one </li>") for i in range(500)]
    got = spark.createDataFrame(rows, "page_id int, html string").coalesce(1)
    got = got.select("page_id", digest.html_paragraphs("html").alias("p"), digest.html_bullets("html").alias("b")).collect()
    want = {i: ("", []) if i % 7 < 2 else (f"a{i}\n\nb", ["one"]) for i, _ in rows}
    assert {r.page_id: (r.p, r.b) for r in got} == want
