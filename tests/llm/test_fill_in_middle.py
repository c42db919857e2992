"""Piece tables against plain string cutting."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st

from checks.compare import compare, connect
from depotlens.llm import piece_table
from depotlens.llm.queries import CHECKS

MARKS = tuple(s.encode() for s in piece_table.SENTINELS)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text):
    """The contract on strings; also the output itself."""
    text = text or ""
    hexed = sha("1:" + ("" if doc_id is None else str(doc_id)))
    h1, h2, h3, h4 = (int(hexed[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    if not n or any(s in text for s in piece_table.SENTINELS) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, sha(text), sha(text)), text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        form, output = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, output = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    return (doc_id, n, form, a, b - a, sha(output), sha(text)), output


def odd_rows():
    rows = [(i, f"text {i} with É, 你好 and 🙂🙂 {'x' * i}") for i in range(60)]
    rows += [(60 + i, t) for i, t in enumerate(["a<P>b", "<S>", "x<M>", "<", "<P", "<<S", "P><S", "\0\n", "🙂", " "])]
    return rows + [(70, ""), (71, None), (None, "no id"), (None, None), (72, "é" * 200_001), (73, "same"), (73, "same")]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, t, "f", 1, 2, "o") for i, t in odd_rows()]
    return spark.createDataFrame(rows, "doc_id long, text string, form string, n int, h1 int, output string")


def test_against_strings(table):
    got = piece_table.fill_in_middle(table)
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    rows = Counter(tuple(r) for r in got.select(*names).collect())
    assert rows == Counter(brute(*row)[0] for row in odd_rows())
    assert {r[2] for r in rows} == {"plain", "psm", "spm"}


def test_outputs_and_way_back(table):
    made = piece_table.arrange(table)
    rows = Counter((r.doc_id, r.output) for r in made.collect())
    assert rows == Counter((i, brute(i, t)[1]) for i, t in odd_rows())
    back = piece_table.restore(made)
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter((i, t or "") for i, t in odd_rows())


def test_descriptors_name_the_output(table):
    texts = {i: (t or "").encode() for i, t in odd_rows() if i is not None}
    for row in piece_table.arrange(table).where("doc_id is not null").collect():
        buffers = (texts[row.doc_id], b"".join(MARKS))
        assert b"".join(buffers[p.buffer][p.start : p.start + p.length] for p in row.pieces) == row.output.encode()
        assert len(row.pieces) == (1 if row.form == "plain" else 6)


@given(st.text(alphabet="<PSM>é🙂a", max_size=40), st.integers(0, 40), st.integers(0, 40), st.sampled_from(sorted(piece_table.FORMS)))
def test_cut_arrange_find(text, one, two, form):
    if any(s in text for s in piece_table.SENTINELS):
        return
    import numpy as np

    first, second = sorted((min(one, len(text)), min(two, len(text))))
    own = text.encode()
    pieces = [(piece_table.TEXT, 0, len(own))]
    for cut in (first, second):
        pieces = piece_table.split(pieces, piece_table.byte_position(np.frombuffer(own, np.uint8), cut))
    buffers = (memoryview(own), memoryview(b"".join(MARKS)))
    output = b"".join(piece_table.stream(piece_table.arranged(pieces, form, MARKS), buffers))
    back = piece_table.found(output, form, MARKS)
    assert [output[s : s + n].decode() for _, s, n in back] == [text[:first], text[first:second], text[second:]]


def test_other_sentinels_and_shares(spark):
    docs = spark.createDataFrame([(i, "<P> is text here") for i in range(30)], "doc_id long, text string")
    marks = ("<|pre|>", "<|suf|>", "<|mid|>")
    made = piece_table.arrange(docs, sentinels=marks, transformed=100, suffix_first=100)
    assert {r.form for r in made.collect()} == {"spm"}
    assert {r.text for r in piece_table.restore(made, sentinels=marks).collect()} == {"<P> is text here"}


def test_empty_table(spark):
    assert piece_table.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_small_batches(table, monkeypatch):
    batch = __import__("pyarrow").RecordBatch.from_pydict({"text": ["abc", None, "d" * 50, "", "e"]})
    monkeypatch.setattr(piece_table, "BATCH_BYTES", 10)
    parts = list(piece_table._bounded(batch, "text"))
    assert sum(p.num_rows for p in parts) == 5 and len(parts) > 1
    assert [v for p in parts for v in p.column("text").to_pylist()] == ["abc", None, "d" * 50, "", "e"]


def test_query(spark):
    query, sql = CHECKS["op11_fill_in_middle"]
    assert compare(query(spark, "/root/testdata/sf0.001"), connect("/root/testdata/sf0.001"), sql) == ""
