"""Counts of overlapping slices against the library on whole texts."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from tokenizers import Tokenizer

from depotlens.llm import token_counts
from depotlens.llm.queries import CHECKS


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(token_counts.tokenizer_path())


def expected(library, rows):
    return Counter(
        (i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in rows
    )


def pieces_of(draw: random.Random, size: int) -> str:
    parts = ["word", " it's", "'re", "'", " we'll", "\n\n", "   ", "\t", "<|endoftext|>", "<|endof", "12", "é", "你好", "🙂", "!!", " "]
    return "".join(draw.choice(parts) for _ in range(size))


def test_slices_against_the_library(spark, library):
    draw = random.Random(7)
    rows = [(i, pieces_of(draw, draw.randint(0, 400))) for i in range(80)]
    rows += [(100, "a" * 5000), (101, " " * 3000 + "x"), (102, "ab " * 40 + "c" * 900 + " d" * 300), (103, "<|endoftext|>" * 90)]
    rows += [(104, ""), (105, None), (None, "no id " * 200), (None, None), (106, "again and again " * 60), (106, "again and again " * 60)]
    docs = spark.createDataFrame([(i, t, 1, 2, "n") for i, t in rows], "doc_id long, text string, n_bytes int, key_id int, number string")
    got = token_counts.count_tokens(spark, docs, chunk=96, overlap=32)
    assert Counter(map(tuple, got.collect())) == expected(library, rows)


def test_wider_overlaps(spark, library):
    """A word longer than chunk and overlap: the first rounds fail and the last slice is the whole text."""
    rows = [(1, "x" * 700 + " end"), (2, "fine words " * 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = spark.sparkContext.broadcast(token_counts.read_tokenizer(token_counts.tokenizer_path()))
    long = docs.selectExpr("doc_id AS key_id", "0L AS key_hash", "text")
    ahead = token_counts.margin(held.value)
    got = token_counts._long_counts(spark, long, held, ahead, 64, 32)
    sizes = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in rows}
    assert {r.key_id: r.n_tokens for r in got.collect()} == sizes


def test_one_token_each_for_special_strings(spark, library):
    docs = spark.createDataFrame([(1, "a<|endoftext|>b<|endoftext|>")], "doc_id long, text string")
    assert token_counts.count_tokens(spark, docs).first().n_tokens == 4


def test_whole_texts_where_slices_prove_nothing(spark):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    assert token_counts.margin(token_counts.read_tokenizer(path)) is None
    rows = [(1, "Some  Words " * 50), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = token_counts.count_tokens(spark, docs, path=path, chunk=64, overlap=16)
    assert Counter(map(tuple, got.collect())) == expected(Tokenizer.from_file(path), rows)


def test_boundaries_are_words(library):
    text = "it's 你好 🙂x <|endoftext|> end"
    at, before = token_counts.boundaries(library.encode(text, add_special_tokens=False))
    for a, b in zip(at.tolist(), before.tolist()):
        assert b == len(library.encode(text[:a], add_special_tokens=False).ids)


@pytest.mark.parametrize("remembered", [3, 1 << 18])
def test_parts_of_words_add_up(library, monkeypatch, remembered):
    """Cutting before spaces between letters changes no count, however small the memory."""
    monkeypatch.setattr(token_counts, "REMEMBERED", remembered)
    draw = random.Random(3)
    texts = [pieces_of(draw, draw.randint(0, 60)) for _ in range(300)]
    texts += ["it 's we 'll", "été où à l'œuvre", "Ω ω Я я", "a  b", "a \u0300b", "x" * 200 + " y", "a\u00a0b c", "<|endoftext|> a <|endoftext|>b c"]
    known: dict[str, int] = {}
    got = [n for start in range(0, len(texts), 40) for n in token_counts._sizes(library, texts[start : start + 40], known)]
    assert got == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert all(len(part) <= token_counts.SHORT for part in known)


def test_empty_table(spark):
    assert token_counts.count_tokens(spark, spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = CHECKS["op13_token_counts"][0](spark, folder)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert Counter(map(tuple, got.collect())) == expected(library, rows)
