"""Ids and their reading back come from remembered parts, and are those of the whole text."""

from __future__ import annotations

import random

import numpy as np
import pytest
import sentencepiece

from depotlens.llm import piece_transducer as pieces


@pytest.fixture(scope="module")
def machine():
    return pieces.Transducer(pieces.read_model())


def texts():
    pick = random.Random(3)
    signs = ["a", "B", "the", "ing", "9", "12", "_", "-", "(", "...", "é", "ß", "漢", "😀", "\n", "\t", " ", "  ", "▁", "\x00", "don't"]
    made = ["".join(pick.choice(signs) for _ in range(pick.randrange(60))) for _ in range(300)]
    return ["", " ", "a", "x" * 500, "it's (well-known), e.g. 3.5%...", *made]


def test_both_ways_is_what_the_library_gives(machine):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for text in texts() + texts():  # the second time from what is remembered
        octets, back = machine.both_ways(text)
        ids = np.frombuffer(octets, "<i4").tolist()
        assert ids == library.encode(text) == machine.encode(text), text
        assert back == machine.decode(ids) == text.replace("▁", " "), text
