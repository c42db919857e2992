"""The sharded trie against one built in a dictionary."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from checks.compare import compare, connect
from depotlens.llm import prefix_trie
from depotlens.llm.queries import CHECKS

SCHEMA = "conv_id long, turn long, role string, text string, depth int, path string, words int, family int"


def brute(rows):
    """Nodes by recursion over whole tuples of turns."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            turns[c].append(((turn is not None, turn or 0), role, key, (role, text)))
    own = {c: [t[-1] for t in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        leaves[path] = sum(leaves[p] for p in children[path]) or 1
        saved[path] = (len(members[path]) - 1) * words + sum(saved[p] for p in children[path])
    return Counter(
        (
            min(members[p]),
            len(p),
            min(members[p[:-1]]) if p else None,
            len(members[p]),
            len(children[p]),
            leaves[p],
            saved[p],
            hashlib.sha256(",".join(map(str, sorted(c for c in members[p] if built[c] == p))).encode()).hexdigest(),
        )
        for p in members
    )


def made_rows(seed: int, size: int) -> list[tuple]:
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-60, 4 * size), size):
        for turn in range(draw.choice((1, 1, 2, 3, 5, 9))):
            rows.append((c, turn, draw.choice(("user", "assistant")), draw.choice(("hi there", "yes", "one two three", "no\n"))))
    rows += [(5000 + i, t, "user", "the same words") for i in range(size // 2) for t in range(4)]  # a third of all
    rows += [(8000, t, "user", f"turn {t}") for t in range(300)]
    return rows


ODD = [
    (1, None, "user", "null first"),
    (1, 0, "user", "later"),
    (2, 0, None, None),
    (3, 0, "", ""),
    (4, 1, "b", "tie"),
    (4, 1, "a", "tie"),
    (5, 1, "a", "again"),
    (5, 1, "a", "again"),
    (None, 0, "user", "no conversation"),
    (20, 0, "user", "x" * 300_000 + " y"),
    (-20, 0, "user", "negative"),
    (-25, 0, "user", "negative"),
    (45, 0, "user", "no first of its family"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "p", 2, 3) for r in rows], SCHEMA)


def names(df):
    return Counter(map(tuple, df.select(prefix_trie.COLUMNS).collect()))


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_against_a_dictionary(spark, shards):
    rows = made_rows(shards, 120) + [(c + 90_000 if c is not None else c, *r) for c, *r in ODD]
    assert names(prefix_trie.trie(spark, frame(spark, rows), shards)) == brute(rows)


def test_odd_rows(spark):
    assert names(prefix_trie.trie(spark, frame(spark, ODD))) == brute(ODD)


def test_segments_of_a_hot_end(spark, monkeypatch):
    """One conversation told by most ids: its ids cross shards and segments."""
    rows = [(i, 0, "user", "hello") for i in range(0, 4000, 20)] + [(7, 0, "user", "other"), (7, 1, "user", "hello")]
    assert names(prefix_trie.trie(spark, frame(spark, rows), 6)) == brute(rows)


def test_turnless_conversations(spark):
    """Conversations whose own turns are all replaced and whose family has no first one end at the root."""
    ids = [c for c in range(1, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4 > 0]
    rows = [(c, 0, "user", "gone") for c in ids]
    got = names(prefix_trie.trie(spark, frame(spark, rows), 5))
    assert got == brute(rows) and len(got) == 1


def test_empty_table(spark):
    assert prefix_trie.trie(spark, frame(spark, [])).collect() == []
    assert prefix_trie.trie(spark, frame(spark, [(None, 0, "user", "x")])).collect() == []


def test_splitters_keep_what_tells_paths_apart():
    a, b, c = (bytes([x]) * prefix_trie.WIDTH for x in (1, 2, 3))
    sample = [(a + a + c, 1), (a + b + c, 2), (a + b + c, 3), (a + b + c, 4), (c + a, 5)]
    bounds = prefix_trie.splitters(sample, 5)
    assert bounds == [(a + b, prefix_trie.LEAST_ID), (a + b + c, 3), (a + b + c, 4), (c, prefix_trie.LEAST_ID)]
    assert prefix_trie.Skeleton(bounds).depth == [0, 1, 2, 3, 1]
    assert prefix_trie.splitters([], 9) == [] and prefix_trie.splitters(sample, 1) == []


@pytest.mark.parametrize("turns", [0, 1, 2, 7, 64])
def test_shared_turns(turns):
    head = bytes(range(1, 17)) * turns
    assert prefix_trie.shared(head, head) == turns
    assert prefix_trie.shared(head + b"\1" * 16, head + b"\2" * 48) == turns
    assert prefix_trie.shared(head, head + b"\2" * 32) == turns


def test_query(spark):
    query, sql = CHECKS["op12_prefix_trie"]
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        assert compare(query(spark, folder), connect(folder), sql) == ""
