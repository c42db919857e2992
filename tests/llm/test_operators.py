"""Corpus operators against brute force, and on odd input: nulls, empty and long texts, ties, repeats, clashes."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from depotlens.llm import (
    decontaminate,
    html_consensus,
    language_id,
    line_dedup,
    lm_scoring,
    minhash_join,
    piece_transducer,
    topk_search,
    toxicity,
    warc_chunks,
)

DOCS = "doc_id long, text string, lang string, source string, score double, row string, key_id int, term string, n int"
ITEMS = "item_id long, text string, phrase string, term string"
WORDS = [f"{a}{b}{c}" for a in ("ba", "ko", "mi", "tu") for b in ("ra", "le", "so") for c in ("n", "st", "")]


def sentence(draw: random.Random, size: int) -> str:
    return " ".join(draw.choice(WORDS) for _ in range(size))


def odd_texts() -> list[tuple]:
    """Ids and texts with everything that a table may hold."""
    draw = random.Random(5)
    long = "\n".join(sentence(draw, 12) for _ in range(400))
    near = sentence(draw, 120)
    lines = "\n".join(["one line here", "two lines here", "three lines here", "four lines here"])
    return [
        (1, near),
        (2, near + " changed"),
        (3, "X " + near),
        (4, near),
        (4, near),
        (5, None),
        (6, ""),
        (7, " \n\t "),
        (8, long),
        (9, long + "\nend"),
        (None, "no id here at all"),
        (None, None),
        (10, lines),
        (11, "head\n" + lines + "\ntail"),
        (12, "same\n" * 6),
        (13, "123 456 !!"),
        (14, "ÀÉ mixed Ünïcode ἀβγ 你好 🙂"),
        (15, "two words"),
        (16, "TWO Words"),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "xx" if (i or 0) % 2 else None, None, 0.5, "r", 3, "t", 1) for i, t in odd_texts()]
    return spark.createDataFrame(rows, DOCS)


def same(rows, expected) -> None:
    assert Counter(map(repr, rows)) == Counter(map(repr, expected))


# ---- top-k search ----


def brute_top(vectors, queries, k):
    found = []
    for q, a in queries:
        scores = sorted((-sum(map(lambda x, y: x * y, a, b)), v) for v, b in vectors if v != q and len(b) == len(a))
        found += [(q, r + 1, v, -s) for r, (s, v) in enumerate(scores[:k])]
    return found


def test_topk_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "SHARD_ROWS", 7)
    draw = random.Random(1)
    vectors = [(i, [draw.randint(-3, 3) for _ in range(4)]) for i in range(90)]
    vectors += [(100 + i, [1, 1, 1, 1]) for i in range(40)]  # one vector in a third of all rows: ties
    vectors += [(500, [1, 2]), (501, [2, 1]), (502, [])]
    table = spark.createDataFrame(vectors + [(503, None), (None, [1, 1, 1, 1])], "vec_id long, numbers array<long>")
    rows = topk_search.search(table.where("vec_id % 10 = 0"), table, 5).collect()
    same(map(tuple, rows), brute_top(vectors, [v for v in vectors if v[0] % 10 == 0], 5))


def test_topk_beyond_exact_doubles(spark):
    big = 1 << 30
    vectors = [(0, [big, 1]), (1, [big, 0]), (2, [big, 1]), (3, [-big, 5]), (4, [big, 2])]
    table = spark.createDataFrame(vectors, "vec_id long, numbers array<long>")
    rows = topk_search.search(table.where("vec_id = 0"), table, 3).collect()
    expected = [v for _, _, v, _ in brute_top(vectors, [vectors[0]], 3)]
    assert [r.vec_id for r in sorted(rows, key=lambda r: r.rank)] == expected


def test_topk_odd_vectors(spark):
    rows = [(0, [0.5, -0.25]), (1, [float("nan"), 1.0]), (2, [None, 1.0]), (3, None), (4, [float("inf"), 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = table.select("vec_id", topk_search.quantised(table.embedding).alias("n")).collect()
    assert [r.n for r in got] == [[512, -256], None, None, None, None]
    empty = spark.createDataFrame([], "vec_id long, numbers array<long>")
    assert topk_search.search(empty, empty).collect() == []


# ---- language identification ----


def test_language_mixture(spark):
    draw = random.Random(3)
    speak = {"aa": "bana koma lipa".split(), "bb": "sträx völt drünk".split()}
    rows = []
    for i in range(240):
        lang = ("aa", "bb")[i % 2]
        rows.append((i, " ".join(draw.choice(speak[lang]) for _ in range(20)), lang))
    mixed = " ".join(draw.choice(speak["aa"]) for _ in range(60)) + " " + " ".join(
        draw.choice(speak["bb"]) for _ in range(40)
    )
    rows += [(1000, mixed, None), (1001, "12 34", None), (1002, None, "aa"), (1003, "", "bb"), (None, "bana", None)]
    got = {r.doc_id: r for r in language_id.identify(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    for i, text, lang in rows[:240]:
        assert got[i].lang_pred == lang and got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    assert got[1000].lang_pred == "aa" and abs(got[1000].score - 0.6) < 0.05
    assert abs(got[1000].shares["bb"] - 0.4) < 0.05
    assert [got[i].lang_pred for i in (1001, 1002, 1003)] == ["und"] * 3 and got[1003].score == 0
    assert got[None].lang_pred == "aa"


def test_language_parts_of_long_texts_add_up(monkeypatch):
    text = "".join(f"wörd{i} and more " for i in range(500))
    table = np.log(np.random.default_rng(0).dirichlet(np.ones(language_id.CLASSES), 3).T).astype(np.float32)
    whole = dict(language_id._word_logs([text, None, "x"], table))
    monkeypatch.setattr(language_id, "PIECE", 100)
    parts = dict(language_id._word_logs([text, None, "x"], table))
    assert whole.keys() == parts.keys() == {0, 1, 2}
    for i in whole:
        assert np.allclose(whole[i].sum(axis=0), parts[i].sum(axis=0), rtol=1e-4)
        assert len(whole[i]) == len(parts[i])


def test_language_odd_input(spark, docs):
    got = language_id.identify(spark, docs, whole=True).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id for r in got if r.lang_pred == "und"} >= {5, 6, 7, 13}
    nothing = language_id.identify(spark, docs.limit(0)).collect()
    assert nothing == []


# ---- toxicity ----


def test_toxicity_held_out(spark):
    draw = random.Random(9)
    bad = ["grumblor", "snarkifex", "vilthorn"]
    rows, labels = [], []
    for i in range(400):
        listed = [draw.choice(WORDS) for _ in range(draw.randint(5, 80))]
        toxic = i % 4 == 0
        if toxic:  # misspellings share character runs with the words of other texts
            for _ in range(3):
                word = draw.choice(bad)
                listed.insert(draw.randrange(len(listed)), word + draw.choice("aeiou") + draw.choice("xyz"))
        rows.append((i, " ".join(listed))), labels.append((i, int(toxic), 7))
    rows += [(1000, None), (1001, ""), (None, "grumbloro")]
    labels += [(None, 1, 0), (2, None, 0), (5000, 1, 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, text int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(spark, table, marks).collect()}
    held = [i for i in range(400) if got[i].held_out]
    assert held and sum(got[i].predicted == int(i % 4 == 0) for i in held) >= 0.95 * len(held)
    assert got[1000].score == got[1001].score < 0.5
    assert all(r.predicted == int(r.score >= 0.5) for r in got.values())


def test_toxicity_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score_toxicity(spark, docs, none).collect()
    assert len(got) == docs.count() and {r.predicted for r in got} == {0}
    assert toxicity.score_toxicity(spark, docs.limit(0), none).collect() == []


# ---- language-model scores ----


def test_lm_base_scores_and_normalisation(spark, docs):
    got = lm_scoring.score_texts(spark, docs).collect()
    listed = [(i, lm_scoring.tokens(t)) for i, t in odd_texts()]
    train = Counter()
    for i, t in listed:
        if zlib.crc32(str(i).encode() if i is not None else b"") % 10:
            train.update(t)
    total, distinct = sum(train.values()), len(train)
    floor = total + 0.1 * (distinct + 1)
    expected = sorted(
        (len(t), sum(train[w] > 0 for w in t), round(sum(math.log10((train[w] + 0.1) / floor) for w in t), 6)) for _, t in listed
    )
    assert sorted((r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == expected
    assert {r.train_tokens for r in got} == {total} and all(r.score < 0 for r in got)


def test_lm_probabilities_sum_to_one(spark):
    counts = spark.createDataFrame([(w.encode(), i + 1) for i, w in enumerate(WORDS)] + [(b"", 9)], "token binary, n long")
    words = lm_scoring.vocabulary(counts)
    model = lm_scoring.LogBilinear(words.mass)
    table = lm_scoring.normalisers(spark, words, model.matrices())
    scores = (model.first[3] + model.second[5]) @ model.out.T + model.bias - table[3, 5]
    assert abs(np.exp(scores.astype(float)).sum() - 1) < 1e-4
    assert abs(words.mass.sum() - (words.total + 0.1 * words.distinct + 0.1 * lm_scoring.ENDINGS)) < 1e-6


def test_lm_nothing_to_learn_from(spark, docs):
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    rows = spark.createDataFrame([(i, "some words") for i in ids], "doc_id long, text string")
    got = lm_scoring.score_texts(spark, rows).collect()
    assert [(r.n_known, r.train_tokens) for r in got] == [(0, 0)] * 3
    assert lm_scoring.score_texts(spark, docs.limit(0)).collect() == []


# ---- main text ----


def page(body: str) -> str:
    return f"<html><head><title>t</title><script>var a='</p>';</script></head><body>{body}</body></html>"


def test_consensus_path_wins(spark):
    menu = "<nav><a href=x>menu</a></nav>"
    long_box = "<div class='box7'>" + "<p>offer of the day " * 30 + "</div>"
    rows = [(i, f"https://h.example/{i}", page(f"{menu}<article><h1>T{i}</h1><p>{'text ' * 40}</article>")) for i in range(5)]
    rows.append((9, "https://h.example/9", page(f"{menu}<article><p>short</article>{long_box}")))
    rows.append((10, "https://other.example:80/", page("<div class=main1><p>a &amp; b<br>c <b>d</b></p><ul><li>x<li>y</ul></div>")))
    rows += [(11, None, None), (12, "", ""), (None, "http://h.example/", "plain <b>text"), (13, "http://h.example/", "<p>un<p>closed")]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, path string, host string")
    got = {r.page_id: r for r in html_consensus.extract_main_text(table).collect()}
    assert got[9].text == "short" and got[9].host_path == "body>article"
    assert got[0].text == "T0\n" + ("text " * 40).strip()
    assert got[10].text == "a & b c d\nx\ny"
    assert got[11].text == got[12].text == "" and got[11].n_chars == 0
    assert got[None].text == "plain text" and got[13].text == "un\nclosed"
    assert html_consensus.extract_main_text(table.limit(0)).collect() == []


def test_boilerplate_is_left_out():
    body = (
        "<header>site</header><div class='cookie-notice'>cookies</div><div class=ad>buy</div><aside>side</aside>"
        "<article><header><h1>Title</h1></header><p>First.<p>Second <a href=x>link</a>.<form>mail</form>"
        "<div id=comments><p>nice one</div></article><footer>foot</footer>"
    )
    assert html_consensus.Page(page(body)).extract("body>article") == "Title\nFirst.\nSecond link."


# ---- lines ----


def brute_lines(rows, window=3):
    seen, gone = {}, defaultdict(set)
    for i, t in sorted({(-1 if i is None else i, t) for i, t in rows if t is not None}):
        lines = t.split("\n")
        short = len(lines) < window
        for s in range(any(lines) if short else len(lines) - window + 1):
            if tuple(lines[s : s + window]) in seen:
                gone[i, t].update(range(s, min(s + window, len(lines))))
            else:
                seen[tuple(lines[s : s + window])] = 1
    found = []
    for i, t in rows:
        lines = [] if t is None else t.split("\n")
        out = gone.get((-1 if i is None else i, t), set())
        kept = None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in out)
        found.append((i, len(lines), len(out), kept))
    return found


def test_lines_against_brute_force(spark, docs):
    same(map(tuple, line_dedup.dedup_lines(docs).collect()), brute_lines(odd_texts()))
    draw = random.Random(2)
    rows = [(i, "\n".join(draw.choice("abc") for _ in range(draw.randint(0, 12)))) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    same(map(tuple, line_dedup.dedup_lines(table).collect()), brute_lines(rows))
    assert line_dedup.dedup_lines(docs.limit(0)).collect() == []


def test_texts_of_fewer_lines_than_a_window(spark):
    texts = ["a\nb", "a\nb", "a\nb\n", "a", "b", "a", "", "", "\n", "\n", None, "a\nb\nc", "a\nb"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_dedup.dedup_lines(table).collect()}
    assert {i for i, (_, gone, _) in got.items() if gone} == {1, 5, 12}
    assert got[1] == (2, 2, "") and got[5] == (1, 1, "") and got[9] == (2, 0, "\n") and got[10] == (0, 0, None)


# ---- archives ----


def test_archives_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc_chunks, "CHUNK", 50)
    long = "é\r\n\r\nWARC/1.1\r\n" * 40 + "\r"
    rows = [(3, "u3", long), (1, "u\n1", long), (2, None, long + "!"), (4, "u", "x" * 99), (5, "u", "x" * 99)]
    rows += [(6, "u", None), (7, "u", ""), (None, "u", long), (8, "u", "\n"), (9, "u", "y" * 100), (9, "u", "y" * 100)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, record int")
    chunks = warc_chunks.settle(warc_chunks.chunk_table(table, size=50))
    folder = str(tmp_path / "archives")
    warc_chunks.write_archives(chunks, warc_chunks.decide_types(chunks), folder)
    got = warc_chunks.read_archives(spark, folder).drop("url").collect()
    expected, first, done = [], {}, set()
    for i, _, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(t or "", i)
        data = (t or "").encode()
        again = len(data) >= 100 and (t or "") in done
        done.add(t or "")
        kind = "revisit" if again else "response"
        expected.append((i, len(data), hashlib.sha256(data).hexdigest(), kind, first[t] if again else None))
    same(map(tuple, got), expected)
    assert warc_chunks.archive_round_trip(spark, table.limit(0)).collect() == []


def test_damaged_archive_is_an_error():
    reader = warc_chunks._Reader()
    with pytest.raises(ValueError):
        for line in [b"WARC/1.1", b"WARC-Type: response", b"Content-Length: 2", b"", b"abc"]:
            reader.line(line)


# ---- pieces ----


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_transducer.MODEL)


def test_pieces_equal_the_library(library):
    machine = piece_transducer.Transducer(piece_transducer.read_model())
    draw = random.Random(4)
    signs = [*"abcdeéthHW \n\t▁①你🙂ß.,'019", "  ", "     ", "the", "ing", "é"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 40))) for _ in range(1500)]
    texts += [" " * k + t for k in range(40) for t in ("", "a", "\n")] + [t for _, t in odd_texts() if t]
    for text in texts:
        ids = machine.encode(text)
        assert ids == library.encode(text)
        assert machine.decode(ids) == text.replace("▁", " ")


def test_pieces_of_a_table(spark, docs, library):
    encoded = piece_transducer.encode_texts(spark, docs)
    got = encoded.collect()
    expected = [None if t is None else library.encode(t) for _, t in odd_texts()]
    same([r.token_ids for r in got], expected)
    assert {r.round_trip for r in got if r.token_ids is not None} == {True}
    assert all(r.ids_sha256 == piece_transducer.digest(r.token_ids) for r in got if r.token_ids is not None)
    back = piece_transducer.decode_ids(spark, encoded).collect()
    same([r.text for r in back], [t for _, t in odd_texts()])
    assert piece_transducer.encode_texts(spark, docs.limit(0)).collect() == []


# ---- contamination ----


def split_words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def places_near(words, leads, slop):
    """Whether some place of the first lead has every other lead within ``slop`` of where it stands in the phrase."""
    at = defaultdict(list)
    for k, x in enumerate(words):
        at[x].append(k)
    starts = [k - leads[0][2] for k in at[leads[0][1]]]
    return any(all(any(abs(k - o - s) <= slop for k in at[t]) for _, t, o in leads[1:]) for s in starts)


def rarest(phrase, n, depth=3):
    """The leads of a phrase, none if the corpus lacks a term."""
    leads = sorted((n[t], t.encode(), o) for o, t in enumerate(phrase))
    return [(k, t.decode(), o) for k, t, o in leads[:depth]] if leads[0][0] else []


def brute_contamination(rows, items, slop=2):
    phrases = defaultdict(set)
    for i, t in items:
        w = split_words(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            phrases[tuple(w[k : k + 13])].add(i)
    found, n = [], Counter(x for _, t in rows for x in split_words(t))
    leads_of = {p: rarest(p, n) for p in phrases}
    for i, t in rows:
        w, hit, named, close = split_words(t), set(), set(), set()
        for p, ids in phrases.items():
            if leads_of[p] and places_near(w, leads_of[p], slop):
                close.update(x for x in ids if x is not None)
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    hit.update(range(k, k + len(p))), named.update(ids)
        ids = ",".join(sorted(str(x) for x in named if x is not None))
        n_items = len([x for x in named if x is not None])
        bad = bool(hit) and 20 * len(hit) >= len(w)
        found.append((i, len(w), len(hit), n_items, hashlib.sha256(ids.encode()).hexdigest(), bad, len(close)))
    return found


@pytest.mark.parametrize("broadcast", [decontaminate.BROADCAST_TERMS, 0])
def test_contamination_against_brute_force(spark, docs, broadcast, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_TERMS", broadcast)
    monkeypatch.setattr(decontaminate, "BLOCK", 20)
    draw = random.Random(8)
    items = [(i, sentence(draw, draw.choice([1, 3, 13, 14, 40]))) for i in range(25)]
    items += [(100, None), (101, "?!"), (None, "no id here"), (3, items[3][1]), (102, "Ünïcode ἀβγ"), (103, "tura tura tura")]
    rows = [(i, sentence(draw, 60)) for i in range(100, 130)]
    rows += [(200 + k, f"{sentence(draw, 30)}. {t} {sentence(draw, 5)}") for k, (_, t) in enumerate(items) if t]
    moved = [(i, split_words(t)) for i, t in items if t and i in (2, 3, 4, 5)]
    rows += [(300 + i, " ".join(["tura", *w[:5], "zzz", *w[5:], "Zzz"])) for i, w in moved]
    rows += [(400 + i, " ".join([w[-1], *w[:-1]] * 30)) for i, w in moved] + rows[:2]
    table = spark.createDataFrame([(i, t, "p") for i, t in rows], "doc_id long, text string, phrase string")
    tests = spark.createDataFrame([(*i, "a", "b") for i in items], ITEMS)
    same(map(tuple, decontaminate.contamination(table, tests).collect()), brute_contamination(rows, items))
    same(map(tuple, decontaminate.contamination(docs, tests).collect()), brute_contamination(odd_texts(), items))
    clean = decontaminate.contamination(docs, tests.limit(0)).collect()
    assert len(clean) == docs.count() and not any(r.contaminated for r in clean)
    assert decontaminate.contamination(docs.limit(0), tests).collect() == []


def test_terms_near_each_other(spark):
    rows = spark.createDataFrame([(1, "alpha one two beta x"), (2, "alpha beta"), (3, "alpha x x x x x x beta")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha one beta")], "item_id long, text string")
    keyed = decontaminate.keyed(rows)
    phrases = decontaminate.phrases_of(items)
    more = keyed.select("text").limit(1)  # every term of the phrase is somewhere in the corpus
    assert more.count() == 1
    plans, index = decontaminate.build_index(keyed, phrases)
    leads = [(x.term, x.offset) for x in plans.first().leads]
    positions = {1: "alpha one two beta x".split(), 2: "alpha beta".split(), 3: "alpha x x x x x x beta".split()}
    assert len(leads) == 3
    near = {i for i, w in positions.items() if places_near(w, [(0, *x) for x in leads], 2)}
    assert near == {1}
    got = decontaminate.near_terms(plans, index, 2).select("key_id").distinct().collect()
    assert {r.key_id for r in got} == near


# ---- near duplicates ----


def brute_groups(rows, width=3, percent=85):
    def shingles(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    found = []
    for k, (i, _) in enumerate(rows):
        c = least.get(top(k), i)
        found.append((i, len(sets[k]), c, i == c))
    return found


def test_groups_against_brute_force(spark, docs):
    same(map(tuple, minhash_join.near_duplicates(docs).collect()), brute_groups(odd_texts()))
    assert minhash_join.near_duplicates(docs.limit(0)).collect() == []


def test_groups_of_chained_copies(spark, monkeypatch):
    """Many near copies in several blocks: links go from copy to copy, none is lost between blocks."""
    monkeypatch.setattr(minhash_join, "BLOCK_BYTES", 16 * 8 * 40)
    draw = random.Random(6)
    words = [draw.choice(WORDS) + str(k) for k in range(200)]
    rows = [(0, " ".join(words))]
    for i in range(1, 120):
        words[draw.randrange(200)] = f"new{i}"
        rows.append((i, " ".join(words)))
    rows += [(i, sentence(draw, draw.randint(1, 30))) for i in range(200, 260)]
    draw.shuffle(rows)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    same(map(tuple, minhash_join.near_duplicates(table).collect()), brute_groups(rows))
