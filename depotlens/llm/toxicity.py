"""Toxicity scores from subword-bag embeddings under a linear softmax.

A word is the bag of its character n-grams, a window of words the average of their embeddings, and a linear
softmax over that average gives the label; embeddings and softmax are trained jointly in numpy. A word
that training never saw shares the n-gram vectors of the words it resembles. A text is as toxic as its most
toxic window, so a few words are not averaged away in a long text.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from depotlens.llm.base import remainder

BUCKETS, DIMENSIONS = 1 << 16, 8
#: Words of a window, and words from one window's start to the next one's.
WINDOW, STRIDE = 12, 6
#: The sample that training reads: rows of each label, and characters of each label, at most.
SAMPLE_ROWS, SAMPLE_CHARACTERS = 1500, 6_000_000
#: Characters of a passage of a text that the sample cannot hold whole.
PASSAGE = 1000
WORD = re.compile(r"\w+")
#: Words whose scores a task remembers.
REMEMBERED = 500_000


def grams(listed: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the runs of 3 to 6 characters of words with marks at both ends, and each bucket's word.

    A word has no bucket of its own, so one that is seen once cannot be learned by heart.
    """
    if not listed:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    points = np.frombuffer("".join(f"<{w}>" for w in listed).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = points.astype(np.uint64)
    size = np.fromiter(map(len, listed), np.int64, len(listed)) + 2
    word = np.repeat(np.arange(len(listed)), size)
    end = np.cumsum(size)[word]
    mixed, buckets, owners = points * np.uint64(0x9E3779B97F4A7C15), [], []
    for n in range(2, 7):
        first = np.flatnonzero(np.arange(len(points)) + n <= end)
        mixed = mixed.copy()
        mixed[first] = (mixed[first] ^ points[first + n - 1]) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed[first] ^= mixed[first] >> np.uint64(32)
        if n > 2:
            buckets.append((mixed[first] >> np.uint64(11)).astype(np.int64) % BUCKETS), owners.append(word[first])
    return np.concatenate(buckets), np.concatenate(owners)


def words(text: str | None) -> list[str]:
    """Words of a text in lower case; a word said many times in a row counts once."""
    return [w for w, _ in groupby(WORD.findall((text or "").lower()))]


def window_bounds(count: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last-but-one word of each window of a text; the last window ends with the text."""
    if count <= WINDOW:
        return np.array([0]), np.array([count])
    starts = np.append(np.arange(0, count - WINDOW, STRIDE), count - WINDOW)
    return starts, starts + WINDOW


@dataclass
class Model:
    embeddings: np.ndarray
    direction: np.ndarray
    bias: float

    def word_odds(self, listed: list[str]) -> list[float]:
        """What each word adds to the log-odds of a window before averaging."""
        buckets, owner = grams(listed)
        each = (self.embeddings @ self.direction).astype(np.float64)
        n = np.bincount(owner, minlength=len(listed))
        return (np.bincount(owner, each[buckets], len(listed)) / np.maximum(n, 1)).tolist()


class _Sample:
    """Training windows as flat arrays: words of each window, n-grams of each distinct word."""

    def __init__(self, texts: list[str], labels: list[int]):
        code: dict[str, int] = {}
        ids, owner, n = [], [], []
        for text, doc in zip(texts, range(len(texts))):
            listed = np.array([code.setdefault(w, len(code)) for w in words(text)], np.int32)
            starts, ends = window_bounds(len(listed))
            for s, e in zip(starts, ends):
                if e > s:
                    ids.append(listed[s:e]), owner.append(doc), n.append(e - s)
        self.words = np.concatenate(ids) if ids else np.empty(0, np.int32)
        self.owner, self.size = np.array(owner, np.int64), np.array(n, np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.label = np.array(labels, np.int64)[self.owner]
        buckets, owner = grams(list(code))
        self.grams = buckets[np.argsort(owner, kind="stable")]
        self.gram_size = np.bincount(owner, minlength=len(code))
        self.gram_start = np.cumsum(self.gram_size) - self.gram_size


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions start[i] .. start[i] + size[i] of every i, one after the other."""
    offset = np.repeat(start - (np.cumsum(size) - size), size)
    return np.arange(int(size.sum())) + offset


def _fit(sample: _Sample, documents: int, epochs: int, batch: int, rate: float) -> Model:
    """Embeddings and softmax, by adaptive gradient steps on shuffled windows.

    All windows of clean texts are negative. At first all windows of toxic texts are positive; in the
    second half of the epochs only those near the text's highest score are, and the others are left out.
    """
    draw = np.random.default_rng(7)
    embeddings = (draw.standard_normal((BUCKETS, DIMENSIONS)) * 0.05).astype(np.float32)
    out = (draw.standard_normal((DIMENSIONS, 2)) * 0.5).astype(np.float32)
    bias = np.zeros(2, np.float32)
    speed, speed_out, speed_bias = np.full_like(embeddings, 1e-4), np.full_like(out, 1.0), np.full_like(bias, 1.0)
    active = np.arange(len(sample.size))

    def forward(chosen):
        size = sample.size[chosen]
        ids = sample.words[_ranges(sample.start[chosen], size)]
        distinct, place = np.unique(ids, return_inverse=True)
        n = sample.gram_size[distinct]
        used = sample.grams[_ranges(sample.gram_start[distinct], n)]
        vectors = np.add.reduceat(embeddings[used], np.cumsum(n) - n) / n[:, None]
        average = np.add.reduceat(vectors[place], np.cumsum(size) - size) / size[:, None]
        return average, (size, place, n, used)

    def odds():
        spans = range(0, len(sample.size), 16384)
        parts = [forward(np.arange(a, min(a + 16384, len(sample.size))))[0] @ out + bias for a in spans]
        return np.diff(np.concatenate(parts), axis=1)[:, 0]

    for epoch in range(epochs):
        if 2 * epoch >= epochs:
            now, highest = odds(), np.full(documents, -np.inf)
            np.maximum.at(highest, sample.owner, now)
            clean = np.median(now[sample.label == 0])
            active = np.flatnonzero((sample.label == 0) | (now >= (highest[sample.owner] + clean) / 2))
        order = draw.permutation(len(active))
        for at in range(0, len(order), batch):
            chosen = active[order[at : at + batch]]
            average, (size, place, n, used) = forward(chosen)
            logits = average @ out + bias
            grad = np.exp(logits - logits.max(axis=1, keepdims=True))
            grad /= grad.sum(axis=1, keepdims=True)
            grad[np.arange(len(chosen)), sample.label[chosen]] -= 1
            down = np.repeat((grad @ out.T) / size[:, None], size, axis=0)
            step_out, step_bias = average.T @ grad, grad.sum(axis=0)
            for d in range(DIMENSIONS):
                per_word = np.bincount(place, down[:, d], len(n)) / n
                step = np.bincount(used, np.repeat(per_word, n), BUCKETS)
                hit = np.flatnonzero(step)
                speed[hit, d] += step[hit] ** 2
                embeddings[hit, d] -= rate * step[hit] / np.sqrt(speed[hit, d])
            speed_out += step_out**2
            speed_bias += step_bias**2
            out -= rate * step_out / np.sqrt(speed_out)
            bias -= rate * step_bias / np.sqrt(speed_bias)
    return Model(embeddings, out[:, 1] - out[:, 0], float(bias[1] - bias[0]))


def _calibrate(odds: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve from a text's highest odds to its label, by Newton steps."""
    centre, spread = odds.mean(), odds.std() + 1e-6
    x = np.stack([(odds - centre) / spread, np.ones(len(odds))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x + 1e-2 * np.eye(2), x.T @ (p - labels) + 1e-2 * w)
    slope = max(w[0], 1e-3) / spread
    return float(slope), float(w[1] - slope * centre)


def train(texts: list[str], labels: list[int], epochs: int = 6, batch: int = 1024, rate: float = 0.2) -> Model:
    """Model from whole texts with labels 0 and 1; every fifth text is kept apart to calibrate its odds."""
    if len(set(labels)) < 2:
        chance = 4.0 if labels and labels[0] else -4.0
        return Model(np.zeros((BUCKETS, DIMENSIONS), np.float32), np.zeros(DIMENSIONS, np.float32), chance)
    apart = [i for i in range(len(texts)) if i % 5 == 4]
    if len({labels[i] for i in apart}) < 2:
        apart = []
    used = sorted(set(range(len(texts))) - set(apart))
    sample = _Sample([texts[i] for i in used], [labels[i] for i in used])
    if len(set(sample.label.tolist())) < 2:
        return train([], [])
    epochs = max(epochs, -(-epochs * 40 * batch // len(sample.size)))  # few windows: as many steps at least
    model = _fit(sample, len(used), min(epochs, 60), batch, rate)
    apart = apart or used
    highest = np.array(highest_odds(model, [texts[i] for i in apart], {}))
    slope, shift = _calibrate(highest, np.array([labels[i] for i in apart]))
    return Model(model.embeddings, model.direction * slope, model.bias * slope + shift)


def highest_odds(model: Model, texts: list[str | None], known: dict[str, float]) -> list[float]:
    """Log-odds of the most toxic window of each text; ``known`` remembers words."""
    found = []
    for at in range(0, len(texts), 64):
        listed = [words(t) for t in texts[at : at + 64]]
        if len(known) >= REMEMBERED:
            known.clear()
        fresh = sorted({w for text in listed for w in text if w not in known})
        known.update(zip(fresh, model.word_odds(fresh)))
        for text in listed:
            if not text:
                found.append(model.bias)
                continue
            total = np.zeros(len(text) + 1)
            np.cumsum(np.fromiter(map(known.__getitem__, text), np.float64, len(text)), out=total[1:])
            starts, ends = window_bounds(len(text))
            found.append(model.bias + float(((total[ends] - total[starts]) / (ends - starts)).max()))
    return found


def _scorer(shared):
    def score(batches):
        model, known = shared.value, {}
        for batch in batches:
            odds = np.array(highest_odds(model, batch.column("text").to_pylist(), known), np.float64)
            scores = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(scores)], names=[*names, "score"]
            )

    return score


def passages(text: str, room: int) -> str:
    """The text, or where it is longer than ``room`` characters, passages of it at even distances over its whole length."""
    if len(text) <= room:
        return text
    count = max(room // PASSAGE, 1)
    size = max(room // count - 1, 0)
    step = (len(text) - size) / max(count - 1, 1)
    return "\n".join(text[int(i * step) : int(i * step) + size] for i in range(count))


def _cutter(batches):
    for batch in batches:
        texts = [passages(t.as_py(), r.as_py()) for t, r in zip(batch.column("text"), batch.column("room"))]
        names = ["doc_id", "hash", "label"]
        columns = [*(batch.column(n) for n in names), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=[*names, "text"])


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, characters: int = SAMPLE_CHARACTERS) -> DataFrame:
    """(text, label) of labelled texts in an order by hash, up to the bounds for each label.

    A document with several label rows has the highest label, and equal rows count once. Texts of one id come
    after a text of each other id. If the chosen texts of a label exceed ``characters``, the longest of them
    send passages up to a common length at which the label fits, and shorter ones stay whole: no text takes
    the place of another. Only ids, hashes and lengths are sorted; texts are cut where they are read.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    known = known.groupBy("doc_id").agg(F.max((F.col("label") > 0).cast("int")).alias("label"))
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.withColumn("k", F.row_number().over(order)).where(F.col("k") <= rows)
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text", F.xxhash64("text").alias("hash"))
    sizes = texts.select("doc_id", "hash", F.char_length("text").alias("n")).join(F.broadcast(chosen), "doc_id").distinct()
    turn = F.row_number().over(Window.partitionBy("doc_id").orderBy("hash"))
    sizes = sizes.withColumn("turn", turn).where(F.col("turn") <= rows)
    place = F.row_number().over(Window.partitionBy("label").orderBy("turn", "k"))
    sizes = sizes.withColumn("place", place).where(F.col("place") <= rows)
    # Shortest first: what is left, over the texts that are left, is greatest where whole texts end.
    shortest = Window.partitionBy("label").orderBy("n", "place")
    shorter = F.coalesce(F.sum("n").over(shortest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.count("*").over(Window.partitionBy("label")) - F.row_number().over(shortest) + 1
    sizes = sizes.withColumn("share", F.floor((characters - shorter) / left))
    room = F.max("share").over(Window.partitionBy("label"))
    wanted = sizes.select("doc_id", "hash", "label", room.alias("room"))
    found = texts.join(F.broadcast(wanted), ["doc_id", "hash"]).select("doc_id", "hash", "label", "room", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = found.mapInArrow(_cutter, f"doc_id {kind}, hash long, label int, text string")
    return cut.groupBy("doc_id", "hash", "label").agg(F.min("text").alias("text")).select("text", "label")


def score_toxicity(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    held_out: int = 0,
    divisor: int = 5,
) -> DataFrame:
    """Toxicity of every whole text; learns from labelled rows whose id is not held out.

    Returns doc_id, held_out, score and predicted (1 from a score of 0.5). Null and empty texts get the
    score of no words. Without labels of both kinds every text gets the score of the kind there is, or a
    low one. A score of exactly 0.5 predicts 1. Repeated rows get equal results, an empty table an empty one.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("held_out", remainder(F.col("doc_id"), divisor) == held_out)
    marks = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"))
    marks = marks.where(remainder(F.col("doc_id"), divisor) != held_out)
    sample = training_sample(rows, marks).collect()
    sample.sort(key=lambda r: (zlib.crc32(r.text.encode("utf-8", "replace")), r.text))
    model = spark.sparkContext.broadcast(train([r.text for r in sample], [r.label for r in sample]))
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.select("doc_id", "held_out", "text").mapInArrow(
        _scorer(model), f"doc_id {kind}, held_out boolean, score double"
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
