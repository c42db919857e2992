"""Language-model scores from a log-bilinear neural model.

Spark counts every token of the training texts. The most frequent tokens are classes of their own, all
others share classes by their ending; within a shared class a token has its smoothed share of the counts.
A log-bilinear model over classes (two earlier classes as context) is trained in numpy by noise-contrastive
estimation: every task trains on its own texts from one start, and the parameters are averaged by Spark,
weighted by how often a task has used them. Batched matrix products give the normaliser of every
pair of context classes, so token log-probabilities are normalised.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.llm.base import remainder
from depotlens.session import settle

#: Tokens with a class of their own, classes by ending, and tokens whose counts every task holds.
OWN, ENDINGS, HEAD = 768, 256, 1 << 16
CLASSES = OWN + ENDINGS
DIMENSIONS, NOISE, BATCH, RATE = 16, 64, 4096, 0.1
#: The end of a text counts as a token; no word is empty.
END = b""
#: Distinct tokens that a task counts before it sends its sums on.
COUNTED_AT_ONCE = 100_000
#: Rows that scoring holds at once.
SCORED_AT_ONCE = 1000


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space with A-Z in lower case, and the end."""
    listed = (text or "").encode("utf-8", "replace").lower().split()
    listed.append(END)
    return listed


def _count(batches):
    found: Counter = Counter()

    def sums():
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["token", "n"]
        )

    for batch in batches:
        for text in batch.column("text"):
            found.update(tokens(text.as_py()))
            if len(found) >= COUNTED_AT_ONCE:
                yield sums()
                found.clear()
    if found:
        yield sums()


def count_tokens(texts: DataFrame) -> DataFrame:
    """(token, n) over all rows of (text); partial sums are combined before and after the shuffle."""
    return texts.mapInArrow(_count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Sizes and the bounded part of the counts that every task holds."""

    total: int
    distinct: int
    head: dict[bytes, tuple[int, int]]  # token -> (class, count)
    mass: np.ndarray  # smoothed counts of each class

    @property
    def floor(self) -> float:
        return self.total + 0.1 * (self.distinct + 1)

    def classes(self, listed: list[bytes]) -> np.ndarray:
        head = self.head
        return np.array([head[t][0] if t in head else ending(t) for t in listed], np.int64)


def ending(token: bytes) -> int:
    return OWN + zlib.crc32(token[-3:]) % ENDINGS


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From stored counts: bounded collects, of the frequent tokens and of the sums by class.

    Frequent are all tokens with the largest counts, as far as whole counts fit into HEAD; so only they
    travel, not a long list from every task.
    """
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    held, least = 0, 1 << 62
    # Each of the largest HEAD counts belongs to a token at least.
    for r in counts.groupBy("n").agg(F.count("*").alias("k")).orderBy(F.desc("n")).limit(HEAD).collect():
        held += r.k
        if held > HEAD:
            break
        least = r.n
    top = counts.where(F.col("n") >= least).collect()
    top.sort(key=lambda r: (-r.n, bytes(r.token)))
    own = {bytes(r.token): i for i, r in enumerate(top[:OWN])}
    head = {bytes(r.token): (own.get(bytes(r.token), ending(bytes(r.token))), r.n) for r in top}
    mass = np.zeros(CLASSES)
    for r in top[:OWN]:
        mass[own[bytes(r.token)]] = r.n + 0.1
    mass[OWN:] += 0.1  # one unseen token in each shared class
    rest = counts.where(~F.col("token").isin([bytearray(t) for t in own])) if own else counts
    by = (F.crc32(F.substring("token", -3, 3)) % ENDINGS).alias("k")
    by = F.when(F.length("token") < 3, F.crc32("token") % ENDINGS).otherwise(by).alias("k")
    for r in rest.groupBy(by).agg(F.sum(F.col("n") + 0.1).alias("s")).collect():
        mass[OWN + r.k] += r.s
    return Vocabulary(size[0], size[1], head, mass)


class LogBilinear:
    """score(class | two earlier classes) = (first[w1] + second[w2]) . out[w] + bias[w]."""

    def __init__(self, mass: np.ndarray):
        draw = np.random.default_rng(11)
        shape = (CLASSES, DIMENSIONS)
        self.first, self.second, self.out = (draw.normal(0, 0.1, shape).astype(np.float32) for _ in range(3))
        self.noise = np.maximum(mass, 1e-9) / np.maximum(mass, 1e-9).sum()
        self.bias = np.log(self.noise).astype(np.float32)

    def matrices(self) -> np.ndarray:
        """All parameters, one row of DIMENSIONS + 1 numbers for each class and part."""
        blank = np.zeros((CLASSES, 1), np.float32)
        parts = [(self.first, blank), (self.second, blank), (self.out, self.bias[:, None])]
        return np.concatenate([np.concatenate(p, axis=1) for p in parts])

    def load(self, rows: np.ndarray) -> None:
        self.first, self.second, last = (p.astype(np.float32) for p in np.split(rows, 3))
        self.first, self.second = self.first[:, :DIMENSIONS].copy(), self.second[:, :DIMENSIONS].copy()
        self.out, self.bias = last[:, :DIMENSIONS].copy(), last[:, DIMENSIONS].copy()


def _added(at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of rows by class."""
    return np.stack([np.bincount(at, rows[:, d], CLASSES) for d in range(rows.shape[1])], axis=1)


class Trainer:
    """Adaptive noise-contrastive steps; the noise words are shared by the tokens of a step."""

    def __init__(self, model: LogBilinear):
        self.m, self.draw, self.used = model, np.random.default_rng(13), np.zeros(3 * CLASSES)
        self.speed = {n: np.full_like(getattr(model, n), 1.0) for n in ("first", "second", "out", "bias")}
        self.cumulative = np.cumsum(model.noise)
        self.log_noise = np.log(NOISE * model.noise).astype(np.float32)

    def step(self, w1: np.ndarray, w2: np.ndarray, w: np.ndarray) -> None:
        m = self.m
        noise = np.minimum(np.searchsorted(self.cumulative, self.draw.random(NOISE)), CLASSES - 1)
        context = m.first[w1] + m.second[w2]
        mine = np.einsum("ij,ij->i", context, m.out[w]) + m.bias[w] - self.log_noise[w]
        others = context @ m.out[noise].T + (m.bias - self.log_noise)[noise]
        up = 1 / (1 + np.exp(np.clip(mine, -30, 30)))  # 1 - P(data)
        down = 1 / (1 + np.exp(-np.clip(others, -30, 30)))  # P(data) of noise
        back = up[:, None] * m.out[w] - down @ m.out[noise]
        out = _added(w, up[:, None] * context)
        np.add.at(out, noise, -(down.T @ context))
        bias = np.bincount(w, up, CLASSES) - np.bincount(noise, down.sum(axis=0), CLASSES)
        steps = {"first": _added(w1, back), "second": _added(w2, back), "out": out, "bias": bias}
        for name, grad in steps.items():
            self.speed[name] += grad**2
            getattr(m, name)[...] += RATE * grad / np.sqrt(self.speed[name])
        for part, at in enumerate((w1, w2, w)):
            self.used[part * CLASSES : (part + 1) * CLASSES] += np.bincount(at, minlength=CLASSES)


def _contexts(parts: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(w1, w2, w) of the tokens of several texts; w1 is just before w; ends stand before a text's start."""
    w = np.concatenate(parts)
    w1, w2 = np.empty_like(w), np.empty_like(w)
    w1[1:], w2[2:] = w[:-1], w[:-2]
    starts = np.cumsum([0, *map(len, parts[:-1])])
    w1[starts] = end
    w2[starts] = end
    seconds = starts + 1
    w2[seconds[seconds < len(w)]] = end
    return w1, w2, w


def _train(shared):
    def train(batches):
        words, start = shared.value
        model = LogBilinear(words.mass)
        model.load(start)
        trainer, end = Trainer(model), int(words.classes([END])[0])
        held, size = [], 0
        for batch in batches:
            for text in batch.column("text"):
                held.append(words.classes(tokens(text.as_py())))
                size += len(held[-1])
                if size >= 16 * BATCH:
                    _epoch(trainer, held, end)
                    held, size = [], 0
        if held:
            _epoch(trainer, held, end)
        rows, used = model.matrices().astype(np.float64), trainer.used + 1e-3
        numbers = [pa.array(rows[:, d]) for d in range(rows.shape[1])]
        names = ["row", "weight", *(f"v{d}" for d in range(rows.shape[1]))]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows))), pa.array(used), *numbers], names=names)

    return train


def _epoch(trainer: Trainer, held: list[np.ndarray], end: int) -> None:
    w1, w2, w = _contexts(held, end)
    order = trainer.draw.permutation(len(w))
    for at in range(0, len(w), BATCH):
        part = order[at : at + BATCH]
        trainer.step(w1[part], w2[part], w[part])


def fit(spark: SparkSession, texts: DataFrame, words: Vocabulary) -> np.ndarray:
    """Averaged parameters of the tasks' models; every training text is used once."""
    start = LogBilinear(words.mass).matrices()
    shared = spark.sparkContext.broadcast((words, start))
    values = [f"v{d}" for d in range(DIMENSIONS + 1)]
    rows = texts.mapInArrow(_train(shared), "row long, weight double, " + ", ".join(f"{v} double" for v in values))
    means = [(F.sum(F.col("weight") * F.col(v)) / F.sum("weight")).alias(v) for v in values]
    fitted = start.copy()
    for r in rows.groupBy("row").agg(*means).collect():
        fitted[r.row] = [r[v] for v in values]
    return fitted


def normalisers(spark: SparkSession, words: Vocabulary, fitted: np.ndarray) -> np.ndarray:
    """Log of the sum over classes for every pair of context classes; a fixed number of matrix products."""
    shared = spark.sparkContext.broadcast((words, fitted))

    def sums(batches):
        words, fitted = shared.value
        model = LogBilinear(words.mass)
        model.load(fitted)
        for batch in batches:
            for w1 in batch.column("id").to_pylist():
                scores = (model.first[w1] + model.second) @ model.out.T + model.bias
                top = scores.max(axis=1, keepdims=True)
                row = top[:, 0] + np.log(np.exp(scores - top).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w1]), pa.array([row.astype(np.float32)], pa.list_(pa.float32()))], names=["id", "z"]
                )

    table = np.zeros((CLASSES, CLASSES), np.float32)
    slices = spark.range(0, CLASSES, 1, 2 * spark.sparkContext.defaultParallelism)
    for r in slices.mapInArrow(sums, "id long, z array<float>").collect():
        table[r.id] = r.z
    return table


def _score(shared):
    def score(batches):
        words, fitted, table = shared.value
        model = LogBilinear(words.mass)
        model.load(fitted)
        head, log_mass = words.head, np.log10(words.mass)
        share = {t: np.log10(c + 0.1) for t, (_, c) in head.items()}
        end = int(words.classes([END])[0])
        base_floor = np.log10(words.floor)

        def neural(parts):
            w1, w2, w = _contexts(parts, end)
            found = np.einsum("ij,ij->i", model.first[w1] + model.second[w2], model.out[w]) + model.bias[w]
            found = (found - table[w1, w2]) / np.log(10) - log_mass[w]
            return np.add.reduceat(found.astype(np.float64), np.cumsum([0, *map(len, parts[:-1])]))

        def rows(batch):
            n, known, base, lm, parts, size = [], [], [], [], [], 0
            tail_tokens, tail_times, bounds = [], [], [0]
            for text in batch.column("text"):
                listed = tokens(text.as_py())
                parts.append(words.classes(listed))
                size += len(listed)
                shares = [share[t] for t in listed if t in share]
                rare = Counter(t for t in listed if t not in share)
                tail_tokens.extend(rare), tail_times.extend(rare.values()), bounds.append(len(tail_tokens))
                n.append(len(listed)), known.append(len(shares)), base.append(float(np.sum(shares)))
                if size >= 1 << 17:
                    lm.extend(neural(parts))
                    parts, size = [], 0
            if parts:
                lm.extend(neural(parts))
            pairs = [pa.array(tail_tokens, pa.binary()), pa.array(tail_times, pa.int64())]
            tails = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(pairs, ["token", "n"]))
            numbers = [pa.array(n, pa.int64()), pa.array(known, pa.int64())]
            numbers += [pa.array(np.array(base) - np.array(n) * base_floor), pa.array(np.array(lm) + np.array(base))]
            kept = ["row", "doc_id", "held_out"]
            return pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *numbers, tails],
                names=[*kept, "n_tokens", "head_known", "head_base", "head_score", "tail"],
            )

        for batch in batches:
            for start in range(0, batch.num_rows, SCORED_AT_ONCE):
                yield rows(batch.slice(start, SCORED_AT_ONCE))

    return score


def score_texts(
    spark: SparkSession,
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    held_out: int = 0,
    divisor: int = 10,
) -> DataFrame:
    """Base and neural log10 probabilities of every whole text; learns from rows that are not held out.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score. A null text is an
    empty one: a single end. Tokens outside the frequent ones get their exact counts by a join. Repeated rows
    get equal results; with nothing to learn from, all tokens are unseen; an empty table gives an empty one. Every task
    trains on its own texts, so ``score`` (not base_score) depends a little on how the files fall into tasks.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")
    ).withColumn("held_out", remainder(F.col("doc_id"), divisor) == held_out)
    training = rows.where(~F.col("held_out")).select("text")
    counts = settle(count_tokens(training))
    words = vocabulary(counts)
    fitted = fit(spark, training, words)
    shared = spark.sparkContext.broadcast((words, fitted, normalisers(spark, words, fitted)))
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = settle(
        rows.select("row", "doc_id", "held_out", "text").mapInArrow(
            _score(shared),
            f"row long, doc_id {kind}, held_out boolean, n_tokens long, head_known long, head_base double, "
            "head_score double, tail array<struct<token:binary,n:long>>",
        )
    )
    tail = scored.select("row", F.explode("tail").alias("t")).select("row", "t.token", F.col("t.n").alias("times"))
    counted = tail.join(counts, "token", "left")
    share = F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.1))
    sums = counted.groupBy("row").agg(
        F.sum(share).alias("share"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known")
    )
    share = F.coalesce("share", F.lit(0.0))
    return scored.drop("tail").join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("bigint").alias("train_tokens"),
        (F.col("head_base") + share).alias("base_score"),
        (F.col("head_score") + share).alias("score"),
    )
