"""Language identification by inference of language mixtures.

Training counts the letter trigrams of every labelled training text in Spark. A document's words get a
likelihood under each language from their trigrams; expectation-maximisation estimates the proportions of
the languages, and among nested sets of languages the one with the best penalised likelihood is kept. The
language with the largest proportion is the prediction and its proportion the score.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, MapType, StringType

from depotlens.llm.base import remainder

#: Trigrams are hashed to so many classes; a model has this many numbers for each language.
CLASSES = 1 << 16
#: More labels than this are a sign that the column holds no languages; the model would outgrow its bound.
MOST_LANGUAGES = 500
#: Characters that are turned into trigrams at once.
PIECE = 1 << 18


@cache
def _letters() -> np.ndarray:
    """By code point: is it a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _pieces(text: str):
    """Parts of about PIECE characters of a text, cut between words where there is a gap to cut at."""
    start = 0
    while len(text) - start > PIECE:
        cut = max(text.rfind(gap, start + PIECE // 2, start + PIECE) for gap in " \n")
        cut = start + PIECE if cut < 0 else cut
        yield text[start:cut]
        start = cut
    yield text[start:]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts in lower case: the class of every letter trigram, the first trigram of every word, and the text
    of every word. A word of n letters has n trigrams, with a gap before its first and after its last letter."""
    points = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _letters()[points]
    marked = np.where(letters, points, 0).astype(np.uint64)
    here = np.flatnonzero(letters)
    mixed = marked[here - 1] * np.uint64(0x9E3779B97F4A7C15) + marked[here] * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x165667B19E3779F9) + marked[here + 1]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    starts = np.flatnonzero(~letters[here - 1])
    ends = np.cumsum([1 + len(t) for t in texts])
    owner = np.searchsorted(ends, here[starts] - 1, "right") if len(starts) else starts
    return (mixed >> np.uint64(48)).astype(np.int64), starts, owner


def _batched(texts: list[str | None]):
    """(rows, texts in lower case) of bounded length; a long text comes in several parts."""
    rows, held, size = [], [], 0
    for row, text in enumerate(texts):
        for piece in _pieces((text or "").lower()):
            rows.append(row), held.append(piece)
            size += len(piece)
            if size >= PIECE:
                yield rows, held
                rows, held, size = [], [], 0
    if rows:
        yield rows, held


def _count(batches):
    """Sums of one batch at a time: languages x CLASSES numbers at most."""
    for batch in batches:
        labels, code = np.unique(np.array(batch.column("lang").to_pylist(), str), return_inverse=True)
        total = np.zeros(len(labels) * CLASSES, np.int64)
        for rows, texts in _batched(batch.column("text").to_pylist()):
            classes, starts, owner = trigrams(texts)
            per_word = np.diff(np.append(starts, len(classes)))
            at = np.repeat(code[np.array(rows)][owner] * CLASSES, per_word) + classes
            total += np.bincount(at, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(labels[at // CLASSES], pa.string()), pa.array(at % CLASSES), pa.array(total[at])],
            names=["lang", "class", "n"],
        )


def learn(texts: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and log probabilities (CLASSES x languages) from all rows (text, lang).

    Tasks send sums, never texts; the driver gets CLASSES x languages numbers at most.
    """
    counts = (
        texts.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
        .select("text", F.col("lang").cast("string").alias("lang"))
        .mapInArrow(_count, "lang string, class long, n long")
        .groupBy("lang", "class")
        .agg(F.sum("n").alias("n"))
    )
    rows = counts.groupBy("lang").agg(F.collect_list("class").alias("c"), F.collect_list("n").alias("n"))
    langs, table = [], []
    for row in rows.toLocalIterator():
        if len(langs) == MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} languages in the labels")
        counted = np.zeros(CLASSES)
        counted[row["c"]] = row["n"]
        langs.append(row["lang"]), table.append(counted)
    if not langs:
        return [], np.zeros((CLASSES, 0), np.float32)
    order = np.argsort(langs)
    table = np.stack(table, axis=1)[:, order] + 0.05
    return [langs[i] for i in order], np.log(table / table.sum(axis=0)).astype(np.float32)


def _em(like: np.ndarray, weights: np.ndarray, steps: int) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood after EM over the rows (words) of ``like``, scaled to maximum 1."""
    mixed = like @ weights
    best = np.log(mixed).sum()
    for _ in range(steps):
        weights = weights * ((1 / mixed) @ like) / len(like)
        mixed = like @ weights
        now = np.log(mixed).sum()
        if now - best < 1e-3 * (1 + 1e-4 * abs(now)):
            return weights, now
        best = now
    return weights, best


def mixture(word_logs: np.ndarray, penalty: float = 1.0, steps: int = 50) -> np.ndarray:
    """Proportions of the languages in a text from the log-likelihood of its words (words x languages).

    Sets of the 1, 2, ... languages with the largest proportions are compared by log-likelihood minus
    ``penalty`` * log(words + 1) for each language; ties go to the smaller set and then to name order.
    """
    words, languages = word_logs.shape
    peak = word_logs.max(axis=1, keepdims=True)
    like = np.exp(word_logs - peak)
    alone = (word_logs - peak).sum(axis=0, dtype=np.float64)
    first = int(alone.argmax())
    cost = penalty * np.log(words + 1)
    single = np.zeros(languages)
    single[first] = 1
    if alone[first] > -cost:  # no mixture has a likelihood above 0 here
        return single
    like = np.maximum(like, 1e-30)
    full, top = _em(like, np.full(languages, 1 / languages), steps)
    if top - alone[first] <= cost:
        return single
    order = np.argsort(-full, kind="stable")
    best, chosen = alone[first], single
    for size in range(2, languages + 1):
        kept = order[:size]
        if full[kept[-1]] * words < 0.5:
            break
        weights, now = _em(like[:, kept], full[kept] / full[kept].sum(), steps)
        if now - cost * (size - 1) > best:
            best = now - cost * (size - 1)
            chosen = np.zeros(languages)
            chosen[kept] = weights
    return chosen


def _word_logs(texts: list[str | None], table: np.ndarray):
    """(row, words x languages) of every text, in order; the parts of a long text are put together."""
    row, parts = 0, []
    for rows, pieces in _batched(texts):
        classes, starts, owner = trigrams(pieces)
        logs = np.add.reduceat(table[classes], starts) if len(starts) else table[:0]
        bounds = np.searchsorted(owner, np.arange(len(pieces) + 1))
        for k, r in enumerate(rows):
            if r != row:
                yield row, np.concatenate(parts)
                row, parts = r, []
            parts.append(logs[bounds[k] : bounds[k + 1]])
    if parts:
        yield row, np.concatenate(parts)


def _predictor(model):
    def predict(batches):
        langs, table = model.value
        for batch in batches:
            found, scores, shares = [], [], []
            for _, logs in _word_logs(batch.column("text").to_pylist(), table):
                if not len(logs) or not langs:
                    found.append("und"), scores.append(0.0), shares.append([])
                    continue
                weights = mixture(logs)
                at = int(weights.argmax())
                found.append(langs[at]), scores.append(min(1.0, float(weights[at])))
                shares.append([(langs[i], float(weights[i])) for i in np.flatnonzero(weights)])
            made = [pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            made.append(pa.array(shares, pa.map_(pa.string(), pa.float64())))
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), *made], names=[*names, "lang_pred", "score", "shares"]
            )

    return predict


def identify(
    spark: SparkSession,
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    held_out: int = 2,
    divisor: int = 4,
    whole: bool = False,
) -> DataFrame:
    """Predicted language of every text; learns from rows whose id is not held out and has a label.

    Returns doc_id, held_out, lang_pred, score and shares (language -> proportion), and with ``whole`` the
    input row as a struct. A null text, a text without letters, and every text where nothing could be
    learned, gets ``und`` and score 0. Repeated rows get equal results; an empty table gives an empty one.
    """
    kept = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if whole else []
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).alias("lang"), *kept
    ).withColumn("held_out", remainder(F.col("doc_id"), divisor) == held_out)
    langs, table = learn(rows.where(~F.col("held_out")).select("text", "lang"))
    model = spark.sparkContext.broadcast((langs, table))
    given = rows.select("doc_id", "held_out", "text", *(["row"] if whole else []))
    made = given.drop("text").schema.add("lang_pred", "string").add("score", "double").add("shares", MapType(StringType(), DoubleType()))
    return given.mapInArrow(_predictor(model), made)
