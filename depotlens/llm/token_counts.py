"""Token counts of whole texts, with huge documents encoded in overlapping chunks.

A document beyond the size of a chunk becomes rows of (document, chunk number, slice), dealt over the tasks; each
slice reaches into the next one. Both neighbours report the word boundaries that they see in the overlap, with
the tokens before each. A boundary that both see is proven: the splitter of words reads from left to right
and never looks further ahead than the margin kept at the end of a slice, so from a common boundary on both see
the same words, and tokens never cross words. The counts are spliced there. Where an overlap has no common
boundary (a word or a run of spaces longer than it), the document comes again with wider overlaps, until one
slice holds it whole.

Other texts are cut before white space that follows something visible, where a word always ends, so that parts
which come again in a task are encoded once.
"""

from __future__ import annotations

import json
import os
import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.llm.base import KEY, keyed
from depotlens.session import settle

#: Code points of a chunk and of its reach into the next; a wider round has so many times as many of both.
CHUNK, OVERLAP, WIDER = 1 << 15, 1 << 9, 16
#: Tokens above which a document is over the limit.
LIMIT = 1024
#: Characters that are counted in one go and encoded in one call, about; parts whose counts are remembered, and their longest.
CALL, JOINED, REMEMBERED, SHORT = 1 << 20, 1 << 16, 1 << 19, 64
#: No white space in any version of Unicode: visible ASCII and letters of Latin, Greek and Cyrillic.
VISIBLE = "!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u0148\u0391-\u03a1\u03a3-\u03c9\u0410-\u044f"
#: White space can only begin a word of the pattern, so a word ends before the first of a run.
WORD_END = re.compile(f"(?<=[{VISIBLE}])(?=[ \n])")
INNER = re.compile(f"[ \n].*[{VISIBLE}]", re.DOTALL)
#: Characters of the longest form of the word pattern that is decided by a fixed text (``'re``), and one to look ahead.
LOOKAHEAD = 4


def tokenizer_path() -> str:
    """File of the given byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def read_tokenizer(path: str) -> str:
    """Text of a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def margin(definition: str) -> int | None:
    """Characters at the end of a slice whose words are not decided yet, or None where slices prove nothing.

    Byte-level tokenizers of unchanged text split it by one pattern from left to right, after their special
    strings; for other kinds nothing is proven, and texts are encoded whole.
    """
    made = json.loads(definition)
    split = made["pre_tokenizer"] or {}
    apart = not any(t["single_word"] or t["lstrip"] or t["rstrip"] or " " in t["content"] for t in made["added_tokens"])
    known = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    if made["normalizer"] or not (known and apart):
        return None
    return LOOKAHEAD + max((len(t["content"]) for t in made["added_tokens"]), default=0)


_loaded: dict[int, object] = {}


def _load(definition: str):
    """The library's tokenizer, once for each worker; no padding, no truncation, one thread."""
    key = hash(definition)
    if key not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(definition)
        made.no_padding()
        made.no_truncation()
        _loaded[key] = made
    return _loaded[key]


def _calls(texts: list[str], most: int):
    """Runs of texts of about ``most`` characters."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def _part_sizes(made, parts: list[str]) -> dict[str, int]:
    """Tokens of different parts; those that may stand beside each other are encoded as one text, told apart by offsets."""
    inner = [part for part in parts if INNER.fullmatch(part)]
    others = list(set(parts).difference(inner))
    found = dict(zip(others, map(len, made.encode_batch_fast(others, add_special_tokens=False))))
    for run in _calls(inner, JOINED):
        starts = np.array([a for a, _ in made.encode("".join(run), add_special_tokens=False).offsets])
        upto = np.searchsorted(starts, np.cumsum(list(map(len, run))))
        found.update(zip(run, np.diff(upto, prepend=0).tolist()))
    return found


def _sizes(made, texts: list[str], known: dict[str, int] | None) -> list[int]:
    """Tokens of each text. With ``known``, texts are cut where words surely end, and equal parts are encoded once."""
    if known is None:
        return [len(e) for e in made.encode_batch_fast(texts, add_special_tokens=False)]
    if len(known) > REMEMBERED:
        known.clear()
    cut = [WORD_END.split(text) for text in texts]
    found = _part_sizes(made, list(set().union(*cut) - known.keys()))
    known.update(found)
    sizes = [sum(map(known.__getitem__, parts)) for parts in cut]
    for part in found:
        if len(part) > SHORT:
            del known[part]
    return sizes


def _counter(definition, apart: bool):
    def count(batches):
        made, known = _load(definition.value), {} if apart else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sizes = [n for run in _calls(texts, CALL) for n in _sizes(made, run, known)]
            kept = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(sizes, pa.int64())], names=[*kept, "n_tokens"]
            )

    return count


def boundaries(encoded) -> tuple[np.ndarray, np.ndarray]:
    """Positions where words begin in an encoded slice, and the tokens before each."""
    words = np.array([-1 if w is None else w for w in encoded.word_ids], np.int64)
    begins = np.flatnonzero(np.diff(words, prepend=-2))
    starts = np.array([a for a, _ in encoded.offsets], np.int64)
    return starts[begins], begins


SEEN = "array<struct<at:long,before:long>>"


def _chunk_counter(definition, ahead: int, chunk: int, overlap: int):
    seen = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))

    def count(batches):
        made = _load(definition.value)
        for batch in batches:
            columns: list[list] = [[], [], []]
            rows = zip(*(batch.column(c).to_pylist() for c in ("number", "last", "text")))
            for number, last, text in rows:
                encoded = made.encode(text, add_special_tokens=False)
                at, before = boundaries(encoded)
                left = (at < overlap) & (number > 0)
                right = (at >= chunk) & (at <= len(text) - ahead) & (not last)
                columns[0].append(len(encoded))
                for held, which in ((columns[1], left), (columns[2], right)):
                    pairs = zip((at[which] + number * chunk).tolist(), before[which].tolist())
                    held.append([{"at": a, "before": b} for a, b in pairs])
            kept = [n for n in batch.schema.names if n != "text"]
            counts = [pa.array(columns[0], pa.int64()), *(pa.array(c, seen) for c in columns[1:])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), *counts], names=[*kept, "n", "left_seen", "right_seen"]
            )

    return count


def _slicer(chunk: int, overlap: int):
    """Slice i of a text covers [i chunk, (i + 1) chunk + overlap), so that every slice but the last is full."""
    schema = pa.schema(
        [("key_id", pa.int64()), ("key_hash", pa.int64()), ("number", pa.int32()), ("last", pa.bool_()), ("text", pa.string())]
    )

    def cut(batches):
        for batch in batches:
            for key_id, key_hash, text in zip(*(batch.column(c) for c in (*KEY, "text"))):
                whole = text.as_py()
                last = max(-(-(len(whole) - overlap) // chunk), 1) - 1
                for number in range(last + 1):
                    part = whole[number * chunk : (number + 1) * chunk + overlap]
                    row = {"key_id": key_id.as_py(), "key_hash": key_hash.as_py(), "number": number, "last": number == last}
                    yield pa.RecordBatch.from_pylist([row | {"text": part}], schema)

    return cut


def _spliced(counted: DataFrame) -> DataFrame:
    """(key, n_tokens, whole) of documents from their chunks; ``whole`` is false where an overlap has no common boundary."""
    following = counted.select(*KEY, (F.col("number") - 1).alias("number"), F.col("left_seen").alias("next_seen"))
    common = F.array_intersect(F.transform("right_seen", lambda b: b["at"]), F.transform("next_seen", lambda b: b["at"]))
    met = counted.where("not last").join(following, [*KEY, "number"]).withColumn("at", F.array_min(common))

    def before(column: str) -> F.Column:
        return F.get(F.filter(column, lambda b: b["at"] == F.col("at")), F.lit(0))["before"]

    # What a chunk has before the splice counts for it, what the next has before the splice does not.
    joints = met.select(*KEY, (before("right_seen") - before("next_seen")).alias("n"), F.col("at").isNotNull().alias("met"))
    ends = counted.where("last").select(*KEY, "n", F.lit(True).alias("met"))
    return joints.union(ends).groupBy(*KEY).agg(F.sum("n").alias("n_tokens"), F.min("met").alias("whole"))


def _long_counts(spark: SparkSession, long: DataFrame, held, ahead: int, chunk: int, overlap: int) -> DataFrame:
    """(key, n_tokens) of long texts (key, text), one row for each key; copies are put together in the tasks first."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rest, found = long.groupBy(*KEY).agg(F.first("text").alias("text")), []
    while True:
        slices = rest.mapInArrow(_slicer(chunk, overlap), "key_id long, key_hash long, number int, last boolean, text string")
        counted = settle(
            slices.repartition(tasks, *KEY, "number").mapInArrow(
                _chunk_counter(held, ahead, chunk, overlap),
                f"key_id long, key_hash long, number int, last boolean, n long, left_seen {SEEN}, right_seen {SEEN}",
            )
        )
        spliced = settle(_spliced(counted))
        found.append(spliced.where("whole").select(*KEY, "n_tokens"))
        failed = spliced.where("not whole").select(*KEY)
        if failed.isEmpty():
            return reduce(DataFrame.union, found)
        rest = rest.join(failed, KEY, "left_semi")
        chunk, overlap = chunk * WIDER, overlap * WIDER


def count_tokens(
    spark: SparkSession,
    docs: DataFrame,
    *,
    path: str | None = None,
    limit: int = LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Tokens of every whole text as the library counts them, one row for each row.

    Returns doc_id, n_bytes, n_tokens and over_limit. No begin, end or added special token counts; the special
    strings of the vocabulary inside a text are one token each, as is the library's default. A null text is
    empty and has no tokens, null ids and repeated rows are rows like others, an empty table gives none, other
    columns are left behind. The file is read by the driver only and its text broadcast (some megabytes).
    Texts of at most ``chunk`` code points are encoded without a shuffle; of a tokenizer for which ``margin``
    proves nothing every text is encoded whole.
    """
    definition = read_tokenizer(path or tokenizer_path())
    ahead = margin(definition)
    held = spark.sparkContext.broadcast(definition)
    rows = keyed(docs, doc_id, text).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumns({"n_bytes": F.octet_length("text").cast("long"), "n_chars": F.char_length("text").cast("long")})
    kind = rows.schema["doc_id"].dataType.simpleString()

    def counted(some: DataFrame) -> DataFrame:
        return some.select("doc_id", "n_bytes", "text").mapInArrow(_counter(held, ahead is not None), f"doc_id {kind}, n_bytes long, n_tokens long")

    if ahead is None:
        made = counted(rows)
    else:
        long = rows.where(F.col("n_chars") > chunk)
        counts = _long_counts(spark, long.select(*KEY, "text"), held, ahead, chunk, overlap)
        of_long = long.select("doc_id", "n_bytes", *KEY).join(counts, KEY).select("doc_id", "n_bytes", "n_tokens")
        made = counted(rows.where(F.col("n_chars") <= chunk)).union(of_long)
    return made.withColumn("over_limit", F.col("n_tokens") > limit)
