"""Fill-in-the-middle documents as piece tables.

A document is a list of descriptors (buffer, start, length) over two buffers that never change: its own UTF-8
bytes and the sentinels. Cutting splits a descriptor, an arrangement permutes descriptors and puts sentinel
descriptors between them, and a digest streams what the descriptors name. The way back finds the sentinels in
an output, which cuts it into descriptors again, and applies the inverse permutation. Choices depend on the id
alone, so equal runs and retried tasks agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sentinels of prefix, suffix and middle, in this order.
SENTINELS = ("<P>", "<S>", "<M>")
#: Buffers of a descriptor.
TEXT, SENTINEL = 0, 1
PREFIX, SUFFIX, MIDDLE = 0, 1, 2
#: Sections of a form in the order of its output, each behind its sentinel; the document has prefix, middle, suffix.
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
IN_TEXT = (PREFIX, MIDDLE, SUFFIX)
#: Of 100 documents, so many are transformed, and of 100 of these, so many have the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
#: Bytes of output after which a batch is handed on, and bytes looked at in one step when characters are counted.
BATCH_BYTES, STEP = 1 << 24, 1 << 16

Piece = tuple[int, int, int]


def byte_position(text: np.ndarray, chars: int) -> int:
    """Bytes of the first ``chars`` code points of UTF-8 bytes."""
    for at in range(0, len(text), STEP):
        starts = (text[at : at + STEP] & 0xC0) != 0x80
        here = int(np.count_nonzero(starts))
        if chars < here:
            return at + int(np.flatnonzero(starts)[chars])
        chars -= here
    return len(text)


def split(pieces: list[Piece], at: int) -> list[Piece]:
    """The same pieces, cut after ``at`` bytes; a cut at an edge gives an empty piece."""
    made: list[Piece] = []
    for number, (buffer, start, length) in enumerate(pieces):
        if at <= length:
            return [*made, (buffer, start, at), (buffer, start + at, length - at), *pieces[number + 1 :]]
        made.append((buffer, start, length))
        at -= length
    raise ValueError("cut beyond the document")


def arranged(sections: list[Piece], form: str, sentinels: tuple[bytes, ...]) -> list[Piece]:
    """Pieces of prefix, middle and suffix in the order of the form, each behind the piece of its sentinel."""
    by_kind = dict(zip(IN_TEXT, sections))
    made: list[Piece] = []
    for kind in FORMS[form]:
        made += [(SENTINEL, sum(map(len, sentinels[:kind])), len(sentinels[kind])), by_kind[kind]]
    return made


def found(output: bytes, form: str, sentinels: tuple[bytes, ...]) -> list[Piece]:
    """Pieces of prefix, middle and suffix over an output: the sentinels are found from left to right and permuted back."""
    order, by_kind, at = FORMS[form], {}, 0
    for number, kind in enumerate(order):
        at += len(sentinels[kind])
        following = output.find(sentinels[order[number + 1]], at) if number + 1 < len(order) else len(output)
        by_kind[kind] = (TEXT, at, following - at)
        at = following
    return [by_kind[kind] for kind in IN_TEXT]


def stream(pieces: list[Piece], buffers: tuple[memoryview, memoryview]) -> Iterator[memoryview]:
    """The bytes that descriptors name, one view after the other."""
    for buffer, start, length in pieces:
        yield buffers[buffer][start : start + length]


def digest(pieces: list[Piece], buffers: tuple[memoryview, memoryview]) -> str:
    """SHA-256 of the bytes that descriptors name."""
    running = hashlib.sha256()
    for part in stream(pieces, buffers):
        running.update(part)
    return running.hexdigest()


def _bounded(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about BATCH_BYTES of a text column, one row at least."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    number = (np.cumsum(sizes) - sizes) // BATCH_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def _arranger(sentinels: tuple[bytes, ...]):
    marks = memoryview(b"".join(sentinels))
    descriptor = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))

    def arrange(batches):
        for batch in (part for whole in batches for part in _bounded(whole, "text")):
            tables, outputs, shas = [], [], []
            forms, firsts, seconds = (batch.column(c).to_pylist() for c in ("form", "cut_1", "cut_2"))
            for text, form, first, second in zip(batch.column("text"), forms, firsts, seconds):
                own = memoryview(text.as_buffer())
                pieces = [(TEXT, 0, len(own))]
                if form != "plain":
                    codes = np.frombuffer(own, np.uint8)
                    for cut in (first, second):
                        pieces = split(pieces, byte_position(codes, cut))
                    pieces = arranged(pieces, form, sentinels)
                buffers = (own, marks)
                tables.append([{"buffer": b, "start": s, "length": n} for b, s, n in pieces])
                outputs.append(b"".join(stream(pieces, buffers)))
                shas.append(digest(pieces, buffers))
            kept = [n for n in batch.schema.names if n not in ("text", "cut_1", "cut_2")]
            made = [pa.array(tables, descriptor), pa.array(outputs, pa.string()), pa.array(shas, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), *made], names=[*kept, "pieces", "output", "output_sha256"]
            )

    return arrange


def arrange(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    sentinels: tuple[str, str, str] = SENTINELS,
    transformed: int = TRANSFORMED,
    suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """Documents with prefix, suffix and middle in a form chosen by the id, one row for each row.

    Returns doc_id, n (code points), form, prefix_chars, middle_chars (null if plain), pieces (the descriptors,
    in bytes), output and output_sha256. Cuts and form come from the SHA-256 of ``1:`` and the id as text. A
    null text is empty, a null id counts as empty text, an empty text or one that holds a sentinel is plain;
    rows that repeat an id and a text give equal rows, an empty table none. Other columns are left behind.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    chosen = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    numbers = {f"h{i + 1}": F.conv(F.substring("hex", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)}
    rows = rows.withColumns({"hex": chosen, "n": F.char_length("text").cast("long")}).withColumns(numbers)
    marked = F.lit(False)
    for sentinel in sentinels:
        marked = marked | F.contains("text", F.lit(sentinel))
    plain = (F.col("n") == 0) | marked | (F.col("h3") % 100 >= transformed)
    cuts = [F.col(h) % (F.col("n") + 1) for h in ("h1", "h2")]
    rows = rows.withColumns(
        {
            "form": F.when(plain, "plain").when(F.col("h4") % 100 < suffix_first, "spm").otherwise("psm"),
            "cut_1": F.least(*cuts),
            "cut_2": F.greatest(*cuts) - F.least(*cuts),
        }
    )
    counted = [F.when(F.col("form") != "plain", F.col(c)).alias(a) for c, a in (("cut_1", "prefix_chars"), ("cut_2", "middle_chars"))]
    rows = rows.select("doc_id", "n", "form", *counted, "text", "cut_1", (F.col("cut_1") + F.col("cut_2")).alias("cut_2"))
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("text", "cut_1", "cut_2"))
    return rows.mapInArrow(
        _arranger(tuple(s.encode() for s in sentinels)),
        f"{kept}, pieces array<struct<buffer:int,start:long,length:long>>, output string, output_sha256 string",
    )


def _restorer(sentinels: tuple[bytes, ...], whole: bool):
    marks = memoryview(b"".join(sentinels))

    def restore(batches):
        for batch in (part for held in batches for part in _bounded(held, "output")):
            texts, shas = [], []
            for output, form in zip(batch.column("output"), batch.column("form").to_pylist()):
                own = output.as_buffer().to_pybytes()
                pieces = [(TEXT, 0, len(own))] if form == "plain" else found(own, form, sentinels)
                buffers = (memoryview(own), marks)
                shas.append(digest(pieces, buffers))
                if whole:
                    texts.append(b"".join(stream(pieces, buffers)))
            kept = [n for n in batch.schema.names if n != "output"]
            made = {"text": pa.array(texts, pa.string())} if whole else {}
            made["restored_sha256"] = pa.array(shas, pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *made.values()], names=[*kept, *made])

    return restore


def restore(made: DataFrame, *, sentinels: tuple[str, str, str] = SENTINELS, whole: bool = True) -> DataFrame:
    """The documents of arranged ones, from output and form alone.

    Returns all other columns with text (unless ``whole`` is false) and restored_sha256 in place of the output.
    A cut next to a part of a sentinel cannot forge one, as a sentinel begins with a character that it has once.
    """
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in made.schema if f.name != "output")
    return made.mapInArrow(
        _restorer(tuple(s.encode() for s in sentinels), whole), f"{kept}, {'text string, ' if whole else ''}restored_sha256 string"
    )


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """Form, cuts, digest of the output and digest of the restored text of every document."""
    made = arrange(docs).drop("pieces")
    return restore(made, whole=False)
