"""Records of delimited files, read by many tasks although quoted text may hold line breaks.

A line break ends a record where the number of quotes before it is even. Quotes are counted for each file block,
and the parity of all earlier blocks tells whether a block begins inside quotes; from there on every task
finds the ends of its records alone. What a block's edge cuts, comes out as fragments, which are put together by
the block in which their record began.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from depotlens.session import settle

QUOTE = '"'
#: A whole record, and the parts of a cut one: its beginning, and what follows up to its end or the block's.
RECORD, BEGINNING, FOLLOWING = 0, 1, 2
SCHEMA = pa.schema([("kind", pa.int8()), ("file", pa.string()), ("block", pa.int64()), ("head", pa.bool_()), ("text", pa.string())])
COLUMNS = "kind tinyint, file string, block bigint, head boolean, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line) in file order within a task; only LF ends a line, so CR stays in the text."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line")
    )


def begins_quoted(lines: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """By file: the starts of its blocks, and whether each begins inside quotes. One small row a block comes to the driver."""
    quotes = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(QUOTE), F.lit("")))
    counted = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).cast("int").alias("odd")).orderBy("file", "block")
    files: dict[str, list[tuple[int, int]]] = {}
    for row in counted.collect():
        files.setdefault(row["file"], []).append((row["block"], row["odd"]))
    made = {}
    for file, blocks in files.items():
        odd = np.array([o for _, o in blocks])
        made[file] = np.array([b for b, _ in blocks], np.int64), (np.cumsum(odd) - odd) % 2 == 1
    return made


class _Block:
    """Lines of one file block: yields its records, and its fragments at both ends."""

    def __init__(self, file: str, block: int, quoted: bool):
        self.file, self.block = file, block
        self.quotes = int(quoted)
        self.cut = quoted  # no end of a record was seen yet, and the block began within one
        self.first = block == 0
        self.held: list[pa.Array] = []

    def _made(self, texts: pa.Array, kind: int) -> pa.RecordBatch:
        n = len(texts)
        head = np.zeros(n, bool)
        if self.first and n:
            head[0], self.first = True, False
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int8)), pa.array([self.file] * n, pa.string()), pa.array(np.full(n, self.block)), pa.array(head), texts],
            schema=SCHEMA,
        )

    @staticmethod
    def _joined(parts: list[pa.Array]) -> pa.Array:
        lines = pa.concat_arrays(parts)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), lines), "\n")

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        upto = self.quotes + np.cumsum(pc.count_substring(lines, QUOTE).to_numpy(zero_copy_only=False))
        ends = np.flatnonzero(upto % 2 == 0)
        self.quotes = int(upto[-1]) % 2
        if not len(ends):
            self.held.append(lines)
            return
        start = 0
        if self.held or self.cut:
            start = int(ends[0]) + 1
            kind = FOLLOWING if self.cut else RECORD
            yield self._made(self._joined([*self.held, lines.slice(0, start)]), kind)
            self.held, self.cut, ends = [], False, ends[1:]
        if len(ends):
            # Records between ends: runs of lines, joined by the line breaks that are part of them.
            bounds = pa.array(np.concatenate([[start], ends + 1]) - start, pa.int32())
            whole = lines.slice(start, int(ends[-1]) + 1 - start)
            yield self._made(pc.binary_join(pa.ListArray.from_arrays(bounds, whole), "\n"), RECORD)
            start = int(ends[-1]) + 1
        if start < len(lines):
            self.held.append(lines.slice(start))

    def finish(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield self._made(self._joined(self.held), FOLLOWING if self.cut else BEGINNING)


def _finder(quoted: dict[str, tuple[np.ndarray, np.ndarray]]):
    def find(batches):
        here: _Block | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
            lines = batch.column("line")
            cuts = [0, *(i for i in range(1, len(files)) if blocks[i] != blocks[i - 1] or files[i] != files[i - 1]), len(files)]
            for start, end in zip(cuts, cuts[1:]):
                file, block = files[start], blocks[start]
                if here is None or (here.file, here.block) != (file, block):
                    if here is not None:
                        yield from here.finish()
                    starts, within = quoted[file]
                    place = int(np.searchsorted(starts, block))
                    if place == len(starts) or starts[place] != block:
                        raise RuntimeError(f"blocks of {file} changed between two passes")
                    here = _Block(file, block, bool(within[place]))
                yield from here.add(lines.slice(start, end - start))
        if here is not None:
            yield from here.finish()

    return find


def records(spark: SparkSession, path: str) -> DataFrame:
    """(head, text) of every record of the delimited files at a path; ``head`` marks the first of a file.

    Records end with LF or CR LF; empty ones are left out. Quotes stand around fields or doubled inside quoted
    ones, as all common writers put them; a stray quote in a plain field would end the record elsewhere.
    """
    lines = _lines(spark, path)
    found = lines.mapInArrow(_finder(begins_quoted(lines)), COLUMNS)
    # Only rows at the edges of blocks, at most two for each, go through the second way.
    edges = settle(found.where(f"kind <> {RECORD}"))
    upto = Window.partitionBy("file").orderBy("block", F.desc("kind"))
    began = F.sum((F.col("kind") == BEGINNING).cast("bigint")).over(upto)
    places = edges.select("file", "block", "kind").withColumn("began", began)
    parts = F.array_sort(F.collect_list(F.struct("block", "text")))
    cut = (
        edges.join(places, ["file", "block", "kind"])
        .groupBy("file", "began")
        .agg(F.max("head").alias("head"), F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))
    )
    whole = found.where(f"kind = {RECORD}").select("head", "text").unionByName(cut.select("head", "text"))
    return whole.withColumn("text", F.regexp_replace("text", "\\r$", "")).where("text <> ''")
