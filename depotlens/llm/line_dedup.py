"""Line deduplication by overlapping windows of consecutive lines, with DataFrame work only.

Every run of ``window`` lines is hashed, and a shorter text as a whole; windows that occur more than once are found over the whole table,
and all lines covered by an occurrence after the first are removed. The covered positions of a document
are merged, so overlapping windows remove a long repeated passage as one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.llm.base import KEY, keyed
from depotlens.session import settle

#: Type of the hashes of a text's windows.
HASHES = "array<struct<a:bigint,b:bigint>>"


def _hashes(lines: Column, window: int) -> Column:
    """Two independent 64-bit hashes of each window of lines, in order of position."""

    def of(i: Column) -> Column:
        parts = [F.get(lines, i - 1 + k) for k in range(window)]
        return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(*reversed(parts), F.lit(window)).alias("b"))

    # All lines of a shorter text, with their number, so that no window of full length has the same hashes.
    held = F.size(lines)
    short = F.struct(F.xxhash64(lines, held).alias("a"), F.xxhash64(held, lines, F.lit(window)).alias("b"))
    whole = F.when(F.array_join(lines, "") != "", F.array(short)).otherwise(F.array().cast(HASHES))
    return F.when(held >= window, F.transform(F.sequence(F.lit(1), held - window + 1), of)).otherwise(whole)


def window_table(rows: DataFrame, window: int = 3) -> DataFrame:
    """(key, start, a, b): the hash of every window of lines; a text of fewer lines is one window, unless all are empty."""
    listed = rows.where(F.col("text").isNotNull()).select(*KEY, F.split("text", "\n").alias("lines"))
    return listed.select(*KEY, F.posexplode(_hashes(F.col("lines"), window)).alias("start", "h")).select(
        *KEY, "start", "h.a", "h.b"
    )


def later_occurrences(windows: DataFrame) -> DataFrame:
    """(key, start) of every window that an earlier one, by document key and position, equals.

    Counting and the smallest occurrence are combined before the shuffle, so a window that a third of
    all documents hold costs one row a task there; the join back is dealt by Spark's skew handling.
    """
    place = F.struct(*KEY, "start")
    repeated = (
        windows.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last")
    )
    return windows.join(repeated.select("a", "b", "first"), ["a", "b"]).where(place > F.col("first")).select(*KEY, "start")


def covered_lines(later: DataFrame, window: int = 3) -> DataFrame:
    """(key, gone): sorted positions of the lines to remove, merged over all windows of a document."""
    starts = later.groupBy(*KEY).agg(F.collect_set("start").alias("starts"))
    spread = F.flatten(F.transform("starts", lambda s: F.sequence(s, s + window - 1)))
    return starts.select(*KEY, F.array_sort(F.array_distinct(spread)).alias("gone"))


def dedup_lines(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = 3, whole: bool = False
) -> DataFrame:
    """Texts without the later occurrences of repeated windows of ``window`` lines.

    Returns doc_id, n_lines, n_removed and text, and with ``whole`` the input row as a struct. Lines end at a line feed and are compared as they are, case
    and spaces included. The first occurrence, by doc_id and position, stays; a row that repeats an earlier
    row in id and text counts as the same occurrence and stays as well. Rows of null id stand at -1 in this order. A null
    text has 0 lines and stays null, an empty text has one empty line. A text that loses all its lines
    becomes empty. A text of fewer lines than a window, some of them not empty, is one window of all its
    lines, which only equal texts repeat.
    """
    rows = keyed(docs, doc_id, text, whole)
    windows = settle(window_table(rows, window))
    gone = covered_lines(later_occurrences(windows), window)
    held = rows.join(gone, KEY, "left").withColumn("lines", F.split("text", "\n"))
    held = held.withColumn("gone", F.filter("gone", lambda p: p < F.size("lines")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    left = F.transform(stay, lambda i: F.get("lines", i))
    return held.select(
        "doc_id",
        F.greatest(F.coalesce(F.size("lines"), F.lit(0)), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("text"),
        *(["row"] if whole else []),
    )
