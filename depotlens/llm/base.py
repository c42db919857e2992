"""Columns and row keys that several text operators share."""

from __future__ import annotations

from functools import reduce
from string import ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; an unknown id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(divisor)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and every other character as it is.

    Texts of ASCII alone take the built-in conversion, which changes nothing but these letters.
    """
    folded = reduce(lambda c, x: F.replace(c, F.lit(x), F.lit(x.lower())), ascii_uppercase, text)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(folded)


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """Columns doc_id, text and the join key (key_id, key_hash) of a row; with ``whole``, also the row itself.

    The key is never null, tells apart rows that share an id but not a text, and is the same for
    rows that repeat both. Other columns are left behind or inside ``row``, so their names cannot clash.
    """
    kept = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if whole else []
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), *kept)
    return named.select(
        "*",
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-1)).alias("key_id"),
        F.xxhash64("text", F.col("text").isNull(), F.col("doc_id").isNull()).alias("key_hash"),
    )


KEY = ["key_id", "key_hash"]


def runs(batches, keys: list[str]):
    """Arrow tables of consecutive rows with equal integer keys, over the batches of one sorted partition."""
    import numpy as np
    import pyarrow as pa

    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(batch.num_rows, bool)
        for c in columns:
            changed[1:] |= c[1:] != c[:-1]
        head = tuple(c[0] for c in columns)
        if held and head != last:
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if start:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)
