"""Exact top-k search by tiled matrix products.

Vectors become integers and are packed into blocks of rows. Every pair of a query block and a shard is a
tile: one matrix product. Query blocks come in bundles and shards in stripes; a task holds a bundle and its queries'
best k so far while the shards of a stripe pass, and a shard is sent once for each bundle. The lists of a query from all
stripes are merged in a tree of bounded fan-in.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.session import settle

#: Rows of a query block and of a shard, and bytes of a block at most.
QUERY_ROWS, SHARD_ROWS, BLOCK_BYTES = 1024, 4096, 1 << 21
#: Query blocks of a bundle and shards of a stripe on average, at most.
BUNDLE_BLOCKS, STRIPE_SHARDS = 64, 64
#: Lists that one step of the tree merges.
FAN_IN = 16


def quantised(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component as a long, or null if any component is null or not finite."""
    whole = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.when(whole, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint")))


def _packer(rows_at_most: int):
    def pack(batches):
        """Blocks of one partition: ids and integers of up to so many rows of equal length."""
        held: dict[int, list] = {}
        serial = 0

        def block(dim, ids, parts):
            nonlocal serial
            matrix = np.concatenate(parts)
            order = np.argsort(np.array(ids), kind="stable")
            serial += 1
            # Most numbers are small, and a shard travels once for each bundle.
            top = max(-int(matrix.min(initial=0)), int(matrix.max(initial=0)) + 1)
            width = next(w for w in (2, 4, 8) if top <= 1 << (8 * w - 1))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([dim], pa.int32()),
                    pa.array([serial], pa.int64()),
                    pa.array([np.array(ids, "<i8")[order].tobytes()], pa.binary()),
                    pa.array([width], pa.int32()),
                    pa.array([matrix[order].astype(f"<i{width}").tobytes()], pa.binary()),
                ],
                names=["dim", "serial", "ids", "width", "numbers"],
            )

        for batch in batches:
            lists = batch.column("numbers")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            bounds = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))])
            for i, vec_id in enumerate(batch.column("vec_id").to_pylist()):
                row = flat[bounds[i] : bounds[i + 1]][None]
                dim = row.shape[1]
                ids, parts = held.setdefault(dim, ([], []))
                ids.append(vec_id), parts.append(row)
                if len(ids) >= max(1, min(rows_at_most, BLOCK_BYTES // (8 * max(dim, 1)))):
                    yield block(dim, *held.pop(dim))
        for dim, (ids, parts) in held.items():
            yield block(dim, ids, parts)

    return pack


def _blocks(vectors: DataFrame, rows_at_most: int) -> DataFrame:
    packed = vectors.mapInArrow(_packer(rows_at_most), "dim int, serial long, ids binary, width int, numbers binary")
    return settle(packed.select(F.xxhash64("ids", "serial").alias("block"), "dim", "ids", "width", "numbers"))


def select_best(scores: np.ndarray, barred: np.ndarray, k: int, bound: int) -> list[np.ndarray]:
    """Per row of ``scores`` the columns of its k best, ties to the smaller column, barred ones left out.

    With room for it, score and column go into one number, all different, and a partial selection is
    exact. ``bound`` is the largest absolute score there can be.
    """
    n = scores.shape[1]
    if (bound + 1) * n < 1 << 52:
        mixed = scores * n + np.arange(n - 1, -1, -1)
        mixed[barred] = -np.inf
        best = np.argpartition(-mixed, k - 1, axis=1)[:, :k] if k < n else np.tile(np.arange(n), (len(mixed), 1))
        return [row[~out[row]] for row, out in zip(best, barred)]
    rows = ((np.flatnonzero(~out), row) for row, out in zip(scores, barred))
    return [np.array(sorted(free, key=lambda c, s=row: (-s[c], c))[:k], int) for free, row in rows]


class _Held:
    """A block of queries and the best k that each has met so far, as (-1 - score, id) in rising order."""

    def __init__(self, ids: np.ndarray, numbers: np.ndarray, k: int):
        self.ids, self.numbers, self.k = ids, numbers, k
        self.less, self.found = (np.zeros((len(ids), k), np.int64) for _ in range(2))
        self.size = np.zeros(len(ids), np.int64)

    def meet(self, s_ids: np.ndarray, shard: np.ndarray) -> None:
        top = [max(abs(int(m.min(initial=0))), abs(int(m.max(initial=0)))) for m in (self.numbers, shard)]
        bound = top[0] * top[1] * shard.shape[1]
        exact = bound < 1 << 53
        right = shard.astype(np.float64 if exact else object).T
        for start in range(0, len(self.ids), 128):
            here = slice(start, start + 128)
            own = self.ids[here]
            part = self.numbers[here].astype(right.dtype)
            scores = part @ right if shard.shape[1] else np.zeros((len(own), len(s_ids)))
            barred = own[:, None] == s_ids[None, :]
            row, column = self._hopeful(scores, barred, here, bound, exact)
            if not len(row):
                continue
            values = scores[row, column]
            if exact:
                values = values.astype(np.int64)
            else:  # a score beyond a long's range counts as the nearest long
                values = np.array([min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in values], np.int64)
            self._keep(here, row, -1 - values, s_ids[column])

    def _hopeful(self, scores: np.ndarray, barred: np.ndarray, here: slice, bound: int, exact: bool):
        """Places of scores that may be among the best k of their rows."""
        if exact:
            least = np.where(self.size[here] == self.k, -1.0 - self.less[here, -1], -np.inf)
            reach = scores >= least[:, None]
            reach &= ~barred
            if np.count_nonzero(reach) <= 4 * self.k * len(scores):
                return np.nonzero(reach)
        best = select_best(scores, barred, self.k, bound)
        return np.repeat(np.arange(len(best)), [len(c) for c in best]), np.concatenate([*best, np.empty(0, int)]).astype(int)

    def _keep(self, here: slice, row: np.ndarray, less: np.ndarray, ids: np.ndarray) -> None:
        size = self.size[here]
        before = np.arange(self.k) < size[:, None]
        row = np.concatenate([np.nonzero(before)[0], row])
        less = np.concatenate([self.less[here][before], less])
        ids = np.concatenate([self.found[here][before], ids])
        order = np.lexsort((ids, less, row))
        row, less, ids = row[order], less[order], ids[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best = place < self.k
        row, place = row[best], place[best]
        self.less[here][row, place], self.found[here][row, place] = less[best], ids[best]
        self.size[here] = np.bincount(row, minlength=len(size))


LISTS = "query_id long, place long, top array<struct<less:long,vec_id:long>>"


def _search(k: int):
    def search(batches):
        """Top lists of the queries of each cell, whose query blocks come before its shards."""
        held: dict[int, dict[int, list[_Held]]] = {}
        stripes = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                ids, numbers = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["numbers"], f"<i{row['width']}").astype(np.int64)
                numbers = numbers.reshape(len(ids), -1)
                mine = held.setdefault(row["cell"], {}).setdefault(row["dim"], [])
                stripes[row["cell"]] = row["stripe"]
                if row["is_shard"]:
                    for block in mine:
                        block.meet(ids, numbers)
                else:
                    mine.append(_Held(ids, numbers, k))
        for cell, dims in held.items():
            for blocks in dims.values():
                for block in blocks:
                    yield _listed(block, stripes[cell])

    return search


def _listed(block: _Held, stripe: int) -> pa.RecordBatch:
    """Rows (query_id, place, top list) of the queries of a block that have found anything."""
    some = np.flatnonzero(block.size)
    before = np.arange(block.k) < block.size[some, None]
    entries = pa.StructArray.from_arrays([pa.array(block.less[some][before]), pa.array(block.found[some][before])], names=["less", "vec_id"])
    bounds = pa.array(np.concatenate([[0], np.cumsum(block.size[some])]), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(block.ids[some], pa.int64()), pa.array([stripe] * len(some), pa.int64()), pa.ListArray.from_arrays(bounds, entries)],
        names=["query_id", "place", "top"],
    )


def merge_tree(lists: DataFrame, k: int, places: int) -> DataFrame:
    """One top list a query from rows (query_id, place, top): places fall together FAN_IN at a time."""
    while True:
        places = -(-places // FAN_IN)
        lists = (
            lists.withColumn("place", F.floor(F.col("place") / FAN_IN))
            .groupBy("query_id", "place")
            .agg(F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias("top"))
        )
        if places <= 1:
            return lists.select("query_id", "top")


def search(queries: DataFrame, vectors: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best among all vectors of another id.

    Both tables have vec_id and numbers (lists of longs); rows with null in either take no part. Scores are
    exact integer inner products; ties go to the smaller vec_id. Vectors of different length do not meet;
    those of length 0 score 0. Every candidate row counts, also if it repeats an id; of query rows that
    share an id the one with the smallest list is used. Queries without candidates, and empty tables, give
    no rows.
    """
    usable = [t.where(F.col("vec_id").isNotNull() & F.col("numbers").isNotNull()) for t in (queries, vectors)]
    asked = settle(usable[0].groupBy("vec_id").agg(F.min("numbers").alias("numbers")))
    asked = asked.repartition(max(1, -(-asked.count() // QUERY_ROWS)))
    left, right = _blocks(asked, QUERY_ROWS), _blocks(usable[1], SHARD_ROWS)
    across, down = max(1, left.count()), max(1, right.count())
    bundles = -(-across // BUNDLE_BLOCKS)
    # Few queries leave room for more stripes, until a cell holds about one shard.
    tasks = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stripes = max(-(-down // STRIPE_SHARDS), min(down, -(-tasks // bundles)))
    bundle, stripe = (F.pmod("block", F.lit(n)) for n in (bundles, stripes))
    every = {n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (bundles, stripes)}
    blocks = left.withColumns({"is_shard": F.lit(False), "bundle": bundle}).withColumn("stripe", every[stripes])
    shards = right.withColumns({"is_shard": F.lit(True), "stripe": stripe}).withColumn("bundle", every[bundles])
    named = ["is_shard", "dim", "ids", "width", "numbers", *(F.col(c).cast("int").alias(c) for c in ("bundle", "stripe"))]
    sides = blocks.select(*named).unionByName(shards.select(*named)).withColumn("cell", F.col("bundle") * stripes + F.col("stripe"))
    # No join: the size of what is sent out so often cannot be guessed, and a guess too small would broadcast it.
    cells = sides.repartitionById(bundles * stripes, F.col("cell")).sortWithinPartitions("cell", "is_shard")
    merged = merge_tree(cells.mapInArrow(_search(k), LISTS), k, stripes)
    return merged.select("query_id", F.posexplode("top").alias("at", "t")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "t.vec_id", F.bitwise_not("t.less").alias("score")
    )
