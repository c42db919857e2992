"""Near-duplicate groups by a signature-coordinate inverted join.

Equal shingle sets become one node. A node is posted under its first (coordinate, value) pairs and its
size class. Posting lists are cut into blocks, and pairs of blocks form bounded tiles. In a tile
the collisions of all coordinates are counted for whole blocks at once; a pair is skipped where an earlier
posting list holds it too, and goes on when it agrees in enough of all coordinates. What goes on is
confirmed on full shingle sets, and links are joined to components. Tiles return at most a spanning forest
of links, so no group of copies ever becomes a table of all its pairs.

The posted coordinates and the agreements asked for follow from the threshold, so that a pair at the
threshold is missed with probability ``MISS`` at most: at 0.85, 10 posted coordinates and 40 of 64
agreements (6e-9 and 2.4e-6). Both fall steeply for closer pairs.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.llm.base import KEY, keyed, runs
from depotlens.llm.components import components
from depotlens.session import settle

#: Coordinates of a signature at least, and the probability at most to miss a pair at the threshold.
COORDINATES, MISS = 64, 3e-6
#: Rows of a block at most, and bytes of shingles that the blocks of a tile aim at.
BLOCK_ROWS, BLOCK_BYTES = 1024, 1 << 23
TILE = ["list_id", "lo", "hi"]


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words; all words as one run if they are fewer."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    run = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        run = (run ^ each[i : i + len(run)]) * np.uint64(0x9E3779B97F4A7C15)
        run ^= run >> np.uint64(29)
    return np.unique(run)


@lru_cache
def agreements(percent: int) -> tuple[int, int, int]:
    """Coordinates of a signature, posted ones, and agreements asked for at a resemblance of ``percent`` / 100.

    All posted coordinates differ with a hundredth of ``MISS`` at most, agreements fall short with the rest.
    """
    if not 0 < percent <= 100:
        raise ValueError(f"percent must be above 0 and 100 at most, not {percent}")
    p = percent / 100
    prefix = math.ceil(math.log(MISS / 100) / math.log1p(-p)) if p < 1 else 1
    size = max(COORDINATES, prefix)
    below, least = 0.0, 0
    while least < size:
        below += math.comb(size, least) * p**least * (1 - p) ** (size - least)
        if below > MISS * 0.99:
            break
        least += 1
    return size, prefix, max(least, 1)


@lru_cache
def _multipliers(size: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240229)
    odd = draw.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, draw.integers(0, 1 << 63, size, dtype=np.uint64)


def signature(shingles: np.ndarray, size: int = COORDINATES) -> np.ndarray:
    """Smallest of each of the random 32-bit orders over a set."""
    times, plus = _multipliers(size)
    best = np.full(size, np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(shingles), 2048):
        values = (shingles[start : start + 2048, None] * times + plus) >> np.uint64(32)
        best = np.minimum(best, values.min(axis=0).astype(np.uint32))
    return best


def _sketcher(width: int, percent: int):
    size, prefix, _ = agreements(percent)

    def sketch(batches):
        for batch in batches:
            rows = {"n": [], "set_id": [], "heads": [], "tail": []}
            for text in batch.column("text"):
                found = shingle_set(text.as_py(), width)
                rows["n"].append(len(found))
                if not len(found):
                    rows["set_id"].append(None), rows["heads"].append(None), rows["tail"].append(None)
                    continue
                values = signature(found, size)
                rows["set_id"].append(xxhash.xxh3_128_digest(found.tobytes()))
                rows["heads"].append(values[:prefix].astype(np.int32))
                rows["tail"].append(values[prefix:].astype(np.uint8).tobytes())
            kept = [batch.column(c) for c in ("doc_id", *KEY)]
            made = [pa.array(rows["n"], pa.int64()), pa.array(rows["set_id"], pa.binary())]
            made += [pa.array(rows["heads"], pa.list_(pa.int32())), pa.array(rows["tail"], pa.binary())]
            yield pa.RecordBatch.from_arrays(kept + made, names=["doc_id", *KEY, *rows])

    return sketch


def _posted(nodes: DataFrame, percent: int) -> DataFrame:
    """(list_id, size class bound) postings of the nodes: first coordinates, own and, near its bound, next class.

    Sizes of linked sets differ by ``percent`` at most, so the smaller one is always posted in the class
    of the larger.
    """
    width = 4 * math.log(100 / percent)
    size = F.col("n").cast("double")
    low, high = F.floor(F.log(size) / width), F.floor(F.log(size * 100 / percent + 1) / width)
    spread = nodes.select("*", F.explode(F.sequence(low, high)).alias("class"))
    return spread.select(
        "set_id", "n", "heads", "tail", "class", F.posexplode("heads").alias("coordinate", "value")
    ).withColumn("list_id", F.xxhash64("coordinate", "value", "class"))


def _tiles(nodes: DataFrame, percent: int) -> DataFrame:
    """Rows of posting lists with two nodes or more, dealt into pairs of bounded blocks."""
    width = 4 * math.log(100 / percent)
    postings = _posted(nodes, percent)
    lists = postings.groupBy("list_id").agg(F.count("*").alias("held")).where("held > 1")
    room = F.least(F.lit(BLOCK_ROWS), F.greatest(F.lit(16), F.floor(BLOCK_BYTES / 8 / F.exp((F.col("class") + 1) * width))))
    blocks = F.ceil(F.col("held") / room).cast("int")
    own = F.pmod(F.xxhash64("set_id", "list_id"), blocks).cast("int")
    dealt = postings.join(lists, "list_id").select("*", blocks.alias("blocks"), own.alias("own"))
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "list_id",
        F.least("own", "other").alias("lo"),
        F.greatest("own", "other").alias("hi"),
        "own",
        "coordinate",
        "set_id",
        "n",
        "heads",
        "tail",
    )


def _matches(tile: pa.Table, percent: int):
    """Pairs (i, j, agreements) of a tile over the threshold whose first common coordinate is the tile's own."""
    heads = np.stack(tile.column("heads").to_pylist()).astype(np.int32)
    tail = np.frombuffer(b"".join(tile.column("tail").to_pylist()), np.uint8).reshape(len(heads), -1)
    n, own = tile.column("n").to_numpy(), tile.column("own").to_numpy()
    low, high = tile.column("lo")[0].as_py(), tile.column("hi")[0].as_py()
    at, least = tile.column("coordinate")[0].as_py(), agreements(percent)[2]
    left = np.flatnonzero(own == low)
    right = left if low == high else np.flatnonzero(own == high)
    for start in range(0, len(left), 256):
        part = left[start : start + 256]
        count = np.zeros((len(part), len(right)), np.uint16)
        fresh = n[part][:, None] * 100 >= n[right][None, :] * percent
        fresh &= n[right][None, :] * 100 >= n[part][:, None] * percent
        if low == high:
            fresh &= part[:, None] < right[None, :]
        for c in range(heads.shape[1]):
            equal = heads[part, c][:, None] == heads[right, c][None, :]
            if c < at:
                fresh &= ~equal
            count += equal
        for c in range(tail.shape[1]):
            count += tail[part, c][:, None] == tail[right, c][None, :]
        for i, j in np.argwhere(fresh & (count >= least)):
            yield part[i], right[j], count[i, j]


def _screen(percent: int):
    def screen(batches):
        for tile in runs(batches, TILE):
            if tile.num_rows < 2:
                continue
            kept = np.unique([x for i, j, _ in _matches(tile, percent) for x in (i, j)]).astype(np.int64)
            if len(kept):
                yield from tile.take(pa.array(kept)).select([*TILE, "own", "coordinate", "set_id"]).to_batches()

    return screen


def _confirm(percent: int):
    def confirm(batches):
        for tile in runs(batches, TILE):
            ids, sets = tile.column("set_id").to_pylist(), tile.column("shingles").to_pylist()
            sets = [np.frombuffer(s, np.uint64) for s in sets]
            root = list(range(len(ids)))

            def top(x: int) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            links = []
            for i, j, _ in sorted(_matches(tile, percent), key=lambda m: -int(m[2])):
                a, b = top(i), top(j)
                if a == b:
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    root[a] = b
                    links.append((ids[i], ids[j]))
            if links:
                u, v = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["u", "v"])

    return confirm


def _shingler(width: int):
    def shingle(batches):
        for batch in batches:
            sets = [shingle_set(t.as_py(), width).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("set_id"), pa.array(sets, pa.binary())], names=["set_id", "shingles"]
            )

    return shingle


def _in_tiles(rows: DataFrame) -> DataFrame:
    return rows.repartition(*TILE).sortWithinPartitions(*TILE)


def links_between(rows: DataFrame, sketches: DataFrame, width: int, percent: int) -> DataFrame:
    """Confirmed links (u, v) between shingle sets, a spanning forest of each tile."""
    nodes = settle(
        sketches.where(F.col("set_id").isNotNull())
        .groupBy("set_id")
        .agg(*(F.first(c).alias(c) for c in ("n", "heads", "tail")), F.min(F.struct(*KEY)).alias("row"))
    )
    tile_rows = "list_id long, lo int, hi int, own int, coordinate int, set_id binary"
    near = settle(_in_tiles(_tiles(nodes, percent)).mapInArrow(_screen(percent), tile_rows))
    wanted = nodes.join(near.select("set_id").distinct(), "set_id", "left_semi").select("set_id", "row.*")
    texts = rows.join(wanted, KEY).select("set_id", "text")
    sets = settle(texts.mapInArrow(_shingler(width), "set_id binary, shingles binary"))
    full = near.join(nodes.drop("row"), "set_id").join(sets, "set_id")
    return _in_tiles(full).mapInArrow(_confirm(percent), "u binary, v binary")


def near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 3, percent: int = 85
) -> DataFrame:
    """Component of every document under links of resemblance ``percent`` / 100 or more.

    Returns doc_id, n_shingles, component_id (smallest id reachable) and kept. Words are split at ASCII
    white space with A-Z in lower case; a text of fewer words than ``width`` is one shingle. A null text or
    one without words has an empty set and stands alone. Rows of null id get the smallest known id of their
    group, or null and kept if there is none. Repeated rows get equal results, an empty table an empty one.
    """
    return groups(keyed(docs, doc_id, text), width, percent).drop(*KEY, "chosen")


def groups(rows: DataFrame, width: int = 3, percent: int = 85) -> DataFrame:
    """The columns of ``near_duplicates``, the key and ``chosen``, for rows made by ``keyed``.

    One row of a group is chosen, with the rows that repeat its id and text: the smallest known id, then hash.
    """
    made = "doc_id long, key_id long, key_hash long, n long, set_id binary, heads array<int>, tail binary"
    sketches = settle(
        rows.withColumn("doc_id", F.col("doc_id").cast("bigint"))
        .select("doc_id", *KEY, "text")
        .mapInArrow(_sketcher(width, percent), made)
    )
    roots = components(settle(links_between(rows, sketches, width, percent)))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key_hash")
    firsts = sketches.where(F.col("set_id").isNotNull()).groupBy("set_id").agg(F.min(place).alias("first"))
    placed = firsts.join(roots, F.col("set_id") == F.col("node"), "left")
    placed = settle(placed.select("set_id", "first", F.coalesce("root", "set_id").alias("root")))
    least = placed.groupBy("root").agg(F.min("first").alias("least"))
    of_set = placed.join(least, "root").select("set_id", "least")
    found = sketches.join(of_set, "set_id", "left").withColumn("n_shingles", F.col("n"))
    found = found.withColumn("component_id", F.coalesce("least.doc_id", "doc_id"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    chosen = kept & F.coalesce(F.col("key_hash") == F.col("least.key_hash"), F.lit(True))
    return found.select(*KEY, "doc_id", "n_shingles", "component_id", kept.alias("kept"), chosen.alias("chosen"))
