"""Trie of conversations that share their first turns, by a skeleton of range-partition splitters.

A conversation becomes a path of 16-byte turn keys, so paths sort as byte strings and a node is a prefix. A
bounded sample of paths gives the splitters of sorted shards. A node whose conversations lie in more than one shard
is a prefix of a splitter; the trie of all splitters, the skeleton, is broadcast. Every sorted shard walks its
paths with one open node for each depth, finishes all nodes outside the skeleton by itself and sends one partial
aggregate for each skeleton node that it meets; these are reduced, and rolled up along the skeleton. The digest
of the conversations that end in a skeleton node streams segments of their ids in order.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.session import settle

#: Conversations of a family share the head of its first one; so many ids are a family, and heads have fewer turns than so many.
FAMILY, HEADS = 20, 4
#: Bytes of a turn key.
WIDTH = 16
#: Nodes of a shard at most, on average, and sampled paths for each shard.
SHARD_NODES, SAMPLED = 1 << 20, 32
#: Bytes of ids that travel as one row, and rows of a batch.
SEGMENT, BATCH = 1 << 16, 1 << 13
WORD = r"[^\x20\x09-\x0D]+"
LEAST_ID = -(1 << 63)
NODE, PARTIAL, ENDS = 0, 1, 2

FOUND = pa.schema(
    [
        ("kind", pa.int32()),
        ("skeleton", pa.int32()),
        ("conv_id", pa.int64()),
        ("depth", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("words", pa.int64()),
        ("ends_sha256", pa.string()),
        ("ids", pa.binary()),
    ]
)
FOUND_COLUMNS = (
    "kind int, skeleton int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, words long, ends_sha256 string, ids binary"
)
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, words) of every conversation: turn keys in one binary and the words of each turn's text.

    A conversation takes the first turns, fewer than HEADS by its id, from the first of its family in place of
    its own. A turn's text stays where it is: only its key and its words travel.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("key"),
        F.regexp_count(text, F.lit(WORD)).alias("words"),
    )
    family = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family")
    listed = (
        turns.select("*", family)
        .repartition("family")
        .groupBy("family", "conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "key", "words"))).alias("turns"))
    )
    heads = listed.where("conv_id = family").select("family", F.slice("turns", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    taken = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), h)).otherwise(F.slice("turns", 1, 0))
    whole = listed.join(heads, "family", "left").select(
        "conv_id", F.concat(taken, F.slice("turns", h + 1, F.size("turns"))).alias("turns")
    )
    return whole.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), "")).alias("path"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
    )


def shared(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common at their beginning."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // WIDTH
    low, high = 0, most // WIDTH  # a and b agree on ``low`` turns and not on ``high``
    while high - low > 1:
        middle = (low + high) // 2
        if a[low * WIDTH : middle * WIDTH] == b[low * WIDTH : middle * WIDTH]:
            low = middle
        else:
            high = middle
    return low


def splitters(sample: list[tuple[bytes, int]], shards: int) -> list[tuple[bytes, int]]:
    """Bounds of shards: a row belongs behind every bound that it does not precede.

    A bound keeps only the turns that tell it from the sampled path before it, so the skeleton stays small;
    between equal paths the id decides, so no path is too frequent for a shard.
    """
    ordered = sorted(sample)
    bounds = set()
    for number in range(1, shards):
        at = number * len(ordered) // shards
        if at == 0:
            continue
        (before, _), (path, conv_id) = ordered[at - 1 : at + 1]
        bounds.add((path, conv_id) if before == path else (path[: (shared(before, path) + 1) * WIDTH], LEAST_ID))
    return sorted(bounds)


class Skeleton:
    """Trie of the splitters' paths; node 0 is the root, and parents come before their children."""

    def __init__(self, bounds: list[tuple[bytes, int]]):
        self.bounds = bounds
        self.parent: list[int] = [-1]
        self.depth = [0]
        self.child: dict[tuple[int, bytes], int] = {}
        for path, _ in bounds:
            node = 0
            for at in range(0, len(path), WIDTH):
                step = (node, path[at : at + WIDTH])
                if step not in self.child:
                    self.child[step] = len(self.parent)
                    self.parent.append(node)
                    self.depth.append(at // WIDTH + 1)
                node = self.child[step]


class Open:
    """A node whose conversations are being read."""

    __slots__ = ("skeleton", "words", "n", "least", "children", "leaves", "saved", "ids", "first", "running", "waiting")

    def __init__(self, skeleton: int | None, words: int):
        self.skeleton, self.words = skeleton, words
        self.n, self.least, self.children, self.leaves, self.saved = 0, None, 0, 0, 0
        self.ids, self.first, self.running, self.waiting = bytearray(), None, None, []

    def join(self, n: int, least: int) -> None:
        self.n += n
        self.least = least if self.least is None else min(self.least, least)


class Walk:
    """One pass over the sorted paths of a shard; ``rows`` holds what is ready to go out."""

    def __init__(self, skeleton: Skeleton):
        self.skeleton, self.rows = skeleton, []
        self.open = [Open(0, 0)]
        self.path = b""

    def add(self, conv_id: int, path: bytes, words: list[int]) -> None:
        common = shared(self.path, path)
        while len(self.open) > common + 1:
            self.close()
        for depth in range(common, len(path) // WIDTH):
            above = self.open[-1].skeleton
            here = None if above is None else self.skeleton.child.get((above, path[depth * WIDTH : (depth + 1) * WIDTH]))
            self.open.append(Open(here, words[depth]))
        self.path = path
        top = self.open[-1]
        top.join(1, conv_id)
        if top.first is None:
            top.first = conv_id
        top.ids += b"%d," % conv_id
        if len(top.ids) >= SEGMENT:
            self.flush(top)

    def flush(self, node: Open) -> None:
        """Ids that end in a node go into its digest, or out as a segment if other shards may have more."""
        if node.skeleton is None:
            node.running = node.running or hashlib.sha256()
            node.running.update(node.ids)
        elif node.ids:
            self.rows.append((ENDS, node.skeleton, node.first, *[None] * 8, bytes(node.ids)))
        node.ids, node.first = bytearray(), None

    def close(self) -> None:
        node = self.open.pop()
        parent = self.open[-1] if self.open else None
        if parent is not None:
            parent.join(node.n, node.least)
        if node.skeleton is not None:
            self.flush(node)
            sums = (node.n, node.children, node.leaves, node.saved, node.words)
            self.rows.append((PARTIAL, node.skeleton, node.least, None, None, *sums, None, None))
            return
        if node.running is None:
            node.running = hashlib.sha256(node.ids[:-1])
        elif node.ids:
            node.running.update(node.ids[:-1])
        leaves = node.leaves if node.children else 1
        saved = node.saved + (node.n - 1) * node.words
        parent.children, parent.leaves, parent.saved = parent.children + 1, parent.leaves + leaves, parent.saved + saved
        self.rows += [(*row[:4], node.least, *row[5:]) for row in node.waiting]
        digest = node.running.hexdigest()
        row = (NODE, parent.skeleton, node.least, len(self.open), None, node.n, node.children, leaves, saved, None, digest, None)
        (self.rows if parent.skeleton is not None else parent.waiting).append(row)

    def ready(self, all_of_them: bool = False):
        """Batches of rows that are ready."""
        while len(self.rows) >= (1 if all_of_them else BATCH):
            part, self.rows = self.rows[:BATCH], self.rows[BATCH:]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), FOUND)], schema=FOUND)


def _walker(skeleton):
    def walk(batches):
        made = Walk(skeleton.value)
        seen = False
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "path", "words"))):
                made.add(*row)
                seen = True
            yield from made.ready()
        while seen and made.open:
            made.close()
        yield from made.ready(all_of_them=True)

    return walk


def _dealer(skeleton):
    def deal(batches):
        bounds = skeleton.value.bounds
        for batch in batches:
            rows = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())
            shard = pa.array([bisect_right(bounds, row) for row in rows], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shard], names=[*batch.schema.names, "shard"])

    return deal


def _digester():
    """(skeleton, ends_sha256) of segments sorted by node and first id; only a digest is held."""

    def made(node, running, last):
        running.update(last[:-1])  # every id is followed by a comma, but the last has none
        return pa.RecordBatch.from_pydict({"skeleton": pa.array([node], pa.int32()), "ends_sha256": [running.hexdigest()]})

    def digest(batches):
        node, running, last = None, None, b""
        for batch in batches:
            for here, ids in zip(batch.column("skeleton").to_pylist(), batch.column("ids")):
                if here != node:
                    if node is not None:
                        yield made(node, running, last)
                    node, running, last = here, hashlib.sha256(), b""
                running.update(last)
                last = ids.as_py()
        if node is not None:
            yield made(node, running, last)

    return digest


def _sample(paths: DataFrame, n: int, wanted: int) -> list[tuple[bytes, int]]:
    """About ``wanted`` of ``n`` paths, chosen by a hash of the id, so that equal runs agree."""
    range_ = 1 << 40
    rate = min(range_, wanted * range_ // max(n, 1) + 1)
    chosen = paths.where(F.xxhash64("conv_id").bitwiseAND(F.lit(range_ - 1)) < rate).select("path", "conv_id")
    return [(bytes(r.path), r.conv_id) for r in chosen.collect()]


def _rolled_up(skeleton: Skeleton, partials: list) -> list[tuple]:
    """Rows of the skeleton nodes that have conversations: children add to their parents, the deepest first."""
    sums = {r.skeleton: r for r in partials}
    children, leaves, saved = ({n: r[c] for n, r in sums.items()} for c in ("n_children", "n_leaves", "saved_tokens"))
    for node in sorted(sums, reverse=True):
        leaves[node] = leaves[node] if children[node] else 1
        saved[node] += (sums[node].n_convs - 1) * sums[node].words
        above = skeleton.parent[node]
        if above >= 0:
            children[above] += 1
            leaves[above] += leaves[node]
            saved[above] += saved[node]
    return [
        (
            node,
            r.conv_id,
            skeleton.depth[node],
            sums[skeleton.parent[node]].conv_id if node else None,
            r.n_convs,
            children[node],
            leaves[node],
            saved[node],
        )
        for node, r in sums.items()
    ]


def trie(spark: SparkSession, conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """Nodes of the trie of rebuilt conversations, one row each.

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256. Turns are ordered by ``turn``, null first; ties go by role, then by the MD5 of role and text, and
    repeated rows are turns of their own. Null roles and texts are empty, rows without a conv_id belong to no
    conversation and are left out, an empty table has no node, further columns are ignored.

    Bounds: a conversation's path (16 bytes and a number for each turn, never its texts) is one row. The driver
    holds SAMPLED paths for each shard and the skeleton: at most the turns of one path for each shard. A task holds
    the nodes of its shard that wait for their parent's smallest member. A path that a large part of all
    conversations share spreads over many shards by id; its digest, one running hash, reads their ids as
    segments of 64 KB in one task.
    """
    paths = settle(rebuilt(conversations))
    n, turns = paths.agg(F.count("*"), F.coalesce(F.sum(F.size("words")), F.lit(0))).first()
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(n + turns) // SHARD_NODES))
    skeleton = Skeleton(splitters(_sample(paths, n, SAMPLED * shards), shards))
    held = spark.sparkContext.broadcast(skeleton)
    dealt = paths.mapInArrow(_dealer(held), "conv_id long, path binary, words array<int>, shard int")
    sorted_shards = dealt.repartitionById(len(skeleton.bounds) + 1, F.col("shard")).sortWithinPartitions("path", "conv_id")
    found = settle(sorted_shards.mapInArrow(_walker(held), FOUND_COLUMNS))

    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    reduced = found.where(f"kind = {PARTIAL}").groupBy("skeleton").agg(F.min("conv_id").alias("conv_id"), *sums, F.max("words").alias("words"))
    top = spark.createDataFrame(
        _rolled_up(skeleton, reduced.collect()),
        "skeleton int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long",
    )
    segments = found.where(f"kind = {ENDS}").select("skeleton", F.col("conv_id").alias("first"), "ids")
    ended = (
        segments.repartition("skeleton")
        .sortWithinPartitions("skeleton", "first")
        .select("skeleton", "ids")
        .mapInArrow(_digester(), "skeleton int, ends_sha256 string")
    )
    nothing = F.lit(hashlib.sha256().hexdigest())
    upper = top.join(ended, "skeleton", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
    # The skeleton was broadcast before: a row for each of its nodes is smaller than that.
    above = F.broadcast(top.select("skeleton", F.col("conv_id").alias("above")))
    lower = found.where(f"kind = {NODE}").join(above, "skeleton", "left")
    lower = lower.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return upper.select(COLUMNS).union(lower.select(COLUMNS))
