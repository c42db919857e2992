"""Ordering over whole tables without a single sorting task.

* ``select_cut`` finds the row at a given rank by counting ever finer parts of the key.
* ``range_sorted`` spreads rows over balanced key ranges; ``with_position`` and ``running_totals``
  add the offsets of the ranges to what each range computes alone.
* ``nth_missing`` maps "the r-th number a group does not hold" to that number, a large group in bounded blocks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from depotlens.functions.columns import ColumnOrName, as_column
from depotlens.session import settle

COPIES_PER_TASK = 100_000
#: Rows whose keys one task may order.
DIRECT_ROWS = 1_000_000


@dataclass(frozen=True)
class Cut:
    """Rows below ``key`` come before the cut, and ``copies`` of the ``group`` rows equal to it."""

    columns: tuple[Column, ...]
    key: tuple[Column, ...]
    copies: int
    group: int

    def before(self) -> Column:
        test = F.lit(False)
        for column, value in zip(reversed(self.columns), reversed(self.key)):
            test = (column <= value) & ((column < value) | test)
        return test

    def at(self) -> Column:
        test = F.lit(True)
        for column, value in zip(self.columns, self.key):
            test = test & (column == value)
        return test


def _first_beyond(counts: DataFrame, names: Sequence[str], rank: int) -> Row:
    """The row of a table of counts (names, rows) at which their running sum passes ``rank``; names come as text."""
    # The table of counts per value is ordered, never the rows themselves.
    upto = F.sum("rows").over(Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, 0))
    found = (
        counts.withColumn("upto", upto)
        .filter((F.col("upto") > rank) & (F.col("upto") - F.col("rows") <= rank))
        .select(*[F.col(n).cast("string") for n in names], "rows", "upto")
        .first()
    )
    if found is None:
        raise ValueError(f"rank {rank} is beyond the table")
    return found


def select_cut(df: DataFrame, rank: int, chains: Sequence[Sequence[Column]], total: int | None = None) -> Cut:
    """Key of the row with ``rank`` rows before it.

    Each chain is one part of the sort key, given from its coarsest to its finest rounding. A counting job runs per
    level, over the rows of the value chosen before, and brings one row to the driver. As soon as at most
    DIRECT_ROWS rows are left (``total`` says so of the table), one job over their whole keys finishes, and the search
    also ends where a boundary between values has the wanted rank.
    """
    scope, remaining, group = df, rank, total
    columns: list[Column] = []
    key: list[Column] = []
    for place, chain in enumerate(chains):
        columns.append(chain[-1])
        key.append(F.lit(None))
        for level in chain:
            if group is not None and group <= DIRECT_ROWS:
                return _cut_directly(scope, remaining, columns[:-1], key[:-1], [c[-1] for c in chains[place:]])
            counts = scope.groupBy(level.alias("value")).agg(F.count(F.lit(1)).alias("rows"))
            kind = dict(counts.dtypes)["value"]
            found = _first_beyond(counts, ["value"], remaining)
            remaining -= found["upto"] - found["rows"]
            group = found["rows"]
            key[-1] = F.lit(found["value"]).cast(kind)
            if remaining == 0:
                return Cut(tuple(columns), tuple(key), 0, group)
            scope = scope.filter(level == key[-1])
    return Cut(tuple(columns), tuple(key), remaining, group)


def _cut_directly(scope: DataFrame, rank: int, columns: list[Column], key: list[Column], rest: list[Column]) -> Cut:
    """The cut in a few rows, whose keys agree on ``columns``, by ordering the rest of their keys."""
    names = [f"k{i}" for i in range(len(rest))]
    counts = scope.groupBy(*[c.alias(n) for c, n in zip(rest, names)]).agg(F.count(F.lit(1)).alias("rows"))
    kinds = dict(counts.dtypes)
    found = _first_beyond(counts, names, rank)
    values = [F.lit(found[n]).cast(kinds[n]) for n in names]
    return Cut((*columns, *rest), (*key, *values), rank - (found["upto"] - found["rows"]), found["rows"])


def _copies(row: DataFrame, count: int) -> DataFrame:
    """``count`` copies of the single row of ``row``, made by many tasks."""
    if count == 0:
        return row.limit(0)
    tasks = -(-count // COPIES_PER_TASK)
    sizes = F.when(F.col("_task") == tasks - 1, count - (tasks - 1) * COPIES_PER_TASK).otherwise(
        COPIES_PER_TASK
    )
    spread = row.withColumn("_task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    if tasks > 1:
        spread = spread.repartition(tasks, "_task")
    return (
        spread.withColumn("_copy", F.explode(F.sequence(F.lit(1), sizes))).drop("_task", "_copy")
    )


def split_at(df: DataFrame, cut: Cut) -> tuple[DataFrame, DataFrame]:
    """Rows before and from the cut. Rows equal to the cut key are copies of one row."""
    if cut.copies == 0:
        return df.filter(cut.before()), df.filter(~cut.before())
    twin = df.filter(cut.at()).limit(1)
    first = df.filter(cut.before()).unionByName(_copies(twin, cut.copies))
    rest = df.filter(~cut.before() & ~cut.at()).unionByName(_copies(twin, cut.group - cut.copies))
    return first, rest


# --- balanced ranges ---------------------------------------------------------------------


def range_sorted(df: DataFrame, *order: Column) -> DataFrame:
    """Spread rows over ranges of the sort key; ``_range`` numbers the ranges in key order.

    The result is written out: range bounds come from a sample, and every later reading must see the
    same ranges, also after an executor is lost.
    """
    return settle(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by their keys over as many tasks as the session sets for shuffles, for steps that hold a table of their rows.

    Adaptive execution merges shuffle partitions up to a size in bytes. Narrow rows take a few bytes in a shuffle and
    hundreds in a hash table, so merged partitions would fill a task's memory; a number that is given is kept.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _range_offsets(ranged: DataFrame, **totals: Column) -> dict[str, Column]:
    """Totals of all earlier ranges for the range of a row; one row per range comes to the driver."""
    per_range = ranged.groupBy("_range").agg(*[value.alias(name) for name, value in totals.items()])
    rows = {row["_range"]: row for row in per_range.collect()}
    offsets = {}
    for name in totals:
        before, running = [], 0
        for number in range(max(rows, default=0) + 1):
            before.append(running)
            running += rows[number][name] if number in rows else 0
        offsets[name] = F.element_at(F.lit(before), F.col("_range") + 1)
    return offsets


def with_position(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """Add the 0-based place of each row in the order; the order must be total."""
    ranged = range_sorted(df, *order)
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    before = _range_offsets(ranged, rows=F.count(F.lit(1)))["rows"]
    return ranged.withColumn(name, (before + inside - 1).cast("bigint")).drop("_range")


def running_totals(df: DataFrame, order: Sequence[Column], *values: str) -> DataFrame:
    """Add ``running_<value>``: the sum of the value over all rows up to and including this one."""
    ranged = range_sorted(df, *order)
    upto = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = _range_offsets(ranged, **{name: F.sum(name) for name in values})
    return ranged.withColumns(
        {f"running_{name}": before[name] + F.sum(name).over(upto) for name in values}
    ).drop("_range")


def dense_codes(df: DataFrame, column: str, code: str | None = None) -> DataFrame:
    """Distinct values of a column with their 0-based place in value order; NULL text counts as ''."""
    distinct = df.select(_filled(df, column).alias(column)).distinct()
    return with_position(distinct, F.col(column), name=code or f"{column}_code")


def _filled(df: DataFrame, column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) if dict(df.dtypes)[column] == "string" else F.col(column)


def factorize(df: DataFrame, column: str, code: str | None = None) -> DataFrame:
    """Add the dense code of a column's value."""
    codes = dense_codes(df, column, code)
    return df.withColumn(column, _filled(df, column)).join(codes, column, "left")


def factorize_many(df: DataFrame, codes: Mapping[str, str]) -> DataFrame:
    """Add dense codes of several text columns (column -> code name), ordered in one go."""
    if not codes:
        return df
    filled = df.withColumns({c: _filled(df, c) for c in codes})
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in codes]
    values = filled.select(F.explode(F.array(*entries)).alias("e")).select("e.column", "e.value").distinct()
    placed = settle(with_position(values, F.col("column"), F.col("value")))
    starts = placed.groupBy("column").agg(F.min("position").alias("start"), F.count(F.lit(1)).alias("values"))
    found = {row["column"]: row for row in starts.collect()}
    first = {column: row["start"] for column, row in found.items()}
    for column, code in codes.items():
        if column in found and found[column]["values"] == 1:
            # The plan may know a single value as a constant, and a join by a constant meets all rows with all.
            filled = filled.withColumn(code, F.when(F.col(column).isNotNull(), F.lit(0).cast("bigint")))
            continue
        one = placed.filter(F.col("column") == column).select(
            F.col("value").alias(column), (F.col("position") - first.get(column, 0)).alias(code)
        )
        filled = filled.join(one, column, "left")
    return filled


# --- groups ------------------------------------------------------------------------------


def topk_per_group(
    df: DataFrame, group: str | Sequence[str], k: int, *order: Column, rank: str | None = None
) -> DataFrame:
    """First k rows of each group. Spark keeps k rows per group in every task before it shuffles."""
    keys = [group] if isinstance(group, str) else list(group)
    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    out = out.filter(F.col(name) <= k)
    return out.withColumn(name, F.col(name).cast("bigint")) if rank else out.drop(name)


def topk_global(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


def last_per_group(df: DataFrame, group: str, value: str, *order: ColumnOrName, name: str) -> DataFrame:
    """Value of the row that comes last in each group."""
    key = F.struct(*[as_column(c) for c in order])
    return df.groupBy(group).agg(F.max_by(value, key).alias(name))


def distinct_first(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row per key, the first in the given order (by map-side minimum, not by sorting)."""
    rest = [c for c in df.columns if c not in keys]
    lead = [F.struct(*order).alias("_lead")] if order else []
    packed = F.min(F.struct(*lead, *rest)).alias("_row")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(
        *df.columns
    )


def nth_missing(
    taken: DataFrame,
    wanted: DataFrame,
    group: str,
    taken_position: str,
    wanted_rank: str,
    position: str = "position",
    block: int = 4096,
    sizes: DataFrame | None = None,
    most: int = DIRECT_ROWS,
) -> DataFrame:
    """Resolve each wanted rank to the position with that many free positions before it.

    ``taken`` holds distinct (group, position) pairs. A group of at most ``most`` rows on both sides is ordered by one
    task; a larger one is handled in blocks of ``block`` positions, so that it is spread over many tasks. ``sizes``
    (group, rows) gives the rows of each group, or more, where they are known; otherwise they are counted.
    """
    taken = taken.where(F.col(group).isNotNull() & F.col(taken_position).isNotNull())
    wanted = wanted.where(F.col(group).isNotNull() & F.col(wanted_rank).isNotNull())
    if sizes is None:
        sizes = taken.select(group).unionByName(wanted.select(group)).groupBy(group).agg(F.count(F.lit(1)).alias("rows"))
    # There are few such groups: each has more than ``most`` rows.
    large = settle(sizes.where(F.col("rows") > most).select(group))
    names = (group, taken_position, wanted_rank, position)
    if large.isEmpty():
        return _missing_of_groups(taken, wanted, *names)
    small = [side.join(F.broadcast(large), group, "left_anti") for side in (taken, wanted)]
    apart = [side.join(F.broadcast(large), group, "left_semi") for side in (taken, wanted)]
    return _missing_of_groups(*small, *names).unionByName(_missing_in_blocks(*apart, *names, block))


def _missing_of_groups(
    taken: DataFrame, wanted: DataFrame, group: str, taken_position: str, wanted_rank: str, position: str
) -> DataFrame:
    """``nth_missing`` with each group in one task: both sides travel once and are ordered twice."""
    extra = [(c, kind) for c, kind in wanted.dtypes if c != group]
    pairs = taken.select(
        group, F.col(taken_position).cast("bigint").alias("_pos"), F.lit(0).alias("_ask"), *[F.lit(None).cast(t).alias(c) for c, t in extra]
    )
    asks = wanted.select(
        group, F.lit(None).cast("bigint").alias("_pos"), F.lit(1).alias("_ask"), *[c for c, _ in extra]
    )
    of_group = Window.partitionBy(group)
    upto = of_group.orderBy("_at", "_ask").rowsBetween(Window.unboundedPreceding, 0)
    # _at = free positions before a taken one: a free rank r lies after every taken position for which it is at most r.
    place = F.row_number().over(of_group.orderBy("_ask", "_pos"))
    at = F.when(F.col("_ask") == 0, F.col("_pos") - place + 1).otherwise(F.col(wanted_rank).cast("bigint"))
    return (
        spread(pairs.unionByName(asks), group)
        .withColumn("_at", at)
        .withColumn("_before", F.sum(F.lit(1) - F.col("_ask")).over(upto))
        .filter(F.col("_ask") == 1)
        .withColumn(position, F.col("_at") + F.col("_before"))
        .select(*wanted.columns, position)
    )


def _missing_in_blocks(
    taken: DataFrame, wanted: DataFrame, group: str, taken_position: str, wanted_rank: str, position: str, block: int
) -> DataFrame:
    """``nth_missing`` with every ``block`` positions of a group apart."""
    # gap = number of free positions before a taken one.
    by_block = Window.partitionBy(group, "_block").orderBy("_pos")
    blocks_before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    pairs = taken.select(
        group,
        F.col(taken_position).cast("bigint").alias("_pos"),
        F.floor(F.col(taken_position) / block).cast("bigint").alias("_block"),
    )
    filled = (
        pairs.groupBy(group, "_block")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(blocks_before), F.lit(0)))
        .drop("_rows")
    )
    gaps = (
        pairs.withColumn("_inside", F.row_number().over(by_block) - 1)
        .join(filled, [group, "_block"])
        .select(group, (F.col("_pos") - F.col("_before") - F.col("_inside")).alias("_at"))
        .groupBy(group, "_at")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_block", F.floor(F.col("_at") / block).cast("bigint"))
    )
    # A free rank r lies after every taken position whose gap is at most r.
    asks = wanted.withColumn("_at", F.col(wanted_rank).cast("bigint")).withColumn(
        "_block", F.floor(F.col("_at") / block).cast("bigint")
    )
    totals = (
        gaps.select(group, "_block", "_rows")
        .unionByName(asks.select(group, "_block").distinct().withColumn("_rows", F.lit(0).cast("bigint")))
        .groupBy(group, "_block")
        .agg(F.sum("_rows").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(blocks_before), F.lit(0)))
        .drop("_rows")
    )
    extra = [c for c in wanted.columns if c != group]
    marks = gaps.select(
        group, "_block", "_at", "_rows", F.lit(0).alias("_ask"), *[F.lit(None).cast(t).alias(c) for c, t in wanted.dtypes if c != group]
    ).unionByName(
        asks.select(group, "_block", "_at", F.lit(0).cast("bigint").alias("_rows"), F.lit(1).alias("_ask"), *extra)
    )
    upto = (
        Window.partitionBy(group, "_block").orderBy("_at", "_ask").rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        marks.withColumn("_inside", F.sum("_rows").over(upto))
        .filter(F.col("_ask") == 1)
        .join(totals, [group, "_block"])
        .withColumn(position, F.col("_at") + F.col("_before") + F.col("_inside"))
        .select(*wanted.columns, position)
    )
