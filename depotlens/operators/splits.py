"""Train and validation splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotlens.functions.columns import hash_hex, resolve_column
from depotlens.operators.ordering import select_cut, split_at
from depotlens.session import settle

VALIDATION_FRACTION = 0.2


def _hash_chain(seed: object, columns: list[str]) -> list[Column]:
    tie = hash_hex(seed, *columns)
    # Each level cuts one range into 65,536, so no table of counts grows with the rows; the last one splits ties.
    return [*(F.substring(tie, 1, n) for n in (4, 8, 12, 16)), tie]


def _time_chains(df: DataFrame, time_column: str, tie_columns: list[str] | None) -> list[list[Column]]:
    """Hour, second, moment, then a row hash: every table of counts on the way stays small."""
    stamp = F.col(time_column)
    moments = [stamp]
    kind = dict(df.dtypes)[time_column]
    if kind != "date":
        moments = [F.date_trunc(unit, stamp).cast(kind) for unit in ("hour", "second")] + [stamp]
    return [moments, _hash_chain("split", tie_columns or df.columns)]


def _timed(df: DataFrame, time_column: str) -> DataFrame:
    if dict(df.dtypes)[time_column] == "string":
        df = df.withColumn(time_column, F.try_to_timestamp(F.col(time_column)))
    return df.filter(F.col(time_column).isNotNull())


def temporal_split(
    interactions: DataFrame,
    fraction: float = VALIDATION_FRACTION,
    time_column: str | None = None,
    tie_columns: list[str] | None = None,
    smallest: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Earliest rows for training, the last ``fraction`` for validation.

    Rows without a time are dropped; a table of fewer than ``smallest`` rows all goes to training. Rows of
    the same moment are ordered by a hash of ``tie_columns`` (all columns by default).
    """
    column = time_column or resolve_column(interactions, "interaction_timestamp", "timestamp")
    rows = _timed(interactions, column)
    total = rows.count()
    if total < smallest:
        return rows, rows.limit(0)
    rank = max(1, int(total * (1 - float(fraction))))
    if rank >= total:
        return rows, rows.limit(0)
    return split_at(rows, select_cut(rows, rank, _time_chains(rows, column, tie_columns), total))


def demand_split(
    orders: DataFrame,
    fraction: float = VALIDATION_FRACTION,
    time_column: str = "order_date",
    tie_columns: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Like ``temporal_split`` for a demand series: at least one row stays on each side."""
    rows = _timed(orders, time_column)
    total = rows.count()
    rank = max(1, int(total * (1 - float(fraction))))
    if rank >= total:
        rank = total - 1
    if rank < 1:
        return rows.limit(0), rows
    return split_at(rows, select_cut(rows, rank, _time_chains(rows, time_column, tie_columns), total))


def stratified_split(
    df: DataFrame,
    label: str,
    fraction: float = 0.2,
    seed: int = 42,
    id_columns: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Training and holdout rows with the same share of every class of ``label``; null is a class of its own.

    Each class gives its rows of the smallest hashes, exactly as many as its share rounds to (half to even). Classes
    are rows of a table of cuts, so there may be any number of them, and nothing comes to the driver: hashes
    are counted by their first 16 bits, and only the one range in which a class is cut is ordered.
    """
    hashed = df.withColumns({"_tie": hash_hex(seed, *(id_columns or df.columns)), "_class": F.col(label)})
    hashed = hashed.withColumn("_range", F.substring("_tie", 1, 4))
    counts = hashed.groupBy("_class", "_range").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("_class")
    upto = F.sum("n").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0))
    wanted = F.bround(F.sum("n").over(whole) * F.lit(float(fraction))).cast("bigint")
    cuts = (
        counts.select("_class", "_range", "n", upto.alias("upto"), wanted.alias("wanted"))
        .where("upto - n < wanted and upto >= wanted")
        .select(F.col("_class").alias("cut_class"), F.col("_range").alias("cut_range"), (F.col("wanted") - F.col("upto") + F.col("n")).alias("left"))
    )
    # Written, the cuts are made once for both parts, and few of them meet the rows without a shuffle by class.
    cuts = settle(cuts)
    # A class whose share rounds to nothing has no cut, and all of its rows stay.
    placed = hashed.join(cuts, F.col("_class").eqNullSafe(F.col("cut_class")), "left")
    # Rows of equal hashes and columns are copies: which of them goes where makes no difference.
    order = Window.partitionBy("_class").orderBy("_tie", hash_hex(seed, *df.columns))
    inside = placed.where("_range = cut_range").withColumn("_place", F.row_number().over(order))
    names = [F.col(f"`{c}`") for c in df.columns]
    held = placed.where("_range < cut_range").select(*names).unionByName(inside.where("_place <= left").select(*names))
    apart = placed.where("cut_range is null or _range > cut_range").select(*names)
    return apart.unionByName(inside.where("_place > left").select(*names)), held
