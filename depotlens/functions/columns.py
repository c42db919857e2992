"""Column helpers: labels, guarded ratios, order-independent sums, date arithmetic."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- strings -----------------------------------------------------------------------------


def clean_upper(value: ColumnOrName) -> Column:
    return F.trim(F.upper(as_column(value)))


def clean_lower(value: ColumnOrName) -> Column:
    return F.lower(F.trim(as_column(value)))


def trim_cast(value: ColumnOrName) -> Column:
    return F.trim(as_column(value).cast("string"))


# --- labels and flags --------------------------------------------------------------------


def flag(condition: Column) -> Column:
    """True only when the condition is true; an unknown condition gives False."""
    return F.coalesce(condition, F.lit(False))


def as_int_flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def tier(
    value: ColumnOrName,
    steps: Sequence[tuple[object, object]],
    otherwise: object,
    strict: bool = False,
) -> Column:
    """Label by descending lower bounds; ``strict`` compares with > instead of >=."""
    subject = as_column(value)
    ladder = F
    for bound, label in steps:
        test = subject > F.lit(bound) if strict else subject >= F.lit(bound)
        ladder = ladder.when(test, F.lit(label))
    return ladder.otherwise(F.lit(otherwise))


def performance_tier(value: ColumnOrName, high: float, medium: float) -> Column:
    return tier(value, [(high, "High"), (medium, "Medium")], "Low")


def first_true(cases: Sequence[tuple[Column, object]], otherwise: object) -> Column:
    ladder = F
    for condition, label in cases:
        ladder = ladder.when(condition, F.lit(label))
    return ladder.otherwise(F.lit(otherwise))


# --- numbers -----------------------------------------------------------------------------


def guarded_ratio(
    numerator: ColumnOrName,
    denominator: ColumnOrName,
    scale: int | None = 2,
    factor: int = 1,
) -> Column:
    """numerator / denominator * factor where the denominator is positive, else 0."""
    bottom = as_column(denominator)
    value = F.try_divide(as_column(numerator).cast("double"), bottom.cast("double"))
    if factor != 1:
        value = value * F.lit(factor)
    if scale is not None:
        value = F.round(value, scale)
    return F.when(bottom > 0, value).otherwise(F.lit(0.0))


def discount_impact(gross: ColumnOrName, net: ColumnOrName) -> Column:
    return guarded_ratio(as_column(gross) - as_column(net), gross, 2, 100)


def sum_exact(value: ColumnOrName, scale: int = 2) -> Column:
    """Sum of doubles that hold ``scale`` decimals, free of the order rows arrive in."""
    return F.round(F.sum(as_column(value)), scale)


def avg_exact(value: ColumnOrName, scale: int = 2) -> Column:
    """Mean of doubles that hold ``scale`` decimals, free of the order rows arrive in."""
    subject = as_column(value)
    return F.try_divide(sum_exact(subject, scale), F.count(subject).cast("double"))


def sum_when(condition: Column, value: ColumnOrName) -> Column:
    subject = as_column(value)
    return F.sum(F.when(condition, subject).otherwise(F.lit(0).cast("bigint")))


def count_when(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def clip(value: ColumnOrName, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value; NULL stays NULL."""
    subject = as_column(value)
    out = subject
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    return F.when(subject.isNotNull(), out)


def to_number(value: ColumnOrName) -> Column:
    """Numeric reading of any column; what cannot be read becomes 0."""
    return F.coalesce(as_column(value).try_cast("double"), F.lit(0.0))


def normal_quantile(probability: float) -> float:
    return NormalDist().inv_cdf(probability)


# --- dates -------------------------------------------------------------------------------


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    return F.datediff(as_column(end), as_column(start)).cast("bigint")


def month_start(value: ColumnOrName) -> Column:
    return F.trunc(as_column(value), "month")


def week_start(value: ColumnOrName) -> Column:
    """Monday of the week."""
    return F.trunc(as_column(value), "week")


def coerce_date(value: ColumnOrName) -> Column:
    """Date reading of a column; what cannot be read becomes NULL."""
    return F.to_date(F.try_to_timestamp(as_column(value).cast("string")))


def as_date(value: str) -> Column:
    return F.lit(value).cast("date")


# --- hashing -----------------------------------------------------------------------------


def hash_hex(seed: object, *parts: ColumnOrName) -> Column:
    """Repeatable pseudo-random text key of a row."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[as_column(p).cast("string") for p in parts]))


def hash_number(seed: object, *parts: ColumnOrName) -> Column:
    """Repeatable pseudo-random whole number in [0, 2**32)."""
    return F.conv(F.substring(hash_hex(seed, *parts), 1, 8), 16, 10).cast("bigint")


# --- column lookup -----------------------------------------------------------------------


def resolve_column(df: DataFrame, *candidates: str) -> str:
    """First candidate that the frame has."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"none of {candidates} in {df.columns}")


def generate_date_partitions(spark, start: str, end: str, unit: str = "month") -> DataFrame:
    """One row per month start or per day from start to end."""
    first = F.trunc(as_date(start), "month") if unit == "month" else as_date(start)
    step = F.expr("interval 1 month" if unit == "month" else "interval 1 day")
    return spark.range(1).select(
        F.explode(F.sequence(first, as_date(end), step)).alias("partition_date")
    )
