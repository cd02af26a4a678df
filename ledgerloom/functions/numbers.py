"""Numeric expressions and exact aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .conditions import ColumnLike, as_column
from .text import strip

# Sums run over decimals: the result is exact and does not depend on how Spark
# partitions the rows, which sums of doubles would. Money keeps 4 digits, shares and
# probabilities 10.
MONEY_DIGITS = 4
SHARE_DIGITS = 10


def exact(c: ColumnLike, digits: int = MONEY_DIGITS) -> Column:
    return as_column(c).cast(f"decimal(18,{digits})")


def safe_double(c: ColumnLike, default: float = 0.0) -> Column:
    return F.coalesce(strip(as_column(c).cast("string")).try_cast("double"), F.lit(default))


def safe_int(c: ColumnLike, default: int = 0) -> Column:
    """Truncates towards zero; ``default`` for text that is no number."""
    return F.coalesce(strip(as_column(c).cast("string")).try_cast("double").try_cast("int"), F.lit(default))


def clean_numeric(c: ColumnLike, keep_sign: bool = True) -> Column:
    """Drop everything that is no part of a number, then parse; NULL when that fails.

    ``keep_sign=False`` also drops the minus sign.
    """
    unwanted = "[^0-9.-]" if keep_sign else "[^0-9.]"
    return F.regexp_replace(as_column(c).cast("string"), unwanted, "").try_cast("double")


def cap(c: ColumnLike, highest: float) -> Column:
    """Upper bound that keeps NULL as NULL (``least`` alone would return the bound)."""
    value = as_column(c)
    return F.when(value > highest, F.lit(highest)).otherwise(value)


def round_to(c: ColumnLike, digits: int = 2) -> Column:
    """Round half up on the decimal value, so that 1.005 gives 1.01 whatever its binary form."""
    return F.round(as_column(c).cast("decimal(28,8)"), digits).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL for a zero divisor."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column, digits: int | None = 2) -> Column:
    value = ratio(part, whole) * 100
    return value if digits is None else round_to(value, digits)


def exact_sum(c: ColumnLike, digits: int = MONEY_DIGITS) -> Column:
    return F.sum(exact(c, digits)).cast("double")


def exact_avg(c: ColumnLike, digits: int = MONEY_DIGITS) -> Column:
    value = exact(c, digits)
    return ratio(F.sum(value), F.count(value))


def sum_where(condition: Column, c: ColumnLike) -> Column:
    """Sum over the rows that satisfy the condition, 0 when none does."""
    return F.coalesce(exact_sum(F.when(condition, as_column(c))), F.lit(0.0))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def zscore(c: ColumnLike, mean: float, deviation: float) -> Column:
    return (as_column(c).cast("double") - mean) / deviation
