"""Predicates and CASE ladders."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def case_bucket(branches: Sequence[tuple[Column, Any]], default: Any = None) -> Column:
    """Ordered CASE: the first true branch wins, a NULL condition counts as false."""
    ladder = F
    for condition, value in branches:
        ladder = ladder.when(condition, value)
    return ladder.otherwise(default)


def at_least(c: ColumnLike, steps: Sequence[tuple[float, Any]], default: Any) -> Column:
    """Ladder of ``value >= bound`` tests, highest bound first."""
    value = as_column(c)
    return case_bucket([(value >= bound, label) for bound, label in steps], default)


def below(c: ColumnLike, steps: Sequence[tuple[float, Any]], default: Any) -> Column:
    """Ladder of ``value < bound`` tests, lowest bound first."""
    value = as_column(c)
    return case_bucket([(value < bound, label) for bound, label in steps], default)


def map_synonyms(c: ColumnLike, groups: Mapping[str, Iterable[str]], default: str | None) -> Column:
    """Map spelling variants (compared upper-case, trimmed) to one standard value."""
    value = F.upper(F.trim(as_column(c)))
    return case_bucket(
        [(value.isin([v.upper() for v in variants]), F.lit(standard)) for standard, variants in groups.items()],
        F.lit(default),
    )


def in_list(c: ColumnLike, values: Iterable[Any]) -> Column:
    return as_column(c).isin(list(values))


def between_inclusive(c: ColumnLike, low: Any, high: Any) -> Column:
    return as_column(c).between(low, high)


def not_blank(c: ColumnLike) -> Column:
    """True for text with a visible character; NULL (so filtered out) for NULL."""
    return F.trim(as_column(c)) != ""


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def code_pattern(c: ColumnLike, prefixes: Iterable[str], digits: int) -> Column:
    """A known prefix followed by exactly ``digits`` digits."""
    return as_column(c).rlike(rf"\A(?:{'|'.join(prefixes)})[0-9]{{{digits}}}\z")
