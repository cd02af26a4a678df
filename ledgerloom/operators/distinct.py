"""Distinct counts from mergeable states: a sketch per group and column, rolled up to coarser groups without rereading rows.

A state is a HyperLogLog sketch of ``2 ** precision`` registers. Uniting states gives the state of the united rows, so days add up to months
and a late day is one more state. Values travel into their group's sketch map-side; no value is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import percent
from .aggregates import distinct_counts
from .keys import null_safe_join

PRECISION = 12
ROWS = "row_count"


def stated_error(precision: int = PRECISION, deviations: float = 3.0) -> float:
    """Relative error that an estimate of united states stays within, at so many standard deviations."""
    return deviations * 1.04 / math.sqrt(2**precision)


def _sketch(column: str, precision: int) -> Column:
    """The state of one column. It takes 64-bit hashes: a sketch would skip empty texts and knows few types. NULLs don't count."""
    return F.hll_sketch_agg(F.when(F.col(column).isNotNull(), F.xxhash64(column)), F.lit(precision))


def distinct_states(df: DataFrame, groups: Sequence[str], columns: Mapping[str, str], precision: int = PRECISION) -> DataFrame:
    """``groups``, ``row_count`` and, per entry (name, column) of ``columns``, the state ``name`` and ``name_present``, its rows with a value.

    One pass that combines map-side. Store it partitioned by its day; a reloaded day replaces its own states only
    (``writers.replace_period``). Without rows there are no states, but for one empty state where ``groups`` is empty.
    """
    states = {name: _sketch(column, precision) for name, column in columns.items()}
    present = {f"{name}_present": F.count(column) for name, column in columns.items()}
    return df.groupBy(*groups).agg(
        F.count("*").alias(ROWS), *[value.alias(name) for name, value in (states | present).items()]
    )


def roll_up(states: DataFrame, groups: Sequence[str], names: Sequence[str]) -> DataFrame:
    """States of coarser ``groups`` from finer ones: the rows are not read again."""
    return states.groupBy(*groups).agg(
        F.sum(ROWS).alias(ROWS),
        *[F.hll_union_agg(name).alias(name) for name in names],
        *[F.sum(f"{name}_present").alias(f"{name}_present") for name in names],
    )


def with_estimates(states: DataFrame, names: Sequence[str], keep_present: bool = False) -> DataFrame:
    """Each state replaced by its estimated distinct count; never more than the rows with a value."""
    estimates = {name: F.least(F.hll_sketch_estimate(name), F.col(f"{name}_present")) for name in names}
    estimated = states.withColumns(estimates)
    return estimated if keep_present else estimated.drop(*[f"{name}_present" for name in names])


def error_report(
    df: DataFrame, states: DataFrame, group: str, columns: Mapping[str, str], precision: int = PRECISION
) -> DataFrame:
    """Audit of rolled-up ``states`` against exact counts of their rows ``df``: per group and name ``exact_count``, ``estimate``,
    ``relative_error``, ``stated_error`` and ``within_error``. This one reads the rows; the roll-up doesn't."""
    exact = distinct_counts(df, group, {f"{name}_exact": column for name, column in columns.items()})
    both = null_safe_join(with_estimates(states, list(columns)), exact, [group])
    limit = stated_error(precision)
    rows = []
    for name in columns:
        counted, guessed = F.col(f"{name}_exact"), F.col(name)
        off = F.coalesce(F.try_divide(F.abs(guessed - counted), counted), F.lit(0.0))
        rows.append(
            F.struct(
                F.lit(name).alias("measure"),
                counted.alias("exact_count"),
                guessed.alias("estimate"),
                off.alias("relative_error"),
                F.lit(limit).alias("stated_error"),
                # One value more or less is rounding, whatever its share.
                ((off <= limit) | (F.abs(guessed - counted) <= 1)).alias("within_error"),
            )
        )
    return both.select(group, F.inline(F.array(*rows)))


def sketched_profile(df: DataFrame, columns: Sequence[str] | None = None, precision: int = PRECISION) -> DataFrame:
    """``column_profile`` with estimated distinct counts: one pass, and one sketch per column is all that is shuffled.

    Per column ``column_name``, ``row_count``, ``missing_values``, ``percent_missing``, ``unique_values`` (estimate) and
    ``duplicate_rows`` (estimate: rows less distinct rows). Rows and missing values are exact; the estimates stay within
    ``stated_error`` of the distinct counts. An empty frame gives zeros.
    """
    columns = list(columns or df.columns)
    # A hash of hashes: NULL has one too, so that it holds its place in the row.
    keyed = df.select(*columns, F.xxhash64(*[F.xxhash64(c) for c in columns]).alias("_row"))
    names = {f"_state_{i}": c for i, c in enumerate([*columns, "_row"])}
    one = with_estimates(distinct_states(keyed, [], names, precision), list(names), keep_present=True)
    distinct_rows = F.col(f"_state_{len(columns)}")
    rows = []
    for i, c in enumerate(columns):
        missing = F.col(ROWS) - F.col(f"_state_{i}_present")
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(ROWS),
                missing.alias("missing_values"),
                percent(missing, F.col(ROWS)).alias("percent_missing"),
                F.col(f"_state_{i}").alias("unique_values"),
                (F.col(ROWS) - distinct_rows).alias("duplicate_rows"),
            )
        )
    return one.select(F.inline(F.array(*rows)))
