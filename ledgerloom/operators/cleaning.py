"""Cleaning steps on whole frames."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import digest
from .keys import first_per_key


def remove_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key in an explicit order.

    Keys are compared by digests, so that long texts are not sorted and shuffled as keys.
    """
    digests = {f"_digest_{i}": digest(c) for i, c in enumerate(keys)}
    return first_per_key(df.withColumns(digests), list(digests), order).drop(*digests)


def blank_to_null(df: DataFrame) -> DataFrame:
    text = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in text})


def handle_missing(
    df: DataFrame, strategy: str = "drop", fill_value: Any = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Empty text counts as missing. ``drop`` rows, ``fill`` a value, or leave them."""
    marked = blank_to_null(df)
    if strategy == "drop":
        return marked.dropna(subset=list(columns) if columns else None)
    if strategy == "fill":
        return marked.fillna(fill_value, subset=list(columns) if columns else None)
    return marked


def keep_expected_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """The expected columns that exist, in the frame's own order."""
    return df.select(*[c for c in df.columns if c in set(expected)])


def add_constant_column(df: DataFrame, name: str, value: Any, data_type: str) -> DataFrame:
    """Add a column with a default, or fill the gaps of an existing one."""
    default = F.lit(value).cast(data_type)
    return df.withColumn(name, F.coalesce(F.col(name), default) if name in df.columns else default)


def append_sources(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of several sources under one set of columns; missing ones become NULL."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
