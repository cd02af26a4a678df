"""Picking one row per key, numbering keys, resolving keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row per key.

    Spark turns ``row_number() = 1`` into a group limit that also runs before the shuffle,
    so each map task sends at most one row per key, however many copies it holds.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def assign_surrogate_keys(
    df: DataFrame, business_key: str, surrogate_key: str, start: int | Column = 0, hex_digits: int = 4
) -> DataFrame:
    """Number rows ``start + 1, start + 2, ...`` without a gap. ``business_key`` must be unique; NULL counts as a key.

    Rows are numbered in the order of their key's digest. They are spread over ``16 ** hex_digits`` buckets by
    its first digits and numbered inside their bucket; the buckets' offsets come from their counts. No task ever sorts
    all rows, and the numbers depend on the keys alone - not on the buckets - so a recomputed task gives them again.
    ``df`` is read twice: hand in a stored table when it is costly to compute.
    """
    digest = F.md5(F.coalesce(F.col(business_key).cast("string"), F.lit("\x00")))
    bucketed = df.withColumn("_digest", digest).withColumn("_bucket", F.substring("_digest", 1, hex_digits))
    # At most 16 ** hex_digits rows reach this window.
    offsets = (
        bucketed.groupBy("_bucket")
        .count()
        .select(
            "_bucket",
            (F.sum("count").over(Window.orderBy("_bucket")) - F.col("count")).alias("_offset"),
        )
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", business_key))
    number = (F.lit(start) if isinstance(start, int) else start) + F.col("_offset") + F.col("_rank")
    numbered = bucketed.withColumn("_rank", rank).join(offsets, "_bucket")
    return numbered.select(number.cast("bigint").alias(surrogate_key), *df.columns)


def highest_key(df: DataFrame, surrogate_key: str) -> Column:
    """Largest key in use, 0 for an empty table, as a scalar subquery."""
    return df.agg(F.coalesce(F.max(surrogate_key), F.lit(0)).cast("bigint").alias("highest")).scalar()


def resolve_keys(facts: DataFrame, lookups: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Attach surrogate keys. ``lookups`` maps a fact column to (dimension, surrogate column).

    The dimension must hold the business key under the fact column's name. A key without a
    match becomes NULL; nothing is dropped.
    """
    for column, (dimension, surrogate) in lookups.items():
        facts = facts.join(dimension.select(column, surrogate), column, "left")
    return facts


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def keys_without_match(referencing: DataFrame, defining: DataFrame, key: str) -> DataFrame:
    """Distinct keys that are referenced but not defined."""
    return referencing.select(key).where(F.col(key).isNotNull()).distinct().join(defining.select(key), key, "left_anti")
