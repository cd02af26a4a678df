"""Loading dimensions: dates, insert-only, overwrite (type 1) and history (type 2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.conditions import case_bucket
from ..functions.dates import date_key, day_name, is_weekend, month_name
from ..session import stage_table
from .keys import assign_surrogate_keys, first_per_key, highest_key, null_safe_join


def date_rows(days: DataFrame, day: str = "full_date") -> DataFrame:
    """Calendar attributes for a frame of days."""
    d = F.col(day)
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year_number"),
        F.quarter(d).alias("quarter_number"),
        F.month(d).alias("month_number"),
        F.dayofmonth(d).alias("day_number"),
        F.weekday(d).alias("day_of_week"),
        F.weekofyear(d).alias("week_of_year"),
        day_name(d).alias("day_name"),
        month_name(d).alias("month_name"),
        is_weekend(d).alias("is_weekend"),
        (~is_weekend(d)).alias("is_business_day"),
        F.lit(False).alias("is_holiday"),
    )


def build_date_dimension(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day, both ends included."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("full_date"))
    return date_rows(days)


def covering_date_dimension(df: DataFrame, day: str) -> DataFrame:
    """One row per day from the earliest to the latest day found in ``df``."""
    span = df.agg(F.min(day).alias("first"), F.max(day).alias("last")).where("first is not null")
    return date_rows(span.select(F.explode(F.sequence("first", "last")).alias("full_date")))


def needed_date_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct keys above 0 found in any of the columns, from one scan."""
    keys = df.select(F.explode(F.array(*columns)).alias("date_key"))
    return keys.where("date_key > 0").distinct()


def missing_date_keys(needed: DataFrame, dates: DataFrame) -> DataFrame:
    return needed.join(dates.select("date_key"), "date_key", "left_anti")


def insert_only(dimension: DataFrame, incoming: DataFrame, key: str, surrogate: str, order: Sequence[str]) -> DataFrame:
    """New members only, first row per key, numbered after the keys in use.

    The new members are stored before they are numbered, which reads them twice.
    """
    new = first_per_key(incoming, [key], order).join(dimension.select(key), key, "left_anti")
    return assign_surrogate_keys(stage_table(new, "new-members"), key, surrogate, highest_key(dimension, surrogate))


def scd1_upsert(dimension: DataFrame, incoming: DataFrame, key: str, surrogate: str) -> DataFrame:
    """Overwrite the attributes of known members, add new ones, keep every surrogate key.

    ``incoming`` holds one row per key; NULL is a key like any other. The result is the whole new dimension. The
    incoming rows are matched once and stored; the three parts of the result read the stored rows.
    """
    columns = dimension.columns
    matched = stage_table(null_safe_join(incoming, dimension.select(key, surrogate), [key], "left"), "matched-members")
    new = F.col(surrogate).isNull()
    met = matched.where(~new).select(F.col(surrogate).alias("_met"))
    untouched = dimension.join(met, F.col(surrogate) == F.col("_met"), "left_anti").select(*columns)
    updated = matched.where(~new).select(*columns)
    added = assign_surrogate_keys(
        matched.where(new).drop(surrogate), key, surrogate, highest_key(dimension, surrogate)
    ).select(*columns)
    return untouched.unionByName(updated).unionByName(added)


def scd2_detect(dimension: DataFrame, staged: DataFrame, key: str, surrogate: str, tracked: Sequence[str]) -> DataFrame:
    """Classify each staged member against its current version.

    Adds the current surrogate key, ``change_type`` (NEW, CHANGED, UNCHANGED) and
    ``scd_action``. The comparison treats NULL as a value.
    """
    current = dimension.where("is_current").select(
        key, surrogate, F.struct(*tracked).alias("_current_version")
    )
    joined = staged.join(current, key, "left")
    same: Column = F.lit(True)
    for column in tracked:
        same = same & F.col(column).eqNullSafe(F.col(f"_current_version.{column}"))
    is_new = F.col(surrogate).isNull()
    return joined.select(
        *staged.columns,
        surrogate,
        case_bucket([(is_new, "NEW"), (~same, "CHANGED")], "UNCHANGED").alias("change_type"),
        case_bucket([(is_new, "INSERT_NEW"), (~same, "EXPIRE_AND_INSERT")], "NO_ACTION").alias("scd_action"),
    )


def scd2_apply(
    dimension: DataFrame, staged: DataFrame, key: str, surrogate: str, tracked: Sequence[str], as_of: date
) -> DataFrame:
    """The dimension after loading ``staged`` (one row per member) on ``as_of``.

    Changed members get their current version expired and a new one added; new members get
    their first version. Every staged row is classified once, against the state before the
    load, and stored; loading the same rows again changes nothing.
    """
    detected = stage_table(scd2_detect(dimension, staged, key, surrogate, tracked), "detected-changes")
    changed = detected.where("change_type = 'CHANGED'").select(surrogate, F.lit(True).alias("_changed"))
    kept = dimension.join(changed, surrogate, "left")
    expired_now = F.col("_changed").isNotNull()
    after_expiry = kept.select(
        *[
            F.when(expired_now, F.lit(as_of)).otherwise(F.col(c)).alias(c)
            if c == "expiration_date"
            else (F.col(c) & ~expired_now).alias(c)
            if c == "is_current"
            else F.col(c)
            for c in dimension.columns
        ]
    )
    versions = detected.where("change_type <> 'UNCHANGED'").select(
        key,
        *tracked,
        F.lit(as_of).alias("effective_date"),
        F.lit(None).cast("date").alias("expiration_date"),
        F.lit(True).alias("is_current"),
    )
    added = assign_surrogate_keys(versions, key, surrogate, highest_key(dimension, surrogate))
    return after_expiry.unionByName(added.select(*dimension.columns))


def flag_members(dimension: DataFrame, members: DataFrame, key: str, changes: Mapping[str, Column]) -> DataFrame:
    """Set columns where the key is in ``members`` (one row per key)."""
    marked = dimension.join(members.select(key, F.lit(True).alias("_member")), key, "left")
    hit = F.col("_member").isNotNull()
    return marked.select(
        *[F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in dimension.columns]
    )


def without_period(table: DataFrame, inside: Column) -> DataFrame:
    """The rows to keep when a period is loaded again."""
    return table.where(~F.coalesce(inside, F.lit(False)))
