"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import tune

#: Rows and bytes in one Arrow batch: Python workers hold one batch of texts at a time. A longer text is a batch of its own.
BATCH_ROWS = 256
BATCH_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(df: DataFrame) -> DataFrame:
    """``df``, after the settings that bound what a Python worker holds. Every operator passes its input through this."""
    conf = tune(df.sparkSession).conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (whatever its case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def seeded_hash(seed: str, column: Column | str) -> Column:
    """32 hex digits that depend on the seed and the value alone; NULL counts as a value of its own."""
    value = F.col(column) if isinstance(column, str) else column
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(value.cast("string"), F.lit("\x00"))))


def unit_interval(digest: Column) -> Column:
    """The first 13 hex digits as a number strictly between 0 and 1."""
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def slices_for(rows: int) -> int:
    """How many slices to rank ``rows`` rows in: as many slices as rows in each, so neither grows past the square root."""
    return max(1, math.isqrt(max(rows, 1)))


def sums_before(df: DataFrame, groups: Sequence[str], slice_column: str, order: Sequence[str], value: Column, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over the rows before each one, in its group, by slice and then ``order``.

    The order must be total. No task sorts a whole group: sums run inside a slice, and one total
    per slice carries what lies before it. NULL groups are groups of their own.
    """
    part, inside, carried = free_name(df, "_part"), free_name(df, "_inside"), free_name(df, "_carried")
    valued = df.withColumn(part, value)
    totals = valued.groupBy(*groups, slice_column).agg(F.sum(part).alias(carried))
    earlier = Window.partitionBy(*groups).orderBy(slice_column).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn(carried, F.coalesce(F.sum(carried).over(earlier), F.lit(0)))
    before = Window.partitionBy(*groups, slice_column).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = valued.withColumn(inside, F.coalesce(F.sum(part).over(before), F.lit(0)))
    keys = [*groups, slice_column]
    right = {k: free_name(valued, f"_right_{k}") for k in keys}
    totals = totals.withColumnsRenamed(right)
    match = [F.col(k).eqNullSafe(F.col(right[k])) for k in keys]
    total = (F.col(inside) + F.col(carried)).alias(name)
    return ranked.join(totals, match).select(*df.columns, total)
