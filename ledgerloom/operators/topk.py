"""The keys with the largest sums, without summing every key where bounds tell that most can't be among them.

Keys are hashed into buckets. What a bucket's positive values add up to bounds the sum of each of its keys from above. The sums
of the keys in the best buckets give a least sum that the answer must reach; only keys of buckets whose bound reaches it
are summed at all. The result is exact, whatever the values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table

BUCKETS = 65_536
#: Buckets tried first, per key asked for.
FIRST_TRY = 4


@dataclass(frozen=True)
class TopK:
    """``rows`` (the key and its sum, best first), the buckets with keys, and how many of them were summed key by key."""

    rows: DataFrame
    buckets: int
    buckets_summed: int


def top_by_sum(df: DataFrame, key: str, value: str, name: str, k: int, buckets: int = BUCKETS) -> TopK:
    """The ``k`` keys with the largest sums ``name``; of equal sums the smaller key comes first. NULL is a key; keys without a value come last.

    One pass sums buckets (at most ``buckets`` rows leave a task), a second the keys of the ``FIRST_TRY * k`` buckets with the largest
    bounds. Where the bounds of all others lie below the k-th sum, as with skewed keys, that is the answer. Else a third pass sums
    the keys of every bucket whose bound reaches that sum - of all buckets in the worst case, when many keys are about equally large.
    ``value`` should be a decimal or an integer, so that sums are exact. ``df`` is read up to
    three times: hand in a stored table when it is costly to compute.
    """
    if k < 1:
        raise ValueError(f"k must be positive, not {k}")
    placed = df.select(key, value, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("_bucket"))
    bound = F.coalesce(F.sum(F.when(F.col(value) > 0, F.col(value))), F.sum(value) * 0)
    bounds = stage_table(placed.groupBy("_bucket").agg(bound.alias("_bound")), "bucket-bounds")
    total = bounds.count()
    # At most FIRST_TRY * k numbers.
    first = [r[0] for r in bounds.orderBy(F.desc_nulls_last("_bound"), "_bucket").limit(FIRST_TRY * k).select("_bucket").collect()]
    best = stage_table(_best(placed.where(F.col("_bucket").isin(first)), key, value, name, k), "top-first")
    least = best.agg(F.count(name).alias("n"), F.min(name).alias("least")).collect()[0]
    if len(first) == total:
        return TopK(best.orderBy(*_order(key, name)), total, total)
    # With fewer than k sums nothing bounds the rest.
    reaches = F.col("_bound") >= F.lit(least.least) if least.n == k else F.lit(True)
    open_buckets = bounds.where(reaches).select("_bucket")
    if not open_buckets.where(~F.col("_bucket").isin(first)).limit(1).count():
        return TopK(best.orderBy(*_order(key, name)), total, len(first))
    rows = _best(placed.join(open_buckets, "_bucket", "left_semi"), key, value, name, k)
    return TopK(rows, total, open_buckets.count())


def _order(key: str, name: str) -> list[Column]:
    return [F.desc_nulls_last(name), F.asc_nulls_last(key)]


def _best(rows: DataFrame, key: str, value: str, name: str, k: int) -> DataFrame:
    return rows.groupBy(key).agg(F.sum(value).alias(name)).orderBy(*_order(key, name)).limit(k)
