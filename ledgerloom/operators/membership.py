"""Which keys a large table may hold: a Bloom filter kept as a table beside it, so that a load need not join all loaded keys.

A filter is cut into buckets of ``BITS`` bits. A key's hash picks its bucket, a second hash ``PROBES`` bits in it, so one row
answers for a key, and the filters of two loads unite by OR-ing the rows of equal buckets. A key that was added is always found,
another one with a small probability (``false_positive_rate``): what is found is a candidate, settled by an exact join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage_table

#: Fixed value: the bits of one of Spark's bitmaps.
BITS = 32_768
PROBES = 4
#: Bits spent per key: with four probes about 0.7 % of the other keys are found.
BITS_PER_KEY = 12
#: Filters of up to so many buckets (4 KiB each) go to every task; larger ones are joined by their bucket.
BROADCAST_BUCKETS = 2_048
_SECOND_HASH = 1_000_003


@dataclass(frozen=True)
class KeyFilter:
    """``rows`` has ``bucket`` and ``bits``, at most one row for each of ``buckets`` buckets."""

    rows: DataFrame
    buckets: int

    def united(self, other: KeyFilter) -> KeyFilter:
        """Finds what either finds."""
        if self.buckets != other.buckets:
            raise ValueError(f"filters of {self.buckets} and {other.buckets} buckets don't unite")
        rows = self.rows.unionByName(other.rows).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        return KeyFilter(rows, self.buckets)

    def save(self, path: str) -> None:
        self.rows.withColumn("buckets", F.lit(self.buckets)).write.parquet(path)


def read_filter(spark: SparkSession, path: str, buckets: int) -> KeyFilter:
    """A saved filter. One of other buckets fails: it would miss keys."""
    rows = spark.read.schema("bucket long, bits binary, buckets int").parquet(path)
    if rows.where(F.col("buckets") != buckets).limit(1).count():
        raise ValueError(f"the filter in {path} has other than {buckets} buckets")
    return KeyFilter(rows.drop("buckets"), buckets)


def buckets_for(keys: int, bits_per_key: int = BITS_PER_KEY) -> int:
    """Buckets for so many keys. Plan for growth: buckets of a kept filter can't change."""
    return max(1, math.ceil(keys * bits_per_key / BITS))


def false_positive_rate(keys: int, buckets: int) -> float:
    """Expected share of other keys that a filter of so many keys finds."""
    return (1 - math.exp(-PROBES * keys / (buckets * BITS))) ** PROBES


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("long")


def _bits(key: Column) -> list[Column]:
    """``PROBES`` times fifteen bits of a hash of their own."""
    second = F.xxhash64(key.cast("string"), F.lit(_SECOND_HASH))
    return [F.pmod(F.shiftright(second, 15 * i), F.lit(BITS)).cast("long") for i in range(PROBES)]


def key_filter(keys: DataFrame, key: str, buckets: int) -> KeyFilter:
    """The filter of the keys that are not NULL. Rows combine map-side: a task sends at most one bitmap per bucket."""
    known = keys.where(F.col(key).isNotNull())
    placed = known.select(_bucket(F.col(key), buckets).alias("bucket"), F.explode(F.array(*_bits(F.col(key)))).alias("bit"))
    return KeyFilter(placed.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")), buckets)


def _is_set(bits: Column, bit: Column) -> Column:
    byte = F.substr(bits, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(bit, F.lit(8)).cast("int")) == 1


def candidates(df: DataFrame, key: str, members: KeyFilter) -> DataFrame:
    """The rows of ``df`` whose key may have been added to ``members``. NULL keys never were."""
    rows = members.rows.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    if members.buckets <= BROADCAST_BUCKETS:
        rows = F.broadcast(rows)
    joined = df.where(F.col(key).isNotNull()).join(rows, _bucket(F.col(key), members.buckets) == F.col("_bucket"))
    for bit in _bits(F.col(key)):
        joined = joined.where(_is_set(F.col("_bits"), bit))
    return joined.drop("_bucket", "_bits")


def keys_in_both(incoming: DataFrame, loaded: DataFrame, key: str, members: KeyFilter, batch_buckets: int | None = None) -> DataFrame:
    """The distinct keys of ``incoming`` that ``loaded`` holds; ``members`` is the filter of ``loaded``.

    The kept filter leaves few incoming keys; their own filter then leaves few loaded keys. Only these two meet in the
    exact join, whatever the number of loaded keys, which are scanned but not shuffled.
    """
    maybe = stage_table(candidates(incoming.select(key), key, members).distinct(), "maybe-loaded")
    batch = key_filter(maybe, key, batch_buckets or buckets_for(maybe.count()))
    stored = candidates(loaded.select(key), key, batch)
    return maybe.join(stored, key, "left_semi")
