"""Sharding by proportional stratified interleaving.

Rows are shuffled inside their source by a seeded digest of the id and ranked. Row ``r`` of ``n`` in a
source lies at fraction ``(r + 1/2) / n``; in the order of these fractions every stretch holds each
source in its share, so cutting that order into equal runs gives shards that all match the mixture.

Only DataFrame functions are used. No source and no shard is ever sorted in one task: both rankings
work in as many slices as a slice has rows and carry one count per slice.

Ids need not be unique: rows that agree in id, source and text are ranked in any order, as nothing tells
them apart. A NULL source is a source of its own, a NULL id has a digest of its own, NULL and empty
texts have 0 bytes. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage_table
from .common import bounded, free_name, read, seeded_hash, slices_for, sums_before, unit_interval

SHARDS = 24
SEED = "interleave-1"
OVERHEAD_BYTES = 8


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def interleaved(df: DataFrame, row_id: str, source: str, shards: int = SHARDS, seed: str = SEED, ties: tuple[str, ...] = ()) -> DataFrame:
    """Add ``shard`` (0 to ``shards - 1``) and ``slot`` (place in the shard, from 0) to every row.

    Shard sizes differ by one row at most. ``ties`` order rows whose id and source agree. Input
    columns named ``shard`` or ``slot`` are replaced. ``df`` is read several times: hand in a stored
    table when it is costly to compute.
    """
    df = bounded(df).drop("shard", "slot")
    digest, spot, rank, size = (free_name(df, n) for n in ("_digest", "_spot", "_rank", "_size"))
    slice_, place = free_name(df, "_slice"), free_name(df, "_place")
    total = df.count()
    slices = slices_for(total)

    dealt = df.withColumn(digest, seeded_hash(seed, row_id))
    dealt = dealt.withColumn(slice_, F.floor(unit_interval(F.col(digest)) * slices))
    dealt = sums_before(dealt, [source], slice_, [digest, row_id, *ties], F.lit(1), rank)
    right = free_name(df, "_right_source")
    sizes = df.groupBy(F.col(source).alias(right)).agg(F.count("*").alias(size))
    sized = dealt.join(sizes, F.col(source).eqNullSafe(F.col(right))).drop(right)
    sized = sized.withColumn(spot, (2 * F.col(rank) + 1) / (2 * F.col(size)))

    sized = sized.withColumn(slice_, F.floor(F.col(spot) * slices))
    placed = sums_before(sized, [], slice_, [spot, source, rank], F.lit(1), place)
    shard = F.expr(f"CAST({place} * {shards} div {max(total, 1)} AS INT)")
    # The first place of a shard is the least one that the division above maps to it.
    first = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    placed = placed.withColumn("shard", shard).withColumn("slot", (F.col(place) - first).cast("long"))
    return placed.drop(digest, spot, rank, size, slice_, place)


def op5_stratified_interleaving(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    measured = documents.select(
        "doc_id",
        "source",
        (text_bytes(F.col("text")) + OVERHEAD_BYTES).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    sharded = interleaved(stage_table(measured, "shard-sizes"), "doc_id", "source", ties=("size", "text_crc32"))
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


ORACLE = """
WITH RECURSIVE crc_steps AS (
  SELECT i AS byte, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT byte, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, k + 1 FROM crc_steps WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY byte) AS t FROM crc_steps WHERE k = 8),
measured AS (
  SELECT doc_id, source, coalesce(octet_length(encode(text)), 0)::BIGINT + 8 AS size, hex(encode(coalesce(text, ''))) AS digits FROM documents
), summed AS (
  SELECT doc_id, source, size,
    xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(len(digits) // 2), lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8)), 4294967295::BIGINT) AS text_crc32
  FROM measured, crc_table
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('interleave-1:' || coalesce(doc_id::VARCHAR, chr(0))), doc_id, size, text_crc32) - 1 AS r,
    count(*) OVER (PARTITION BY source) AS n FROM summed
), placed AS (
  SELECT *, row_number() OVER (ORDER BY (2 * r + 1)::DOUBLE / (2 * n), source NULLS FIRST, r) - 1 AS place, count(*) OVER () AS total FROM ranked
), cut AS (SELECT *, (place * 24 // total)::INTEGER AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard, (place - (shard::BIGINT * total + 23) // 24)::BIGINT AS slot,
  CAST(NULL AS INTEGER) AS grown_shard, source FROM cut
"""
