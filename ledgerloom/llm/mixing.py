"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document gets the key ``-ln(u) / w``: ``u`` is uniform, drawn from a seeded digest of its id and text,
``w`` its quality weight. In the order of these keys every prefix is a weighted sample without
replacement. A source whose target is at least its size is first taken whole, as many times as fit;
what is left of the target is filled by a prefix of that order: a document is taken if that
brings the source's sum nearer to its target than leaving it out.

Targets share ``share`` times all words by weight. None exceeds ``most`` times its source's size: what is
above is shared again by weight until no target is above. That is the water level ``l`` at which the sum of
``min(most * size, l * weight)`` is the total, found from running sums over the sources ordered by
``size / weight``.

A source may hold any part of all rows: its order is cut into slices that are summed on their own.
NULL sources form one source, the last. NULL and empty texts have size 0 and take no words; they are kept
as often as their source's complete epochs, and once more by a fractional selection that they lie in.
Copies of a row are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage_table
from .common import bounded, free_name, read, seeded_hash, slices_for, sums_before, unit_interval

WEIGHTS = (3, 1, 2)
#: The mix holds this share of all words, as numerator and denominator.
SHARE = (3, 2)
MOST = 2
SEED = "mix-1"
_SYMBOLS = b"#*$%&|<>"


def text_measures(text: Column) -> Column:
    """A struct of ``size``, words split at ASCII white space, and ``symbols``, marks that are rare in prose."""

    @F.pandas_udf("size long, symbols long")
    def measured(texts: pd.Series) -> pd.DataFrame:
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        sizes = [len(b.split()) for b in raw]  # bytes.split() splits at \x20 and \x09-\x0D
        return pd.DataFrame({"size": sizes, "symbols": [sum(b.count(s) for s in _SYMBOLS) for b in raw]})

    return measured(text)


def quality_weight(size: Column, symbols: Column) -> Column:
    """1 for plain prose, down to 0.25 for texts with as many marks as words."""
    return 1 - 0.75 * F.least(F.lit(1.0), symbols / F.greatest(size, F.lit(1)))


def source_targets(sizes: DataFrame, source: str, size: str, weights: Sequence[int] = WEIGHTS, share=SHARE, most: int = MOST) -> DataFrame:
    """One row per source with its ``target``; ``sizes`` has one row per source with its total ``size``.

    Weights are dealt in turn to the sources by code point, NULL last. The result has as many rows as
    there are sources, and only such rows are ordered in one task.
    """
    place = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    weighed = sizes.select(source, size, weight.cast("long").alias("_weight"))
    up = Window.orderBy(F.col(size) / F.col("_weight"), F.col(source).asc_nulls_last())
    whole = up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    num, den = share
    # If this source and those after it share what the ones before leave: (num * all - den * caps before) / (den * weights left).
    left = weighed.select(
        "*",
        (num * F.sum(size).over(whole) - den * most * F.coalesce(F.sum(size).over(before), F.lit(0))).alias("_left"),
        (F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0))).alias("_weights"),
    )
    # The level is that of the first source which does not reach its cap.
    free = F.col("_left") <= den * most * F.col(size) * F.col("_weights") / F.col("_weight")
    first = left.withColumn("_free", free & (F.col(size) > 0)).withColumn(
        "_at", F.first(F.when(F.col("_free"), F.struct("_left", "_weights")), ignorenulls=True).over(whole)
    )
    level = F.col("_at._left") * F.col("_weight") / (den * F.col("_at._weights"))
    cap = (most * F.col(size)).cast("double")
    return first.select(source, size, F.coalesce(F.least(cap, level), cap).alias("target"))


def mixed(
    df: DataFrame,
    row_id: str,
    source: str,
    text: str,
    weights: Sequence[int] = WEIGHTS,
    share=SHARE,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """Per row: ``row_id``, ``source``, ``text_md5``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (words)."""
    measured = bounded(df).select(
        F.col(row_id).alias("row_id"),
        F.col(source).alias("source"),
        F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_md5"),
        text_measures(F.col(text)).alias("m"),
    ).select("row_id", "source", "text_md5", "m.size", "m.symbols")
    rows = stage_table(measured, "mix-sizes")
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("size")), "source", "size", weights, share, most)
    targets = targets.select(F.col("source").alias("_source"), F.col("size").alias("source_size"), "target")

    slices = slices_for(rows.count())
    uniform = unit_interval(seeded_hash(seed, F.concat_ws(":", F.col("row_id"), F.col("text_md5"))))
    keyed = rows.withColumn("_key", -F.log(uniform) / quality_weight(F.col("size"), F.col("symbols")))
    # Keys of weight 1 spread evenly over the slices, larger ones lie towards the last.
    keyed = keyed.withColumn("_slice", F.floor((1 - F.exp(-F.col("_key") / 2)) * slices))
    ordered = sums_before(keyed, ["source"], "_slice", ["_key", "row_id", "text_md5"], F.col("size"), "_before")
    joined = ordered.join(targets, F.col("source").eqNullSafe(F.col("_source")))

    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - epochs * F.col("source_size")
    more = F.col("_before") + F.col("size") / 2 <= rest
    copies = (epochs + F.when(more & (rest > 0), 1).otherwise(0)).cast("long")
    return joined.withColumn("copies", copies).select(
        "row_id", "source", "text_md5", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix_rows(df: DataFrame, row_id: str, source: str, text: str, **options) -> DataFrame:
    """The rows of ``df`` as often as the mix takes them, with their columns as they were."""
    chosen = mixed(df, row_id, source, text, **options).where("copies > 0")
    ways = chosen.groupBy("row_id", "source", "text_md5").agg(F.collect_list("copies").alias("each"))
    digest, number, copies = (free_name(df, n) for n in ("_digest", "_number", "_copies"))
    right = {c: free_name(df, f"_right_{c}") for c in ways.columns}
    ways = ways.withColumnsRenamed(right)
    # Rows that agree in id, source and text are told apart by a number among themselves.
    same = Window.partitionBy(row_id, source, digest).orderBy(row_id)
    numbered = df.withColumn(digest, F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).withColumn(number, F.row_number().over(same))
    match = F.col(row_id).eqNullSafe(F.col(right["row_id"])) & F.col(source).eqNullSafe(F.col(right["source"])) & (F.col(digest) == F.col(right["text_md5"]))
    joined = numbered.join(ways, match).withColumn(copies, F.get(F.col(right["each"]), F.col(number) - 1))
    repeated = joined.where(F.col(copies).isNotNull()).withColumn(copies, F.explode(F.array_repeat(F.lit(1), F.col(copies).cast("int"))))
    return repeated.select(*df.columns)


def op6_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixed(read(spark, sf_dir, "documents"), "doc_id", "source", "text")
    return mix.select(F.col("row_id").alias("doc_id"), "size", "source_size", "target", "taken", "source", "copies")


ORACLE = r"""
WITH rows AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS h,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS symbols
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS size FROM rows GROUP BY source
), weighed AS (
  SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS w FROM sizes
), levels AS (
  SELECT a.*, 3 * (SELECT sum(size) FROM weighed) - 4 * coalesce((SELECT sum(size) FROM weighed b WHERE b.size / b.w < a.size / a.w), 0) AS rest,
    (SELECT sum(w) FROM weighed b WHERE b.size / b.w >= a.size / a.w) AS weights
  FROM weighed a
), level AS (
  SELECT rest, weights FROM levels WHERE size > 0 AND rest <= 4 * size * weights / w ORDER BY size / w LIMIT 1
), targets AS (
  SELECT source, size AS source_size, least(2.0::DOUBLE * size, coalesce(rest::DOUBLE * w / (2 * weights), 2.0::DOUBLE * size)) AS target
  FROM weighed LEFT JOIN level ON true
), keyed AS (
  SELECT *, -ln((('0x' || substr(md5('mix-1:' || concat_ws(':', doc_id, h)), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
    / (1 - 0.75::DOUBLE * least(1.0::DOUBLE, symbols::DOUBLE / greatest(size, 1))) AS k
  FROM rows
), ordered AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM keyed
), chosen AS (
  SELECT o.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
  FROM ordered o JOIN targets t ON o.source IS NOT DISTINCT FROM t.source
), counted AS (
  SELECT *, (epochs + CASE WHEN before + size / 2.0::DOUBLE <= target - epochs * source_size AND target - epochs * source_size > 0 THEN 1 ELSE 0 END)::BIGINT AS copies FROM chosen
)
SELECT doc_id, size, source_size, target::DOUBLE AS target, copies * size AS taken, source, copies FROM counted
"""
