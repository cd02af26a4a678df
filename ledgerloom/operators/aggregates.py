"""Aggregates beyond ``groupBy().agg()``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import percent, ratio, round_to
from ..session import stage_table
from .keys import null_safe_join


def with_share(grouped: DataFrame, value: str, name: str, digits: int | None = 2) -> DataFrame:
    """Add each group's percentage of the total. ``grouped`` is a summary of few rows."""
    total = F.sum(value).over(Window.partitionBy())
    return grouped.withColumn(name, percent(F.col(value), total, digits))


def metric_rows(one_row: DataFrame, metrics: Sequence[tuple[str, Column, str]]) -> DataFrame:
    """Turn one row of aggregates into ``metric_name, metric_value, metric_type`` rows."""
    items = [
        F.struct(
            F.lit(name).alias("metric_name"),
            value.cast("double").alias("metric_value"),
            F.lit(kind).alias("metric_type"),
        )
        for name, value, kind in metrics
    ]
    return one_row.select(F.inline(F.array(*items)))


def totals(df: DataFrame, **aggregates: Column) -> Column:
    """Several aggregates of one table as a struct-valued scalar subquery: one scan, one row."""
    return df.agg(F.struct(*[value.alias(name) for name, value in aggregates.items()]).alias("totals")).scalar()


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of NULLs per column."""
    return df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])


def column_summary(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """count, mean, sample deviation, min and max of numeric columns, one row per column, one scan."""
    stats = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("value_count"),
            round_to(F.avg(c), digits).alias("mean_value"),
            round_to(F.stddev(c), digits).alias("stddev_value"),
            F.min(c).cast("double").alias("min_value"),
            F.max(c).cast("double").alias("max_value"),
        )
        for c in columns
    ]
    return df.agg(F.array(*stats).alias("stats")).select(F.inline("stats"))


def distinct_counts(df: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """Distinct values per key of several columns, named by ``columns``.

    Each column meets its key in a sum of its own that combines before the shuffle; several distinct counts in one
    aggregate would copy every row once per column.
    """
    counts = []
    for name, column in columns.items():
        pairs = df.select(key, column).groupBy(key, column).agg(F.lit(1).alias("_one"))
        counts.append(pairs.groupBy(key).agg(F.count(column).alias(name)))
    return reduce(lambda left, right: null_safe_join(left, right, [key]), counts)


def digest(c: str) -> Column:
    """The SHA-256 digest of any value's text: what large values travel and are compared by. NULL stays NULL."""
    return F.sha2(F.col(c).cast("string").cast("binary"), 256)


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing count, missing percentage and distinct count per column, plus duplicate rows.

    One scan unpivots to (column, value) pairs which are combined map-side, so neither a wide
    table nor a frequent value gathers in one task. Values travel as digests.
    """
    columns = list(columns or df.columns)
    short = df.select(*[digest(c).alias(c) for c in columns])
    pairs = short.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns]))
    )
    per_value = pairs.groupBy("column_name", "value").agg(F.count("*").alias("row_count"))
    per_column = per_value.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("row_count"))), F.lit(0)).alias("missing_values"),
        F.count("value").alias("unique_values"),
    )
    copies = short.groupBy(*columns).agg((F.count("*") - 1).alias("surplus")).agg(
        F.coalesce(F.sum("surplus"), F.lit(0)).alias("duplicate_rows")
    )
    return per_column.select(
        "column_name",
        "missing_values",
        percent(F.col("missing_values"), F.col("row_count")).alias("percent_missing"),
        "unique_values",
        copies.scalar().alias("duplicate_rows"),
    )


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their frequency.

    Values are counted by their digest; only the repeated ones are looked up, once each, at the end.
    """
    keyed = df.select(F.col(column), digest(column).alias("_digest"))
    repeated = keyed.groupBy("_digest").agg(F.count("*").alias("frequency")).where("frequency > 1")
    texts = null_safe_join(keyed, repeated, ["_digest"])
    return texts.groupBy("_digest", "frequency").agg(F.first(column).alias(column)).select(column, "frequency")


def duplicate_id_check(df: DataFrame, column: str) -> DataFrame:
    """Rows, distinct ids and surplus rows."""
    per_id = df.groupBy(column).agg(F.count("*").alias("row_count"))
    return per_id.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"), F.count(column).alias("unique_ids")
    ).withColumn("surplus_rows", F.col("total_rows") - F.col("unique_ids"))


def precision_recall(df: DataFrame, flagged: Column, actual: Column) -> DataFrame:
    """True and false positives, precision and recall of a flag; 0 where a divisor is 0."""
    one_row = df.agg(
        F.count_if(flagged & actual).alias("true_positives"),
        F.count_if(flagged & ~actual).alias("false_positives"),
        F.count_if(flagged).alias("flagged_count"),
        F.count_if(actual).alias("actual_count"),
    )
    hits = F.col("true_positives")
    return one_row.select(
        "*",
        F.coalesce(ratio(hits, F.col("flagged_count")), F.lit(0.0)).alias("precision"),
        F.coalesce(ratio(hits, F.col("actual_count")), F.lit(0.0)).alias("recall"),
    )


def quantile_brackets(
    values: DataFrame, probabilities: Sequence[float], accuracy: int
) -> tuple[int, list[tuple[int, int]]]:
    """Rows of ``values`` (a bigint column ``v`` without NULL) and, per probability, two values around its quantile.

    One pass with a mergeable rank sketch: its answers lie at most ``1 / accuracy`` of all rows from the rank asked for. Asking
    ``2 / accuracy`` below and above leaves the quantile between them.
    """
    slack = 2 / accuracy
    asked = [end for p in probabilities for end in (max(0.0, p - slack), min(1.0, p + slack))]
    one = values.agg(
        F.count("*").alias("n"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        F.percentile_approx("v", asked, accuracy).alias("ends"),
    ).first()
    if not one["n"]:
        return 0, []
    brackets = []
    for i in range(len(probabilities)):
        below, above = asked[2 * i], asked[2 * i + 1]
        brackets.append((one["ends"][2 * i] if below > 0 else one["low"], one["ends"][2 * i + 1] if above < 1 else one["high"]))
    return one["n"], brackets


def bracket_counts(values: DataFrame, spans: Sequence[tuple[int, int]]) -> DataFrame:
    """``region``, ``v``, ``n``: each value inside the disjoint ascending ``spans`` with its rows, one row per gap around them.

    Regions count from 0 (below the first span); odd ones are spans. One pass, combined before the shuffle.
    """
    region = F.lit(2 * len(spans))
    inside = F.lit(False)
    for i, (low, high) in reversed(list(enumerate(spans))):
        region = F.when(F.col("v") < low, 2 * i).when(F.col("v") <= high, 2 * i + 1).otherwise(region)
        inside = inside | F.col("v").between(low, high)
    return values.groupBy(region.alias("region"), F.when(inside, F.col("v")).alias("v")).agg(F.count("*").alias("n"))


def exact_quantiles(
    df: DataFrame,
    column: str,
    probabilities: Sequence[float],
    scale: int = 4,
    buckets: int = 2**18,
    accuracy: int = 10_000,
) -> list[Decimal | None]:
    """Smallest value whose cumulative share reaches each probability, exact to ``scale`` digits.

    ``df`` is read twice. The first pass sketches the ranks and brackets every quantile; the second counts the values inside the
    brackets and the rows between them. These counts, some ``4 / accuracy`` of the rows per probability at most (but for
    frequent values, which are one row each), are stored and searched: in at most ``buckets`` ranges at a time, of which the
    one that holds the wanted rank is divided again. That the ranks lie inside their brackets is checked by the counts;
    should one not, its search starts from all values instead, in more passes.
    """
    unit = 10**scale
    # The limits are set by the data: Spark fails on overflow rather than wrapping around.
    values = df.select((F.col(column).cast(f"decimal(18,{scale})") * unit).cast("bigint").alias("v")).where(
        "v is not null"
    )
    total, brackets = quantile_brackets(values, probabilities, accuracy)
    if not total:
        return [None] * len(probabilities)
    spans: list[tuple[int, int]] = []
    for low, high in sorted(brackets):
        if spans and low <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], high))
        else:
            spans.append((low, high))
    counts = stage_table(bracket_counts(values, spans), "quantile-counts")
    sizes = dict(counts.groupBy("region").agg(F.sum("n")).collect())

    found, outside = [], []
    for p, (low, _) in zip(probabilities, brackets):
        i = next(i for i, span in enumerate(spans) if span[0] <= low <= span[1])
        below = sum(sizes.get(r, 0) for r in range(2 * i + 1))
        held = below / total < p and (below + sizes.get(2 * i + 1, 0)) / total >= p
        found.append((*spans[i], below))
        outside += [] if held or p <= 0 else [p]
    if outside:
        counts = values.select("v", F.lit(1).alias("n"))
        edges = values.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
        found = [(edges["low"], edges["high"], 0)] * len(probabilities)
    return [Decimal(v).scaleb(-scale) for v in _narrowed(counts, probabilities, found, total, buckets)]


def _narrowed(
    counts: DataFrame, probabilities: Sequence[float], ranges: list[tuple[int, int, int]], total: int, buckets: int
) -> list[int]:
    """The values at the probabilities' ranks. ``counts``: ``v`` and its rows ``n``; ``ranges``: per probability lowest and highest
    candidate and the rows below. Each round counts at most ``buckets`` equal parts of a range and keeps the one that is wanted."""
    while any(low < high for low, high, _ in ranges):
        distinct = sorted({r for r in ranges if r[0] < r[1]})
        parts = F.array(
            *[
                F.when(
                    F.col("v").between(low, high),
                    F.struct(
                        F.lit(i).alias("part"),
                        F.floor((F.col("v") - low) / F.lit((high - low) // buckets + 1)).alias("bucket"),
                    ),
                )
                for i, (low, high, _) in enumerate(distinct)
            ]
        )
        histogram = (
            counts.select(F.explode(parts).alias("place"), "n")
            .where("place is not null")
            .groupBy("place.part", "place.bucket")
            .agg(F.sum("n").alias("n"))
        )
        # At most ``buckets`` rows per part.
        cumulative = histogram.withColumn(
            "up_to", F.sum("n").over(Window.partitionBy("part").orderBy("bucket"))
        )
        wanted = [
            (i, distinct.index(r), p, r) for i, (p, r) in enumerate(zip(probabilities, ranges)) if r[0] < r[1]
        ]
        picks = cumulative.agg(
            *[
                F.min(
                    F.when(
                        (F.col("part") == part) & ((F.col("up_to") + r[2]) / F.lit(total) >= p),
                        F.struct("bucket", "up_to", "n"),
                    )
                ).alias(f"pick_{i}")
                for i, part, p, r in wanted
            ]
        ).first()
        for i, _, _, (low, high, below) in wanted:
            pick = picks[f"pick_{i}"]
            width = (high - low) // buckets + 1
            start = low + pick["bucket"] * width
            ranges[i] = (start, min(high, start + width - 1), below + pick["up_to"] - pick["n"])
    return [low for low, _, _ in ranges]
