"""Ordered calculations per key that hold when one key owns a large part of all rows.

A window sorts a whole key in one task. Here the rows are range-partitioned by key and order and stored with the number
of their range, so a range holds about as many rows as any other whatever the keys, ids and days look like. Work on rows
happens inside a key's part of one range; only one total, or a few edge rows, per key and range
meet at the key. There is one way for all keys, rare or hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table
from .keys import null_safe_join

_RANGE = "_range"
#: Rows of a range, about: what one task sorts and what a window of it holds.
RANGE_ROWS = 2_000_000


def in_ranges(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``df``, stored, with ``_range``: the numbers rise with the key and, inside a key, with the order.

    There are as many ranges as the rows need, and at least one per shuffle partition. The rows are counted first.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(least, -(-df.count() // RANGE_ROWS))
    dealt = df.repartitionByRange(ranges, key, *order).withColumn(_RANGE, F.spark_partition_id())
    return stage_table(dealt, "ordered-rows")


def running_sum(df: DataFrame, key: str, day: str, row_id: str, amount: str, name: str) -> DataFrame:
    """Sum of ``amount`` from the key's first row up to each row, ordered by day and id."""
    rows = in_ranges(df, key, [day, row_id])
    here = [key, _RANGE]
    inside = Window.partitionBy(*here).orderBy(day, row_id).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumn("_inside", F.sum(amount).over(inside))

    before = Window.partitionBy(key).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*here).agg(F.sum(amount).alias("_total"))
    carried = totals.select(*here, F.sum("_total").over(before).alias("_carried"))

    joined = null_safe_join(summed, carried, here, "left")
    total = F.coalesce(F.col("_inside") + F.col("_carried"), F.col("_inside"), F.col("_carried"))
    return joined.select(*df.columns, total.alias(name))


def moving_average(df: DataFrame, key: str, day: str, row_id: str, amount: str, name: str, rows: int = 3) -> DataFrame:
    """Average of ``amount`` over each row and the ``rows - 1`` before it, ordered by day and id.

    The first rows of a key in a range also need its last rows in earlier ranges: those edge rows,
    ``2 * (rows - 1)`` per key and range, get their own window.
    """
    back = rows - 1
    whole = Window.partitionBy(key, _RANGE)
    order = whole.orderBy(day, row_id)
    frame = order.rowsBetween(-back, Window.currentRow)
    placed = in_ranges(df, key, [day, row_id]).withColumns(
        {
            "_from_start": F.row_number().over(order),
            "_rows": F.count("*").over(whole),
            "_sum": F.sum(amount).over(frame),
            "_count": F.count(amount).over(frame),
        }
    )
    settled = placed.where(F.col("_from_start") > back)
    edges = placed.where((F.col("_from_start") <= back) | (F.col("_from_start") > F.col("_rows") - back))
    across = Window.partitionBy(key).orderBy(day, row_id).rowsBetween(-back, Window.currentRow)
    starts = edges.withColumns({"_sum": F.sum(amount).over(across), "_count": F.count(amount).over(across)}).where(
        F.col("_from_start") <= back
    )
    columns = [*df.columns, "_sum", "_count"]
    average = F.try_divide(F.col("_sum").cast("double"), F.col("_count").cast("double"))
    return settled.select(*columns).unionByName(starts.select(*columns)).select(*df.columns, average.alias(name))


def dense_rank_desc(df: DataFrame, key: str, amount: str, name: str) -> DataFrame:
    """Dense rank by ``amount``, highest first, NULL last: the place of the amount among the key's distinct amounts.

    ``df`` is read twice: hand in a stored table when it is costly to compute.
    """
    distinct = in_ranges(df.select(key, amount).distinct(), key, [amount])
    here = [key, _RANGE]
    inside = F.row_number().over(Window.partitionBy(*here).orderBy(F.col(amount).desc()))
    higher = Window.partitionBy(key).orderBy(F.col(_RANGE).desc()).rowsBetween(Window.unboundedPreceding, -1)
    counts = distinct.groupBy(*here).agg(F.count("*").alias("_amounts"))
    above = counts.select(*here, F.coalesce(F.sum("_amounts").over(higher), F.lit(0)).alias("_above"))
    rank: Column = (F.col("_above") + F.col("_inside")).cast("int")
    ranks = null_safe_join(distinct.withColumn("_inside", inside), above, here).select(key, amount, rank.alias(name))
    return null_safe_join(df, ranks, [key, amount])


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    valid_from: str,
    take: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """``facts`` with the columns ``take`` of the version that was valid at ``at``: the last of their ``key`` that begins by then.

    Of versions that begin together the last by ``order`` counts, which must be total for them. Facts without a version, with a NULL key
    or a NULL ``at`` get NULLs. There is no inequality join: facts and versions are dealt into ranges of key and time together,
    each fact takes the last version before it in its range, and the last version of each key and range is carried to the key's
    later ranges. So a key with many facts or versions is split like any other.
    """
    fact = F.struct(*[F.col(c) for c in facts.columns])
    version = F.struct(*[F.col(c) for c in take])
    ends = F.struct(*[F.col(c) for c in order])
    fact_type = facts.select(fact.alias("x")).schema["x"].dataType
    kept = versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
    begun = kept.select(
        F.col(key).alias("_key"), F.col(valid_from).alias("_at"), F.lit(0).alias("_kind"), ends.alias("_order"),
        F.lit(None).cast(fact_type).alias("_fact"), version.alias("_version"),
    )
    asked = facts.select(
        F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_kind"),
        F.lit(None).cast(begun.schema["_order"].dataType).alias("_order"), fact.alias("_fact"),
        F.lit(None).cast(begun.schema["_version"].dataType).alias("_version"),
    )
    steps = ["_at", "_kind", "_order"]
    rows = in_ranges(begun.unionByName(asked), "_key", steps)
    here = ["_key", _RANGE]
    upto = Window.partitionBy(*here).orderBy(*steps).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("_inside", F.last("_version", ignorenulls=True).over(upto)).where("_kind = 1")

    last = F.max(F.when(F.col("_kind") == 0, F.struct("_at", "_order", "_version")))["_version"].alias("_last")
    earlier = Window.partitionBy("_key").orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(*here).agg(last).select(*here, F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    joined = null_safe_join(placed, carried, here, "left")
    # A NULL key is no key: its facts have a range, but no version.
    found = F.coalesce("_inside", "_carried")
    return joined.select("_fact.*", *[found[c].alias(c) for c in take])


def history(
    events: DataFrame, key: str, valid_from: str, attributes: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Type 2 history from all recorded states: ``key``, ``valid_from``, ``attributes``, ``valid_to`` (NULL while open), ``is_current``.

    ``events`` is the log of states, several per member and in any order of arrival. Of states that begin together the last by
    ``order`` counts (a correction replaces what it corrects), equal neighbours are one version, and a version ends the day before
    the next begins, so there are no gaps and no overlaps. The result depends on the set of states alone: a late arrival splits the
    version it falls into, and what was merged before is split again, as the log keeps it. States without a day are left out.

    Members are dealt into ranges of key and day; each range needs one row per key from its neighbours only.
    """
    state = F.struct(*[F.col(c) for c in attributes])
    picked = events.where(F.col(valid_from).isNotNull()).groupBy(key, valid_from)
    single = picked.agg(F.max(F.struct(F.struct(*order).alias("rank"), state.alias("state")))["state"].alias("_state"))
    rows = in_ranges(single, key, [valid_from])
    here = [key, _RANGE]
    inside, across = Window.partitionBy(*here).orderBy(valid_from), Window.partitionBy(key).orderBy(_RANGE)

    # Wrapped, so that a state of NULLs is not taken for none.
    ends = rows.groupBy(*here).agg(F.max(F.struct(valid_from, "_state"))["_state"].alias("_end"))
    ends = ends.select(*here, F.lag(F.struct("_end")).over(across).alias("_carried"))
    before = null_safe_join(rows.withColumn("_before", F.lag(F.struct(F.col("_state").alias("_end"))).over(inside)), ends, here)
    before = before.withColumn("_before", F.coalesce("_before", "_carried"))
    changed = before.where(F.col("_before").isNull() | ~F.col("_state").eqNullSafe(F.col("_before._end"))).drop("_before", "_carried")

    begins = changed.groupBy(*here).agg(F.min(valid_from).alias("_begin")).select(*here, F.lead("_begin").over(across).alias("_carried"))
    after = null_safe_join(changed.withColumn("_next", F.lead(valid_from).over(inside)), begins, here)
    after = after.withColumn("_next", F.coalesce("_next", "_carried"))
    return after.select(
        key, valid_from, "_state.*", F.date_sub("_next", 1).alias("valid_to"), F.col("_next").isNull().alias("is_current")
    )
