"""Loading facts with key resolution, a duplicate guard and load counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import case_bucket
from ..functions.numbers import percent
from ..session import stage_table
from .keys import first_per_key, resolve_keys
from .membership import KeyFilter, keys_in_both


@dataclass(frozen=True)
class FactLoad:
    """Outcome of a load: ``facts`` to append, ``rejects`` with a reason, row ``counters``."""

    facts: DataFrame
    rejects: DataFrame
    counters: DataFrame


def load_facts(
    incoming: DataFrame,
    business_key: str,
    lookups: Mapping[str, tuple[DataFrame, str]],
    valid: Sequence[tuple[Column, str]],
    order: Sequence[str],
    already_loaded: DataFrame | None = None,
    loaded_filter: KeyFilter | None = None,
    store: bool = True,
    first: Sequence[str] = (),
) -> FactLoad:
    """Resolve, check and deduplicate facts.

    A row is rejected when a condition in ``valid`` (on columns of ``incoming``) does not hold, when a lookup finds no
    surrogate key, or when its business key is loaded already. Of several acceptable rows
    with one business key the first in ``order`` is loaded.

    With ``loaded_filter``, the filter kept beside the loaded facts, only the few keys that may be on both sides are
    shuffled to find those loaded already; without it all loaded keys are.

    With ``store`` every row is classified once and stored; facts, rejects and counters read the stored rows. A report
    that takes one of the three sets ``store=False``: it is then planned on its own, so that only its columns are
    shuffled, invalid rows leave the facts before any shuffle, and nothing is written.

    Rows meet the lookups named in ``first`` before the others: those by which ``incoming`` comes partitioned or that are small.
    Rows with several faults get the reason that comes first in ``lookups`` all the same.

    Copies of one key are reduced before they meet in a task: the loaded row is chosen by a
    group limit that also runs map-side, and the rest are counted, not listed.
    """
    # Conditions are judged before the lookups: their columns need not travel with the row.
    failed = case_bucket([(~F.coalesce(ok, F.lit(False)), reason) for ok, reason in valid]) if valid else F.lit(None).cast("string")
    met = {c: lookups[c] for c in [*first, *[c for c in lookups if c not in first]]}
    resolved = resolve_keys(incoming.withColumn("_failed", failed), met)
    columns = resolve_keys(incoming, lookups).columns
    reasons = [(F.col("_failed").isNotNull(), F.col("_failed"))]
    reasons += [(F.col(surrogate).isNull(), f"unknown {column}") for column, (_, surrogate) in lookups.items()]
    marked, loaded = resolved, None
    if already_loaded is not None:
        loaded = already_loaded.select(business_key).distinct()
        if loaded_filter is not None:
            loaded = keys_in_both(incoming, already_loaded, business_key, loaded_filter)
        marked = resolved.join(loaded.withColumn("_seen", F.lit(True)), business_key, "left")
        reasons.insert(0, (F.col("_seen").isNotNull(), "duplicate"))
        columns = [business_key, *[c for c in columns if c != business_key]]
    classified = marked.withColumn("reject_reason", case_bucket(reasons)).select(*columns, "reject_reason")
    if store:
        classified = stage_table(classified, "classified-facts")
        facts = first_per_key(classified.where("reject_reason is null").drop("reject_reason"), [business_key], order)
    else:
        acceptable = resolved.where("_failed is null")
        for _, surrogate in lookups.values():
            acceptable = acceptable.where(F.col(surrogate).isNotNull())
        # Whether a key is loaded depends on the key alone: its first row meets the loaded keys.
        facts = first_per_key(acceptable.drop("_failed"), [business_key], order)
        facts = (facts if loaded is None else facts.join(loaded, business_key, "left_anti")).select(*columns)

    per_key = classified.groupBy(business_key, "reject_reason").agg(F.count("*").alias("row_count"))
    surplus = F.when(F.col("reject_reason").isNull(), F.col("row_count") - 1).otherwise(F.col("row_count"))
    rejects = per_key.select(
        business_key, F.coalesce("reject_reason", F.lit("duplicate")).alias("reject_reason"), surplus.alias("row_count")
    ).where("row_count > 0")

    duplicate = F.col("reject_reason") == "duplicate"
    counters = per_key.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_processed"),
        F.count(F.when(F.col("reject_reason").isNull(), 1)).alias("successfully_loaded"),
        F.coalesce(F.sum(F.when(F.col("reject_reason").isNotNull() & ~duplicate, F.col("row_count"))), F.lit(0)).alias(
            "failed_validation"
        ),
        F.coalesce(
            F.sum(F.when(duplicate | F.col("reject_reason").isNull(), surplus)), F.lit(0)
        ).alias("duplicate_facts"),
    )
    return FactLoad(facts, rejects, counters)


def load_success_rate(counters: DataFrame, warn_below: float = 90.0) -> DataFrame:
    """Share of processed rows that were loaded, with a warning flag."""
    rate = percent(F.col("successfully_loaded"), F.col("total_processed"), digits=1)
    return counters.select("total_processed", "successfully_loaded", rate.alias("success_rate")).withColumn(
        "load_status",
        case_bucket(
            [
                (F.col("successfully_loaded") == 0, "NOTHING LOADED"),
                (F.col("success_rate") < warn_below, "LOW SUCCESS RATE"),
            ],
            "OK",
        ),
    )


def safe_fraction(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 unless ``whole`` is positive."""
    return F.when(whole > 0, F.try_divide(part.cast("double"), whole.cast("double"))).otherwise(F.lit(0.0))
