"""Data-quality checks. Each returns a frame of findings; nothing is dropped from the data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import as_column, case_bucket
from ..functions.numbers import ratio, round_to
from .keys import keys_without_match

ERROR, WARNING, INFO = "ERROR", "WARNING", "INFO"
NO_ISSUES = "No data quality issues found"


# --- rules on whole tables -----------------------------------------------------------------


@dataclass(frozen=True)
class TableRule:
    """A named check: ``failed`` is true for a bad row; two messages for the two outcomes."""

    name: str
    failed: Column
    passed_message: str
    failed_message: str


def _results(counts: DataFrame) -> DataFrame:
    """(rule_name, table_name, records_checked, records_failed, passed, failed) to result rows."""
    failed = F.col("records_failed")
    share = F.when(F.col("records_checked") > 0, ratio(failed, F.col("records_checked")) * 100).otherwise(F.lit(0.0))
    return counts.select(
        "rule_name",
        "table_name",
        F.col("records_checked").cast("bigint").alias("records_checked"),
        failed.cast("bigint").alias("records_failed"),
        F.when(failed == 0, "PASSED").otherwise("FAILED").alias("validation_status"),
        round_to(share).alias("failure_percentage"),
        F.when(failed == 0, F.col("passed_message")).otherwise(F.col("failed_message")).alias("error_details"),
    )


def _result(rule: TableRule, table_name: str, checked: Column, failed: Column) -> Column:
    return F.struct(
        F.lit(rule.name).alias("rule_name"),
        F.lit(table_name).alias("table_name"),
        checked.alias("records_checked"),
        F.coalesce(failed, F.lit(0)).cast("bigint").alias("records_failed"),
        F.lit(rule.passed_message).alias("passed_message"),
        F.lit(rule.failed_message).alias("failed_message"),
    )


def check_rows(df: DataFrame, table_name: str, rules: Sequence[TableRule]) -> DataFrame:
    """All row rules of a table in one scan. An empty table passes with 0 rows checked."""
    results = [_result(rule, table_name, F.count("*"), F.count_if(rule.failed)) for rule in rules]
    return _results(df.agg(F.array(*results).alias("results")).select(F.inline("results")))


def check_row_counts(counts: DataFrame, table_name: str, rules: Sequence[TableRule]) -> DataFrame:
    """``check_rows`` from rows counted before: ``row_count`` and, per rule, ``failed_<i>`` are summed."""
    checked = F.coalesce(F.sum("row_count"), F.lit(0))
    results = [_result(rule, table_name, checked, F.sum(f"failed_{i}")) for i, rule in enumerate(rules)]
    return _results(counts.agg(F.array(*results).alias("results")).select(F.inline("results")))


def key_sets(facts: DataFrame, dimensions: Mapping[str, DataFrame], weight: str | None = None) -> DataFrame:
    """Distinct key sets of the facts with ``row_count`` and, per key column, ``_known_<key>``: whether its dimension has it.

    The facts are read once and counted before the joins, which see each key set once, not each fact. Where they were counted
    before, ``weight`` names the column with the rows that one stands for.
    """
    sets = facts.groupBy(*dimensions).agg((F.sum(weight) if weight else F.count("*")).alias("row_count"))
    for key, dimension in dimensions.items():
        known = dimension.select(key, F.lit(True).alias(f"_known_{key}")).distinct()
        sets = sets.join(known, key, "left")
    return sets.fillna(False, [f"_known_{key}" for key in dimensions])


def check_key_sets(
    facts: DataFrame,
    references: Mapping[str, tuple[DataFrame, TableRule]],
    table_name: str,
    of_known: Mapping[str, Sequence[TableRule]] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Rows whose key is not in its dimension, for all keys in one pass.

    ``references`` maps a key column to (dimension, rule); the rules in ``of_known`` judge the key itself
    where the dimension has it.
    """
    sets = key_sets(facts, {key: dimension for key, (dimension, _) in references.items()}, weight)
    rows = F.col("row_count")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, rows)), F.lit(0))

    results = []
    for key, (_, rule) in references.items():
        results.append(_result(rule, table_name, total(F.lit(True)), total(~F.col(f"_known_{key}"))))
        for more in (of_known or {}).get(key, ()):
            known = F.col(f"_known_{key}")
            results.append(_result(more, table_name, total(known), total(known & more.failed)))
    return _results(sets.agg(F.array(*results).alias("results")).select(F.inline("results")))


def check_unique(
    df: DataFrame, key: str, table_name: str, rule: TableRule, counted: Column | None = None, weight: str | None = None
) -> DataFrame:
    """Keys with more than one counted row (all rows by default), each row standing for ``weight`` rows if that is named."""
    counted = F.lit(True) if counted is None else counted
    rows = F.sum(F.when(counted, F.col(weight)).otherwise(F.lit(0))) if weight else F.count_if(counted)
    per_key = df.groupBy(key).agg(rows.alias("counted_rows"))
    return _results(
        per_key.agg(
            _result(rule, table_name, F.count(key), F.count_if(F.col("counted_rows") > 1)).alias("result")
        ).select("result.*")
    )


def combine(results: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def orphan_report(facts: DataFrame, references: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """Orphaned rows per reference, in one pass over the facts. ``references`` maps a label to (key column, dimension)."""
    sets = key_sets(facts, {key: dimension for key, dimension in references.values()})
    orphans = [
        F.struct(
            F.lit(label).alias("reference"),
            F.coalesce(F.sum(F.when(~F.col(f"_known_{key}"), F.col("row_count"))), F.lit(0)).alias("orphaned_rows"),
        )
        for label, (key, _) in references.items()
    ]
    return sets.agg(F.array(*orphans).alias("orphans")).select(F.inline("orphans"))


def check_extracts(
    tables: Mapping[str, DataFrame], minimum_rows: Mapping[str, int], references: Sequence[tuple[str, str, str]]
) -> DataFrame:
    """Volume per extract, and distinct dangling keys per (child, parent, key) reference."""
    parts = []
    for name, least in minimum_rows.items():
        parts.append(
            tables[name].agg(
                F.lit(f"minimum rows: {name}").alias("check_name"),
                F.count("*").alias("actual"),
                F.lit(least).cast("bigint").alias("expected"),
                (F.count("*") >= least).alias("passed"),
            )
        )
    for child, parent, key in references:
        parts.append(
            keys_without_match(tables[child], tables[parent], key).agg(
                F.lit(f"orphaned {key}: {child}").alias("check_name"),
                F.count("*").alias("actual"),
                F.lit(0).cast("bigint").alias("expected"),
                (F.count("*") == 0).alias("passed"),
            )
        )
    return combine(parts)


def row_warnings(warnings: Sequence[tuple[Column, str]]) -> Column:
    """Array of the messages whose condition holds for the row."""
    return F.array_compact(F.array(*[F.when(condition, message) for condition, message in warnings]))


# --- rules on fields -----------------------------------------------------------------------


@dataclass(frozen=True)
class FieldRule:
    """What a column must satisfy. Only set properties are checked."""

    column: str
    required: bool = False
    type: str | None = None
    pattern: str | None = None
    min_length: int | None = None
    max_length: int | None = None
    allowed: tuple[Any, ...] | None = None
    severity: str = ERROR


def validate_schema(df: DataFrame, required: Iterable[str]) -> tuple[set[str], set[str]]:
    """(missing, extra) columns. Looks at metadata only."""
    actual, wanted = set(df.columns), set(required)
    return wanted - actual, actual - wanted


def _finding(rule: FieldRule, kind: str, message: Column | str) -> Column:
    return F.struct(
        F.lit(rule.column).alias("field"),
        F.lit(kind).alias("rule"),
        (F.lit(message) if isinstance(message, str) else message).alias("message"),
        F.lit(rule.severity).alias("severity"),
    )


def _field_findings(df: DataFrame, rule: FieldRule) -> list[Column]:
    value = F.col(rule.column)
    data_type = df.schema[rule.column].dataType
    is_text = data_type.typeName() in ("string", "varchar", "char")
    missing = value.isNull() | (value == "") if is_text else value.isNull()
    # A missing required value is reported once; the other rules then do not apply.
    present = value.isNotNull() & ~missing if rule.required else value.isNotNull()
    findings = []
    if rule.required:
        findings.append(F.when(missing, _finding(rule, "required", "Missing required value")))
    if rule.type and is_text and rule.type not in ("string", "str"):
        bad = present & value.try_cast(rule.type).isNull()
        findings.append(F.when(bad, _finding(rule, "type", f"Not of type {rule.type}")))
    if is_text:
        length = F.length(value)
        if rule.min_length is not None:
            message = F.format_string(f"String too short (len %d < min {rule.min_length})", length)
            findings.append(F.when(present & (length < rule.min_length), _finding(rule, "min_length", message)))
        if rule.max_length is not None:
            message = F.format_string(f"String too long (len %d > max {rule.max_length})", length)
            findings.append(F.when(present & (length > rule.max_length), _finding(rule, "max_length", message)))
        if rule.pattern is not None:
            full = rf"\A(?:{rule.pattern})\z"
            findings.append(F.when(present & ~value.rlike(full), _finding(rule, "pattern", "Pattern mismatch")))
    if rule.allowed is not None:
        bad = present & ~value.isin(list(rule.allowed))
        findings.append(F.when(bad, _finding(rule, "allowed", "Value not allowed")))
    return findings


FINDINGS = "row_key string, field string, rule string, message string, severity string"


def validate_field_level(df: DataFrame, rules: Sequence[FieldRule], key: str) -> DataFrame:
    """One row per broken rule, named by the row's business key, from one scan.

    A required column that does not exist gives one finding without a key, unless the frame
    is empty.
    """
    absent = [r for r in rules if r.column not in df.columns]
    checks = [c for r in rules if r.column in df.columns for c in _field_findings(df, r)]
    parts = []
    if checks:
        found = F.array_compact(F.array(*checks))
        parts.append(
            df.select(F.col(key).cast("string").alias("row_key"), F.explode(found).alias("finding")).select(
                "row_key", "finding.*"
            )
        )
    lost = [
        _finding(r, "required", f"Missing required field '{r.column}'") for r in absent if r.required
    ]
    if lost:
        parts.append(df.limit(1).select(F.lit(None).cast("string").alias("row_key"), F.inline(F.array(*lost))))
    return combine(parts) if parts else df.sparkSession.createDataFrame([], FINDINGS)


def validate_list_length(
    df: DataFrame, column: str, key: str, min_length: int | None = None, max_length: int | None = None
) -> DataFrame:
    """Rows whose list is too short or too long. A column that holds no lists has no findings."""
    if column not in df.columns or df.schema[column].dataType.typeName() != "array":
        return df.sparkSession.createDataFrame([], FINDINGS)
    rule = FieldRule(column, min_length=min_length, max_length=max_length)
    length = F.size(column)
    checks = []
    if min_length is not None:
        message = F.format_string(f"Too short (length %d < min_length {min_length})", length)
        checks.append(F.when(length < min_length, _finding(rule, "min_length", message)))
    if max_length is not None:
        message = F.format_string(f"Too long (length %d > max_length {max_length})", length)
        checks.append(F.when(length > max_length, _finding(rule, "max_length", message)))
    found = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<struct<field:string>>")
    lists = df.where(F.col(column).isNotNull())
    return lists.select(F.col(key).cast("string").alias("row_key"), F.explode(found).alias("finding")).select(
        "row_key", "finding.*"
    )


def findings_summary(findings: DataFrame) -> DataFrame:
    """Findings per field, rule and message; the row's own length in a message reads ``n``."""
    message = F.regexp_replace("message", r"\b(len|length) \d+ ", "$1 n ")
    return findings.groupBy("field", "rule", "severity", message.alias("message")).agg(F.count("*").alias("row_count"))


def quality_report_text(findings: DataFrame) -> DataFrame:
    """One row with the report text: a part per field, rule and message, so its size is bounded by the rules."""
    line = F.format_string("Field '%s': [%s] %s (%d rows)", "field", "severity", "message", "row_count")
    lines = findings_summary(findings).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    text = F.concat(F.lit("Data Quality Report "), F.array_join("lines", " "))
    return lines.select(F.when(F.size("lines") == 0, F.lit(NO_ISSUES)).otherwise(text).alias("report"))


def field_quality_gaps(df: DataFrame, required: Mapping[str, tuple[Column | None, float]]) -> DataFrame:
    """Share of good values per field against the required share.

    ``required`` maps a field to (condition for a good value, share); without a condition any
    value that is not missing is good. A field that does not exist has share 0.
    """
    rows = []
    for name, (good, share) in required.items():
        if good is None:
            good = F.trim(as_column(name).cast("string")) != "" if name in df.columns else F.lit(False)
        actual = F.coalesce(ratio(F.count_if(good), F.count("*")), F.lit(0.0))
        rows.append(
            F.struct(F.lit(name).alias("field"), actual.alias("actual"), F.lit(float(share)).alias("required"))
        )
    gaps = df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
    return gaps.withColumn("gap", F.greatest(F.lit(0.0), F.col("required") - F.col("actual")))


# --- run health ----------------------------------------------------------------------------


def run_health(log: DataFrame, sla_seconds: Mapping[str, float], default_sla: float = 3600.0) -> DataFrame:
    """One row per step of a run and one for the whole run (``total``).

    ``log`` has one row per piece of work: ``step``, ``started_at``, ``finished_at``, ``records`` and ``good_records``. A
    step lasts from its first start to its last end; it is late when that exceeds its limit.
    """
    sums = [
        F.min(F.col("started_at").cast("timestamp").cast("double")).alias("began"),
        F.max(F.col("finished_at").cast("timestamp").cast("double")).alias("ended"),
        F.sum("records").alias("records_processed"),
        F.sum("good_records").alias("good"),
    ]
    steps = log.groupBy("step").agg(*sums)
    whole = steps.agg(
        F.lit("total").alias("step"), F.min("began").alias("began"), F.max("ended").alias("ended"),
        F.sum("records_processed").alias("records_processed"), F.sum("good").alias("good"),
    )
    limit = F.lit(float(default_sla))
    for step, seconds in sla_seconds.items():
        limit = F.when(F.col("step") == step, float(seconds)).otherwise(limit)
    duration = F.col("ended") - F.col("began")
    return steps.unionByName(whole).where("records_processed IS NOT NULL").select(
        "step",
        F.round(duration, 3).alias("duration_seconds"),
        "records_processed",
        F.coalesce(ratio(F.col("good"), F.col("records_processed")), F.lit(1.0)).alias("quality_score"),
        limit.alias("sla_seconds"),
        (duration <= limit).alias("sla_met"),
    )
