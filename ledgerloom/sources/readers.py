"""Readers. Every file reader takes an explicit schema: no second pass to guess one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import safe_double, safe_int
from ..functions.text import strip
from ..operators.quality import row_warnings

ISO_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss"


def read_csv_source(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, timestampFormat=ISO_TIMESTAMP)


def _typed(c: str, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.DoubleType):
        return safe_double(c)
    if isinstance(data_type, T.IntegerType):
        return safe_int(c)
    if isinstance(data_type, T.StringType):
        return F.coalesce(strip(c), F.lit(""))
    return strip(c).try_cast(data_type)


def as_schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def with_key(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string") != "", F.lit(False))


def typed_rows(
    raw: DataFrame,
    schema: T.StructType,
    lower: Sequence[str],
    defaults: Mapping[str, str],
    warnings: Sequence[tuple[Column, str]],
    keep: Sequence[str] = (),
) -> DataFrame:
    """The text fields of ``raw`` converted to ``schema``, with ``dq_flags`` where there are warnings; ``keep`` stays as it is."""
    columns = {}
    for f in schema.fields:
        value = _typed(f.name, f.dataType)
        if f.name in defaults:
            value = F.coalesce(strip(f.name), F.lit(defaults[f.name]))
        columns[f.name] = F.lower(value) if f.name in lower else value
    typed = raw.select(*[value.alias(name) for name, value in columns.items()], *keep)
    return typed.withColumn("dq_flags", row_warnings(warnings)) if warnings else typed


def _trimmed(
    raw: DataFrame,
    schema: T.StructType,
    key: str,
    lower: Sequence[str],
    defaults: Mapping[str, str],
    warnings: Sequence[tuple[Column, str]],
) -> DataFrame:
    return typed_rows(raw, schema, lower, defaults, warnings).where(with_key(key))


def text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def read_csv_trimmed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    key: str,
    lower: Sequence[str] = (),
    warnings: Sequence[tuple[Column, str]] = (),
) -> DataFrame:
    """CSV with every field trimmed and converted to its declared type. Rows without a key are dropped;
    ``intake.take_in_csv`` keeps them apart and counts them.

    What is no double or int reads 0, what is no value of another type reads NULL. Warnings end up in
    ``dq_flags``; the rows stay.
    """
    schema = as_schema(schema)
    raw = spark.read.schema(text_schema(schema)).csv(path, header=True)
    return _trimmed(raw, schema, key, lower, {}, warnings)


def read_json_array(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    key: str,
    defaults: Mapping[str, str] | None = None,
    warnings: Sequence[tuple[Column, str]] = (),
) -> DataFrame:
    """Files that each hold one JSON array of objects.

    Such a file cannot be split, so one task reads each; ship large extracts as many files or
    as JSON lines (``read_document_collection``). A broken file fails the read.
    """
    schema = as_schema(schema)
    raw = spark.read.schema(text_schema(schema)).json(path, multiLine=True, mode="FAILFAST")
    return _trimmed(raw, schema, key, (), defaults or {}, warnings)


def read_document_collection(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Exported documents, one JSON object per line, with array fields."""
    return spark.read.schema(schema).json(path)


RULE_SCHEMA = (
    "rule_id string, rule_name string, priority string, active boolean, is_active boolean, "
    "thresholds struct<risk_score:int>, _corrupt_record string"
)

# The rules in force when no rule file can be read.
DEFAULT_RULES = [
    ("HIGH_AMOUNT_SINGLE", "High Amount Single Transaction", "HIGH", 75, True),
    ("VELOCITY_MULTIPLE_TRANSACTIONS", "Transaction Velocity Check", "MEDIUM", 60, True),
    ("MERCHANT_CATEGORY_RISK", "High Risk Merchant Categories", "MEDIUM", 50, True),
]


def read_jsonl_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules, one JSON object per line. Blank and broken lines are skipped.

    Without a file the default rules apply; ``rules_from`` tells which they are. Any other failure is one.
    """
    try:
        raw = spark.read.schema(RULE_SCHEMA).json(path, mode="PERMISSIVE")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        defaults = spark.createDataFrame(
            DEFAULT_RULES, "rule_id string, rule_name string, priority string, risk_score int, active boolean"
        )
        return defaults.withColumn("rules_from", F.lit("default"))
    return raw.where("_corrupt_record is null").select(
        "rule_id",
        "rule_name",
        "priority",
        F.col("thresholds.risk_score").alias("risk_score"),
        F.coalesce("active", "is_active").alias("active"),
        F.lit("file").alias("rules_from"),
    )


def read_jdbc_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A relational table. For a parallel read pass ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions``."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A published table; fails at once, with a hint, when it is not there."""
    if not spark.catalog.tableExists(name):
        raise LookupError(f"table {name} does not exist: run the stage that publishes it first")
    return spark.table(name)
