"""Reading extracts without losing rows: what can't be used is set aside with its reason, and all rows are counted in the same pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conditions import case_bucket
from .readers import as_schema, text_schema, typed_rows, with_key

KEPT, QUARANTINED = "kept", "quarantined"
_BROKEN = "_corrupt_record"


@dataclass(frozen=True)
class Intake:
    """``kept`` typed rows, ``quarantined`` rows (``reject_reason`` and the fields as text), and how many rows were read and went where."""

    kept: DataFrame
    quarantined: DataFrame
    rows_read: int
    rows_kept: int
    rows_quarantined: int


def take_in(
    raw: DataFrame,
    schema: T.StructType | str,
    key: str,
    place: str,
    lower: Sequence[str] = (),
    defaults: Mapping[str, str] | None = None,
    warnings: Sequence[tuple[Column, str]] = (),
    rejects: Sequence[tuple[Column, str]] = (),
) -> Intake:
    """Convert the text fields of ``raw`` as ``read_csv_trimmed`` does and write the rows to the folder ``place``, by outcome.

    Quarantined are broken lines (``_corrupt_record``, where ``raw`` has it), rows without a key, then rows for which a condition
    of ``rejects`` on the converted columns holds; the first reason counts. Rows are counted while they are written, so
    the source is read once, and every row read is in one of the two results. An empty source gives two empty results.
    """
    fields = as_schema(schema)
    texts = [f.name for f in fields.fields]
    line = F.col(_BROKEN) if _BROKEN in raw.columns else F.lit(None).cast("string")
    carried = raw.withColumn("_line", line).withColumn("_raw", F.struct(*texts))
    typed = typed_rows(carried, fields, lower, defaults or {}, warnings, keep=["_line", "_raw"])
    reason = case_bucket([(F.col("_line").isNotNull(), "broken line"), (~with_key(key), "missing key"), *rejects])
    judged = typed.withColumn("reject_reason", reason)
    usable = F.col("reject_reason").isNull()
    names = [c for c in typed.columns if c not in ("_line", "_raw")]
    rows = judged.select(
        F.when(usable, F.struct(*names)).alias("row"),
        F.when(~usable, F.struct(F.col("_raw").alias("fields"), F.col("_line").alias("line"))).alias("raw"),
        "reject_reason",
        F.when(usable, KEPT).otherwise(QUARANTINED).alias("outcome"),
    )
    seen = Observation()
    counted = rows.observe(
        seen, F.count("*").alias("rows_read"), F.count_if(usable).alias("rows_kept"), F.count_if(~usable).alias("rows_quarantined")
    )
    counted.write.partitionBy("outcome").parquet(place)
    stored = raw.sparkSession.read.schema(rows.schema).parquet(place)
    kept = stored.where(F.col("outcome") == KEPT).select("row.*")
    aside = stored.where(F.col("outcome") == QUARANTINED).select("raw.fields.*", F.col("raw.line").alias("line"), "reject_reason")
    return Intake(kept, aside, **seen.get)


def take_in_csv(spark: SparkSession, path: str, schema: T.StructType | str, key: str, place: str, **options) -> Intake:
    """``take_in`` of CSV files with a header. A line of too many or too few fields is broken."""
    texts = text_schema(as_schema(schema)).add(_BROKEN, T.StringType())
    raw = spark.read.schema(texts).csv(path, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_BROKEN)
    return take_in(raw, schema, key, place, **options)


def take_in_json_array(spark: SparkSession, path: str, schema: T.StructType | str, key: str, place: str, **options) -> Intake:
    """``take_in`` of files that each hold one JSON array. A file that is no JSON is one broken row."""
    texts = text_schema(as_schema(schema)).add(_BROKEN, T.StringType())
    raw = spark.read.schema(texts).json(path, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_BROKEN)
    return take_in(raw, schema, key, place, **options)
