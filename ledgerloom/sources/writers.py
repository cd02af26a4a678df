"""Writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import combine
from .readers import ISO_TIMESTAMP


def publish_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), bucket_by: tuple[int, str] | None = None
) -> None:
    """Overwrite a managed table.

    ``bucket_by`` (number, key) stores the rows by key, so that later joins and aggregates of
    tables with the same buckets need no shuffle.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    writer.saveAsTable(name)


def append_table(df: DataFrame, name: str, replace: bool = False) -> None:
    """Append the columns the table has; ``replace`` empties it first. Unknown columns are ignored."""
    spark = df.sparkSession
    target = spark.table(name)
    rows = df.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )
    rows.write.insertInto(name, overwrite=replace)


def replace_period(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Rewrite only the partitions that occur in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header and ISO timestamps. ``single_file`` is for summaries of few rows only."""
    files = df.coalesce(1) if single_file else df
    files.write.mode("overwrite").csv(path, header=True, timestampFormat=ISO_TIMESTAMP)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def register_views(frames: Mapping[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def table_row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    return combine(
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")) for name, df in frames.items()
    )
