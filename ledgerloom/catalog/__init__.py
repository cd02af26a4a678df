"""Named queries over the TPC-H-like tables, each with its SQL twin for comparison.

A role module maps the given tables to the frames a report expects, once as a DataFrame and
once as SQL; the query modules pair each report with SQL written on its own.
"""

from __future__ import annotations

from collections.abc import Callable
from threading import RLock

from pyspark.sql import DataFrame, SparkSession

from ..session import input_state

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Stages:
    """Results that several queries share, by application, folder, state of the folder and name."""

    def __init__(self) -> None:
        self._made: dict[tuple, object] = {}
        # One stage is built on another by the same thread; other threads wait for it.
        self._lock = RLock()

    def get(self, spark: SparkSession, folder: str, name: str, build: Callable[[], object]):
        key = (spark.sparkContext.applicationId, folder, input_state(spark, folder), name)
        with self._lock:
            if key not in self._made:
                self._made[key] = build()
            return self._made[key]


def r2(expression: str, digits: int = 2) -> str:
    """SQL for rounding half up on the decimal value."""
    return f"CAST(round(CAST({expression} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def dsum(expression: str, digits: int = 4) -> str:
    """SQL for an exact sum, shown as a double."""
    return f"CAST(sum(CAST({expression} AS DECIMAL(18,{digits}))) AS DOUBLE)"


def davg(expression: str, digits: int = 4) -> str:
    return f"({dsum(expression, digits)} / count({expression}))"


def metric_rows(source: str, metrics: list[tuple[str, str, str]], kind: bool = True) -> str:
    """SQL that turns a one-row query into metric rows."""
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS metric_name, CAST({value} AS DOUBLE) AS metric_value"
        + (f", '{unit}' AS metric_type" if kind else "")
        + " FROM one_row"
        for name, value, unit in metrics
    )
    return f"SELECT * FROM (WITH one_row AS ({source}) {rows})"
