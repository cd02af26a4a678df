"""States per day of a partitioned table, kept beside it: only the days that changed are read again."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import input_state

MANIFEST = "manifest"
_MANIFEST_SCHEMA = "partition string, state string, batch string"


@dataclass(frozen=True)
class DayPartitions:
    """A parquet table with one folder per day, ``<path>/<day column>=<value>``. ``schema`` holds all columns."""

    spark: SparkSession
    path: str
    day: str
    schema: T.StructType

    def states(self, version: str) -> dict[str, str]:
        """Per partition folder, what tells one state of its files from another. Metadata only, one entry per day."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(where) if s.isDirectory()]
        return {
            name: f"{version}|{input_state(self.spark, f'{self.path}/{name}')}" for name in names if name.startswith(f"{self.day}=")
        }

    def rows(self, partitions: list[str]) -> DataFrame:
        reader = self.spark.read.schema(self.schema).option("basePath", self.path)
        return reader.parquet(*[f"{self.path}/{name}" for name in partitions])


@dataclass(frozen=True)
class DayStates:
    """``kinds`` maps a name to the aggregate that makes its states from rows of some days; each groups by the day, so that
    states of different days never mix. A changed ``version`` makes all days anew.

    A refresh writes the states of new and changed days to a new batch folder, then the manifest, which tells the batch that
    holds each day. A day that is gone or was read again is no longer in the manifest under its old batch, so its old
    states don't count. A run that is lost before it writes the manifest leaves the earlier one, and its days are read again.
    """

    kinds: Mapping[str, Callable[[DataFrame], DataFrame]]
    version: str = ""

    def refresh(self, table: DayPartitions, store: str) -> list[str]:
        """The partitions that were read."""
        now = table.states(self.version)
        latest = _latest(table.spark, store)
        known = {r.partition: r for r in _manifest(table.spark, latest).collect()} if latest else {}
        changed = sorted(name for name, state in now.items() if name not in known or known[name].state != state)
        if latest and not changed and known.keys() == now.keys():
            return []
        batch = uuid.uuid4().hex
        # Without a day the kinds still have their columns.
        rows = table.rows(changed) if changed else table.spark.createDataFrame([], table.schema)
        for kind, build in self.kinds.items():
            states = build(rows).withColumn("partition", _folder(table.day))
            states.write.parquet(f"{store}/{kind}/{batch}")
        entries = [(name, state, batch if name in changed else known[name].batch) for name, state in now.items()]
        number = int(latest.rsplit("-", 1)[1]) + 1 if latest else 1
        listed = table.spark.createDataFrame(entries, _MANIFEST_SCHEMA).coalesce(1)
        listed.write.parquet(f"{store}/{MANIFEST}-{number:08d}")
        return changed

    def read(self, spark: SparkSession, store: str) -> dict[str, DataFrame]:
        """Per kind the states of the days that the manifest lists."""
        latest = _latest(spark, store)
        if not latest:
            raise LookupError(f"no states in {store}: refresh them first")
        current = _manifest(spark, latest).select("partition", "batch")
        batches = sorted({r.batch for r in current.select("batch").distinct().collect()}) or _batches(spark, store, self.kinds)
        found = {}
        for kind in self.kinds:
            files = spark.read.parquet(*[f"{store}/{kind}/{batch}" for batch in batches])
            batch = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
            found[kind] = files.withColumn("batch", batch).join(current, ["partition", "batch"], "left_semi").drop("partition", "batch")
        return found


def _folder(day: str):
    value = F.coalesce(F.col(day).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    return F.concat(F.lit(f"{day}="), value)


def _names(spark: SparkSession, folder: str) -> list[str]:
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def _latest(spark: SparkSession, store: str) -> str | None:
    """The newest manifest that was written whole."""
    written = [n for n in _names(spark, store) if n.startswith(f"{MANIFEST}-") and "_SUCCESS" in _names(spark, f"{store}/{n}")]
    return f"{store}/{written[-1]}" if written else None


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_MANIFEST_SCHEMA).parquet(path)


def _batches(spark: SparkSession, store: str, kinds: Mapping[str, object]) -> list[str]:
    return _names(spark, f"{store}/{next(iter(kinds))}")
