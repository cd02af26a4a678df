"""Session settings and stage tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# All are runtime SQL settings, so they also apply to a session somebody else started.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join followed by an aggregate on the same key would otherwise keep the join's
    # partitioning and lose the split of a hot key.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings every plan in this package relies on."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = 8, app_name: str = "ledgerloom", checkpoint_dir: str | None = None) -> SparkSession:
    """A local session for tests and the benchmark. On a cluster, use its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        # Plans name their files in full, however long the path.
        .config("spark.sql.maxMetadataStringLength", "2000")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def stage_folder(spark: SparkSession) -> str:
    """The shared folder for this application's stage tables.

    It lies in ``spark.checkpoint.dir``; where that is unset, in the warehouse folder, which
    every executor reaches too. Spark's file system removes it when the session ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    shared = shared or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"
    folder = f"{shared.rstrip('/')}/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def input_state(spark: SparkSession, folder: str) -> str:
    """What tells one state of a folder's tables from another: each file's name, length and time of change."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def listed(where) -> list[str]:
        found = []
        for status in files.listStatus(where):
            found.append(f"{status.getPath().getName()}:{status.getLen()}:{status.getModificationTime()}")
            if status.isDirectory():
                found += listed(status.getPath())
        return sorted(found)

    return "|".join(listed(path))


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Cuts lineage like ``checkpoint()`` but stays columnar, so that each report reading the
    stage still scans only its own columns. The files survive the loss of any executor.
    """
    spark = df.sparkSession
    path = f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stage_buckets(df: DataFrame, name: str, key: str) -> Iterator[DataFrame]:
    """Write ``df`` like ``stage_table``, dealt by ``key`` into as many buckets as a shuffle has partitions.

    Joins on ``key`` read it where it lies, so that only their other side is shuffled, however many joins there are.
    The session's catalog has it by a name of its own while the block runs; its files stay as those of other stages do.
    """
    spark = df.sparkSession
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{stage_folder(spark)}/{table}"
    df.write.mode("errorifexists").format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(table)
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
