from __future__ import annotations

import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def frame(spark):
    """A documents table from (doc_id, text, source) and the like; None ids and texts allowed."""

    def make(rows, schema="doc_id long, text string, source string"):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def folder(spark, tmp_path):
    """Write tables as the queries expect them, over several files, and give the folder."""

    def write(**tables):
        for name, df in tables.items():
            df.repartition(3).write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write
