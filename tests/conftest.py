from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "ledgerloom-tests", str(tmp_path_factory.mktemp("shared")))
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate one expression over a list of texts."""

    def run(expression, texts, data_type="string"):
        df = spark.createDataFrame(list(enumerate(texts)), f"i int, x {data_type}")
        return [row.y for row in df.select("i", expression("x").alias("y")).orderBy("i").collect()]

    return run
