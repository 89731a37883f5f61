from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ementario.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        app="ementario-tests",
        master="local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Apply a Column function to a list of values, keeping their order."""
    from pyspark.sql import functions as F

    def run(values, fn, kind="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        out = df.select("i", fn(F.col("v")).alias("o")).collect()
        return [r.o for r in sorted(out, key=lambda r: r.i)]

    return run
