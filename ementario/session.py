"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# AQE decides partition counts, join strategy and skew splits at run time, so these
# hold from a laptop to a cluster; only the upper bound of shuffle partitions is sized
# by the caller.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot never compiles methods above 8000 bytes. Wide projections full of patterns
    # exceed that as one generated loop, so they run per operator, in small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "ementario", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    ``spark.checkpoint.dir`` is used as given. Where it is unset, a temporary folder is
    set for local masters (tests); on a cluster that would lose data with the machine,
    so it is an error.
    """
    context = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ementario-"))
    return context.getCheckpointDir().rstrip("/")


_RUN: ContextVar[str] = ContextVar("ementario_run", default="")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused, so re-runs cannot mix."""
    return f"{shared_dir(spark)}/ementario/{_RUN.get()}{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """A run whose scratch folders are removed when it ends: write its result elsewhere before.

    All that is materialized inside the block goes below one folder of its own, and only that folder is removed.
    """
    run = f"run-{uuid.uuid4().hex}"
    token = _RUN.set(f"{run}/")
    folder = f"{shared_dir(spark)}/ementario/{run}"
    try:
        yield folder
    finally:
        _RUN.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write a result to the shared folder and read it back.

    For results that several later steps read: they are computed once, and a lost
    executor costs a re-read, not a recomputation. ``codec`` is for wide ones; unset, the session's is taken.
    """
    path = scratch_path(df.sparkSession, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
