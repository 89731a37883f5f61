"""Which files a load has already taken, and which load that was.

The manifest is a Parquet table of relative paths. It is written only after the data of
the same load is committed, so a crash repeats files rather than losing them.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = "rel_path string, load_id bigint"


def read_manifest(spark: SparkSession, path: str | None) -> DataFrame:
    """Distinct processed paths; empty when there is no manifest yet."""
    empty = spark.createDataFrame([], MANIFEST_SCHEMA)
    if path is None:
        return empty
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(path).distinct()
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return empty
        raise


def pending(files: DataFrame, manifest: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows of ``files`` whose key is not in the manifest.

    No broadcast hint: Spark picks one by the manifest's size, and sorts and merges when
    the manifest has outgrown it.
    """
    keys = keys or ["rel_path"]
    return files.join(manifest.select(*keys), keys, "left_anti")


def append_manifest(paths: DataFrame, path: str, load_id: int | None = None) -> None:
    rows = paths.select("rel_path").distinct().withColumn("load_id", F.lit(load_id).cast("bigint"))
    rows.write.mode("append").parquet(path)


def next_load(manifest: DataFrame, asked: int | None = None) -> int:
    """The number for a new set of files: one that no file in the manifest has.

    A load that died before its manifest entry has left its number free, so its repetition overwrites it.
    """
    if asked is None:
        return (manifest.agg(F.max("load_id")).first()[0] or 0) + 1
    if not manifest.filter(F.col("load_id") == asked).isEmpty():
        raise ValueError(f"load {asked} holds other files")
    return asked
