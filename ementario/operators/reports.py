"""Counting reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table; Parquet answers this from footers."""
    parts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def group_count(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key, most frequent first, ties by key."""
    return (
        df.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *keys)
    )


def count_where(df: DataFrame, predicate: Column) -> DataFrame:
    return df.filter(predicate).agg(F.count("*").alias("n"))


def inventory_stats(df: DataFrame, folder: Column, file: Column) -> DataFrame:
    """Records, files and folders. Rows are counted per file first, so the distinct
    counts run over files instead of records. The root folder counts too, once, whether it holds files or not: its
    name is null or empty."""
    per_file = df.groupBy(folder.alias("folder"), file.alias("file")).agg(F.count("*").alias("rows"))
    per_folder = per_file.groupBy("folder").agg(
        F.sum("rows").alias("rows"), F.count("*").alias("files")
    )
    return per_folder.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("files"), F.lit(0)).alias("n_files"),
        (F.count(F.nullif("folder", F.lit(""))) + 1).alias("n_folders"),
    )


def file_inventory(files: DataFrame, records: DataFrame) -> DataFrame:
    """``n_rows, n_files, n_folders`` of record files (``rel_path``) and their records. Folders are the root and all that
    lead to a file; Spark lists files, so a folder without any is not seen."""
    parts = F.split("rel_path", "/")
    above = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n - 1), "/")
    )
    folders = files.select(F.explode(above).alias("folder")).distinct().filter("folder <> ''")
    counts = [
        records.agg(F.count("*").alias("n_rows")), files.agg(F.count("*").alias("n_files")),
        folders.agg((F.count("*") + 1).alias("n_folders")),
    ]
    one = reduce(lambda a, b: a.withColumn("_1", F.lit(1)).join(b.withColumn("_1", F.lit(1)), "_1").drop("_1"), counts)
    return one
