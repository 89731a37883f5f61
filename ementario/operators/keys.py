"""Surrogate keys, and the keys that dynamic records carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ementario.schemas import ID_COLUMN


def hashed_key(*columns: str) -> Column:
    """A key that needs no shuffle; the same natural key always gets the same value."""
    return F.xxhash64(*columns)


def dense_keys(df: DataFrame, keys: list[str], name: str, hex_digits: int = 3) -> DataFrame:
    """Number distinct natural keys 1..n without one global sort.

    Keys are hashed into ``16 ** hex_digits`` buckets, numbered inside their bucket and
    shifted by the size of the buckets before it. Only the bucket sizes, a table of fixed
    length, meet in one task. Keys must be distinct, so no bucket can be hot; raise
    ``hex_digits`` with the data.
    """
    joined = F.concat_ws("\x1f", *[F.col(k).cast("string") for k in keys])
    rows = df.withColumn("_bucket", F.substring(F.md5(joined), 1, hex_digits))
    sizes = rows.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    # By the keys themselves: null and empty parts, or parts that hold the separator, must not tie.
    inside = Window.partitionBy("_bucket").orderBy(*keys)
    return (
        rows.withColumn("_rn", F.row_number().over(inside))
        .join(offsets, "_bucket")
        .withColumn(name, (F.col("_offset") + F.col("_rn")).cast("bigint"))
        .drop("_bucket", "_offset", "_rn")
    )


def _source_key(key: Column) -> Column:
    return F.when(key == "id", F.lit(ID_COLUMN)).otherwise(key)


def key_discovery(df: DataFrame, keys: Column) -> DataFrame:
    """Every key ever seen and in how many records; ``id`` counts as the natural id."""
    return (
        df.select(F.explode(F.array_distinct(F.transform(keys, _source_key))).alias("key"))
        .groupBy("key")
        .agg(F.count("*").alias("n"))
    )


def keyset_signatures(df: DataFrame, keys: Column) -> DataFrame:
    """Distinct key sets and how many records have each."""
    return (
        df.select(F.array_join(F.array_sort(F.array_distinct(keys)), ",").alias("signature"))
        .groupBy("signature")
        .agg(F.count("*").alias("n"))
    )
