"""Table layout: create, drop, and change columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ementario.schemas import BUCKET, DIM_PARTITION


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def drop_column(df: DataFrame, name: str) -> DataFrame:
    return df.drop(name)


def add_nullable(df: DataFrame, name: str, type_name: str = "string") -> DataFrame:
    return df.withColumn(name, F.lit(None).cast(type_name))


def create_if_missing(spark: SparkSession, name: str, layout: T.StructType) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layout.fields)
    partitions = [c for c in (DIM_PARTITION, BUCKET) if c in layout.names]
    by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{by}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def recreate(spark: SparkSession, layouts: dict[str, T.StructType]) -> None:
    """Drop in reverse order (dimensions before the fact they refer to), then create."""
    for name in reversed(list(layouts)):
        drop_table(spark, name)
    for name, layout in layouts.items():
        create_if_missing(spark, name, layout)


def append_rows(df: DataFrame, path: str) -> None:
    """Append to a staging folder. Files show up only when the whole job has committed."""
    df.write.mode("append").parquet(path)
