"""Table readers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ementario.sources.texts import PLACE, read_texts, store_texts

#: Text in a range of a sort, about, and the most text that is sent whole to every executor.
RANGE_BYTES = LOOKUP_BYTES = 128 << 20


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_if_any(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet rows below ``path``, none where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def spread(scan: DataFrame) -> DataFrame:
    """Deal a scan's rows out to all cores when it has fewer splits than there are cores.

    For work that is heavy per row over a few small files. A scan with enough splits, as
    any large one has, is returned as it is and pays no shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def schema_probe(df: DataFrame) -> list[str]:
    """Column names without reading data."""
    return df.schema.names


def ordered_projection(
    df: DataFrame, columns: list[str], key: str, texts: DataFrame | None = None, on: Column | None = None
) -> DataFrame:
    """``columns`` in the order of ``key``.

    Columns that rows take from another table (``texts``, by a left join ``on``) are left out of the shuffle: rows are dealt
    to ranges of the key while they are narrow and take their texts there. A range holds about ``RANGE_BYTES`` of text, so
    it is sorted in memory. Texts too large to be sent to every executor are stored once and read by the ranges, in pieces; those
    that ``on`` compares have to be joined before the sort.
    """
    if texts is not None:
        wide = [f.name for f in texts.schema.fields if isinstance(f.dataType, T.StringType)]
        strings = [F.coalesce(F.octet_length(c), F.lit(0)) for c in wide]
        size = texts.agg(F.count("*").alias("n"), F.sum(sum(strings, F.lit(0)).cast("long")).alias("bytes")).first()
        cores = df.sparkSession.sparkContext.defaultParallelism
        small = (size.bytes or 0) <= LOOKUP_BYTES
        wide = [c for c in wide if c in columns and c not in df.columns]
        apart = not small and wide and _resolves(df, texts.drop(*wide), on)
        if small or apart:
            ranges = max(cores, df.count() * (size.bytes or 0) // max(1, size.n) // RANGE_BYTES + 1)
        if apart:
            places, folder = store_texts(texts, wide)
            rows = df.join(places, on, "left").select(*dict.fromkeys([key, *(c for c in columns if c not in wide)]), PLACE)
            return read_texts(rows.repartitionByRange(ranges, key).sortWithinPartitions(key), wide, folder).select(*columns)
        if small:
            df, texts = df.repartitionByRange(ranges, key), F.broadcast(texts)
        df = df.join(texts, on, "left")
    return df.select(*columns).orderBy(key)


def _resolves(df: DataFrame, other: DataFrame, on: Column) -> bool:
    try:
        return bool(df.join(other, on, "left").columns)
    except AnalysisException:
        return False


def preview(df: DataFrame, key: str, n: int = 100) -> DataFrame:
    """The first ``n`` rows by key."""
    return df.orderBy(key).limit(n)


def jdbc_options(
    url: str, table: str, key: str, lower: int, upper: int, partitions: int, fetch: int = 1000
) -> dict[str, str]:
    """Options for a scan split by key ranges, so no single task reads the whole table."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch),
    }


def read_jdbc(spark: SparkSession, options: dict[str, str], schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.format("jdbc").options(**options)
    return (reader.option("customSchema", schema.toDDL()) if schema else reader).load()
