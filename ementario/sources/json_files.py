"""Record files: a JSON list of objects or one object per ``*.json`` file.

A file is read whole and must be one JSON value and nothing else. Text after the value, JSON lines, single
quotes and empty files make it malformed; such files are put aside instead of failing or losing records.
:func:`read_records` gives typed columns for loading, :func:`read_dynamic` keeps every key it
meets, for profiling and key discovery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ementario.functions.json_values import one_value
from ementario.functions.urls import relative_path
from ementario.schemas import ID_COLUMN, ID_KEYS, SOURCE

PATTERN = "*.json"
MALFORMED, SHAPE = "malformed_json", "invalid_shape"


def _json_reader(spark: SparkSession, pattern: str = PATTERN) -> DataFrameReader:
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)


def read_texts(spark: SparkSession, paths: str | list[str], base: str, pattern: str = PATTERN) -> DataFrame:
    """``rel_path, text``, one row per file that is not empty."""
    raw = _json_reader(spark, pattern).text(paths, wholetext=True)
    return raw.select(relative_path(F.col("_metadata.file_path"), base).alias("rel_path"), F.col("value").alias("text"))


def parse_items(texts: DataFrame, kind: str = "variant") -> DataFrame:
    """``rel_path, items, reason`` of each file: its records as maps in file order, or why it has none."""
    def read(shape: str, items) -> Column:
        value = F.array(one_value(F.col("text"), shape))
        return F.transform(value, lambda r: F.struct(items(r["value"]).alias("items"), r["whole"].alias("whole")))[0]

    one = read(f"map<string,{kind}>", lambda v: F.array(v))
    many = read(f"array<map<string,{kind}>>", lambda v: v)
    is_object = F.startswith(F.ltrim(F.col("text"), F.lit(" \t\r\n")), F.lit("{"))
    parsed = texts.withColumn("_p", F.when(is_object, one).otherwise(many))
    fits = F.col("_p.items").isNotNull() & ~F.exists("_p.items", lambda m: m.isNull())
    reason = F.when(~F.coalesce("_p.whole", F.lit(False)), MALFORMED).when(~fits, SHAPE)
    return parsed.select("rel_path", F.when(reason.isNull(), F.col("_p.items")).alias("items"), reason.alias("reason"))


def parse_texts(texts: DataFrame, kind: str = "variant") -> tuple[DataFrame, DataFrame]:
    """Split ``(rel_path, text)`` files into dynamic records and rejects.

    ``records`` is ``rel_path, pos, fields``, where ``fields`` maps every key to a variant.
    """
    parsed = parse_items(texts, kind)
    records = parsed.filter(F.col("reason").isNull()).select("rel_path", F.posexplode("items").alias("pos", "fields"))
    return records, parsed.filter(F.col("reason").isNotNull()).select("rel_path", "reason")


def record_id(fields: Column, keys: tuple[str, ...] = ID_KEYS) -> Column:
    """The id entry of a record with dynamic keys, in any case: the last matching key wins."""
    hits = F.filter(F.map_entries(fields), lambda e: F.lower(e["key"]).isin(*keys) | (e["key"] == ID_COLUMN))
    return F.try_element_at(hits, F.lit(-1))["value"]


def typed_fields(schema: T.StructType = SOURCE) -> list[Column]:
    """Columns of a record held as ``fields`` (text by key). The id keys of the schema become one ``id_origem``."""
    names = [f for f in schema.fields if f.name.lower() not in ID_KEYS]
    own = [F.col("fields")[f.name].try_cast(f.dataType).alias(f.name) for f in names]
    return own if len(names) == len(schema.fields) else [record_id(F.col("fields")).alias(ID_COLUMN), *own]


def read_records(
    spark: SparkSession,
    paths: str | list[str],
    base: str,
    schema: T.StructType = SOURCE,
    pattern: str = PATTERN,
) -> tuple[DataFrame, DataFrame]:
    """``(records, rejects)`` of all files under ``paths``.

    ``records`` has the schema's columns, the id under one name, and ``rel_path``; ``rejects`` has one row
    ``rel_path, reason`` per unreadable file.
    """
    records, rejects = parse_texts(read_texts(spark, paths, base, pattern), "string")
    return records.select(*typed_fields(schema), "rel_path"), rejects


def read_dynamic(
    spark: SparkSession, paths: str | list[str], base: str, pattern: str = PATTERN
) -> tuple[DataFrame, DataFrame]:
    return parse_texts(read_texts(spark, paths, base, pattern))
