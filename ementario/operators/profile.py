"""Column profiles: detected type, longest text, largest number, decimal places.

Values are turned to long form ``column, value`` and aggregated by column. The kind of a
value is a small integer and lengths are numbers, so the aggregation stays in hash
aggregates with map-side partials: a shuffle carries one row per column and task.

``mode="lattice"`` (default) does not depend on row order. ``mode="first_seen"`` gives
what a sequential reader would report and needs a sequence column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ementario.functions.numbers import (
    KIND_BOOL,
    KIND_DATE,
    KIND_FLOAT,
    KIND_INT,
    KIND_STRING,
    decimal_places,
    int_lenient,
    is_date_text,
    kind_name,
    number_or_null,
)
from ementario.functions.text import ws_normalize
from ementario.operators.reports import file_inventory
from ementario.schemas import ID_COLUMN, LONG_FIELDS
from ementario.session import materialize
from ementario.sources.folders import list_folder
from ementario.sources.json_files import PATTERN, parse_items, read_texts

_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.BinaryType)
_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)
_SEQ = "_seq"


def to_long(df: DataFrame, columns: list[str] | None = None, seq: str | None = None) -> DataFrame:
    """``column, value, native[, _seq]`` of the atomic columns; nested ones are skipped.

    ``native`` tells what the schema already knows (number, date or boolean), so values
    of typed columns skip the text tests; it is null for text.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    atomic = [
        c for c in (columns or df.columns) if not isinstance(kinds[c], _NESTED) and c != _SEQ
    ]
    known = {
        KIND_BOOL: [c for c in atomic if isinstance(kinds[c], T.BooleanType)],
        KIND_INT: [c for c in atomic if isinstance(kinds[c], T.NumericType)],
        KIND_DATE: [c for c in atomic if isinstance(kinds[c], _TEMPORAL)],
    }
    native = F.lit(None).cast("int")
    for code, names in known.items():
        if names:
            native = F.when(F.col("column").isin(*names), code).otherwise(native)
    ids = [F.col(seq).alias(_SEQ)] if seq else []
    text = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in atomic])
    long = text.unpivot([_SEQ] if seq else [], atomic, "column", "value")
    return _named(long.withColumn("native", native))


def records_to_long(records: DataFrame, fields: str = "fields", seq: str | None = None) -> DataFrame:
    """The same from records whose keys are a ``map<string, variant>``."""
    ids = [F.col(seq).alias(_SEQ)] if seq else []
    entries = records.select(*ids, F.explode(fields).alias("column", "v")).withColumn(
        "_type", F.schema_of_variant("v")
    )
    kind = F.col("_type")
    atomic = entries.filter(
        ~(F.startswith(kind, F.lit("ARRAY")) | F.startswith(kind, F.lit("OBJECT")))
    )
    number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | F.startswith(kind, F.lit("DECIMAL"))
    return _named(
        atomic.select(
            *([_SEQ] if seq else []),
            "column",
            F.try_variant_get("v", "$", "string").alias("value"),
            F.when(kind == "BOOLEAN", KIND_BOOL).when(number, KIND_INT).alias("native"),
        )
    )


def _named(long: DataFrame) -> DataFrame:
    return long.withColumn(
        "column", F.when(F.col("column") == "id", F.lit(ID_COLUMN)).otherwise(F.col("column"))
    )


def _magnitude(n: Column) -> Column:
    """Absolute value that cannot overflow."""
    lowest = -(2**63)
    return F.when(n == F.lit(lowest), F.lit(2**63 - 1)).otherwise(F.abs(n))


def _clean_values(long: DataFrame) -> DataFrame:
    """Non-null values with ``clean``; only text needs cleaning."""
    value = F.col("value")
    return long.filter(value.isNotNull()).withColumn(
        "clean", F.when(F.col("native").isNull(), ws_normalize(value)).otherwise(value)
    )


def _finite(text: Column) -> Column:
    number = text.try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def _is_long_field() -> Column:
    return F.col("column").isin(*LONG_FIELDS)


def with_declared(profile: DataFrame, declared: tuple[str, ...]) -> DataFrame:
    """The profile with a row for each declared column that no record fills: text of length 0."""
    names = profile.sparkSession.createDataFrame([(c,) for c in declared], "column string")
    unfilled = names.join(profile.select("column"), "column", "left_anti")
    return profile.unionByName(
        unfilled.withColumns({"type": F.lit("string"), "max_len": F.lit(0)}), allowMissingColumns=True
    )


def profile_simple(
    long: DataFrame, mode: str = "lattice", by: tuple[str, ...] = ()
) -> DataFrame:
    """``column, type, max_len, max_val`` with types ``string`` and ``int``.

    Only columns whose name contains ``numero`` or ``id`` are read as numbers. ``by`` adds
    grouping columns of ``long``, such as the table, in front.
    """
    lowered = F.lower("column")
    numeric_name = F.contains(lowered, F.lit("numero")) | F.contains(lowered, F.lit("id"))
    values = _clean_values(long)
    value, native = F.col("value"), F.col("native")
    number = F.when(
        numeric_name,
        F.when(native == KIND_BOOL, (value == "true").cast("bigint"))
        .when(native == KIND_INT, F.coalesce(value.try_cast("bigint"), _finite(value).try_cast("bigint")))
        .otherwise(int_lenient(F.col("clean"))),
    )
    keep = [_SEQ] if mode == "first_seen" else []
    facts = values.select(*by, "column", *keep, F.char_length("clean").alias("len"), number.alias("num"))
    kind = F.when(F.col("num").isNotNull(), KIND_INT).otherwise(KIND_STRING)
    is_string = F.col("num").isNull()

    if mode == "first_seen":
        agg = facts.groupBy(*by, "column").agg(
            F.min_by(kind, _SEQ).alias("kind"),
            F.max(F.when(is_string, F.col("len"))).alias("max_len"),
            F.max(_magnitude(F.col("num"))).alias("max_val"),
        )
    else:
        agg = facts.groupBy(*by, "column").agg(
            F.max(kind).alias("kind"),
            F.max("len").alias("max_len"),
            F.max(_magnitude(F.col("num"))).alias("max_val"),
        )
    code = F.when(_is_long_field(), KIND_STRING).otherwise(F.col("kind"))
    is_text = code == KIND_STRING
    return agg.select(
        *by,
        "column",
        kind_name(code).alias("type"),
        F.when(is_text, F.coalesce("max_len", F.lit(0))).alias("max_len"),
        F.when(~is_text, F.col("max_val")).alias("max_val"),
    )


def _typed_values(long: DataFrame, keep: list[str]) -> DataFrame:
    values = _clean_values(long)
    clean, native = F.col("clean"), F.col("native")
    # Numbers and dates start with a sign, a point or a digit, all between "+" and "9":
    # one byte decides, so long texts are never put through the number patterns.
    readable = native.isNull() & F.left(clean, F.lit(1)).between("+", "9")
    read = values.select(
        *keep,
        "column",
        "native",
        "clean",
        F.when(native == KIND_INT, _finite(clean)).when(readable, number_or_null(clean)).alias("num"),
        F.when(readable, F.contains(clean, F.lit("."))).alias("has_point"),
        F.when(readable, is_date_text(clean)).alias("is_date"),
    )
    num = F.col("num")
    kind = (
        F.when(native == KIND_BOOL, KIND_BOOL)
        .when(native == KIND_DATE, KIND_DATE)
        # A typed number is whole by value, a written one by not having a point.
        .when(num.isNotNull() & (native == KIND_INT), F.when(num == F.floor(num), KIND_INT).otherwise(KIND_FLOAT))
        .when(num.isNotNull(), F.when(F.col("has_point"), KIND_FLOAT).otherwise(KIND_INT))
        .when(F.col("is_date"), KIND_DATE)
        .otherwise(KIND_STRING)
    )
    return read.select(
        *keep, "column", kind.alias("kind"), F.char_length("clean").alias("len"), "num", "clean"
    )


def profile_typed(
    long: DataFrame, mode: str = "lattice", by: tuple[str, ...] = ()
) -> DataFrame:
    """``column, type, max_len, max_val, precision`` with types int, float, date, string, boolean."""
    if mode == "first_seen":
        return _typed_first_seen(long, by)
    return typed_of_states(typed_states(long, by), by)


def typed_states(long: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """What the typed profile needs to know of a set of values, one row per column: states of several sets merge."""
    v = _typed_values(long, list(by))
    kind = F.col("kind")
    return v.groupBy(*by, "column").agg(
        F.max(kind == KIND_DATE).alias("any_date"),
        F.max(kind == KIND_STRING).alias("any_string"),
        F.max(kind == KIND_FLOAT).alias("any_float"),
        F.max(kind == KIND_INT).alias("any_int"),
        F.max(kind == KIND_BOOL).alias("any_bool"),
        F.count("*").alias("n"),
        F.hll_sketch_agg(F.xxhash64("clean")).alias("distinct"),
        F.max("len").alias("len"),
        F.max(F.abs("num")).alias("val"),
        F.max(F.when(kind == KIND_FLOAT, decimal_places(F.col("num")))).alias("places"),
    )


def merged_states(states: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The state of all values, from those of their parts: maxima, a sum and a union of sketches, with map-side partials."""
    rest = [c for c in states.columns if c not in (*by, "column", "n", "distinct")]
    return states.groupBy(*by, "column").agg(
        F.sum("n").alias("n"), F.hll_union_agg("distinct").alias("distinct"), *(F.max(c).alias(c) for c in rest)
    )


def store_profile(long: DataFrame, path: str, load_id: int, by: tuple[str, ...] = ()) -> None:
    """Keep the state of one load's values; a repeated load replaces its own."""
    typed_states(long, by).write.mode("overwrite").parquet(f"{path}/load_id={load_id}")


def stored_profile(spark: SparkSession, path: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The typed profile of all loads kept below ``path``, with ``n`` values and about ``n_distinct`` different ones. Their
    values are not read again."""
    states = merged_states(spark.read.parquet(path).drop("load_id"), by)
    counts = states.select(*by, "column", "n", F.hll_sketch_estimate("distinct").alias("n_distinct"))
    return typed_of_states(states, by).join(counts, [*by, "column"])


def typed_of_states(agg: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The typed profile that states stand for."""
    code = (
        F.when(_is_long_field(), KIND_STRING)
        .when(F.col("any_date"), KIND_DATE)
        .when(F.col("any_string"), KIND_STRING)
        .when(F.col("any_bool") & (F.col("any_float") | F.col("any_int")), KIND_STRING)
        .when(F.col("any_float"), KIND_FLOAT)
        .when(F.col("any_int"), KIND_INT)
        .otherwise(KIND_BOOL)
    )
    return _typed_output(agg.withColumn("code", code), by)


def _typed_output(agg: DataFrame, by: tuple[str, ...]) -> DataFrame:
    code = F.col("code")
    numeric = code.isin(KIND_INT, KIND_FLOAT)
    return agg.select(
        *by,
        "column",
        kind_name(code).alias("type"),
        F.when(code == KIND_STRING, F.coalesce("len", F.lit(0))).alias("max_len"),
        F.when(numeric, F.col("val")).alias("max_val"),
        F.when(code == KIND_FLOAT, F.coalesce("places", F.lit(0))).alias("precision"),
    )


def _typed_first_seen(long: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Two passes: what each column locks to, then the values counted under that lock.

    A date anywhere wins. Otherwise the first value decides between text and number; a
    float turns an int column into float, after which ints no longer count.
    """
    v = _typed_values(long, [*by, _SEQ]).withColumn(
        # Sequential readers take a boolean for the integer 0 or 1.
        "num", F.when(F.col("kind") == KIND_BOOL, (F.col("clean") == "true").cast("double"))
        .otherwise(F.col("num"))
    ).withColumn(
        "kind", F.when(F.col("kind") == KIND_BOOL, KIND_INT).otherwise(F.col("kind"))
    )
    kind = F.col("kind")
    lock = v.groupBy(*by, "column").agg(
        F.max(kind == KIND_DATE).alias("any_date"),
        F.min_by(kind, _SEQ).alias("first_kind"),
        F.min(F.when(kind == KIND_FLOAT, F.col(_SEQ))).alias("float_seq"),
    )
    # One row per column, joined to every value. Written out first, its size is known when
    # the join is planned, so it is broadcast unless there are very many columns; otherwise
    # all values would be shuffled to a handful of hot keys.
    lock = materialize(lock, "profile-lock")
    counted_int = (kind == KIND_INT) & (
        F.col("float_seq").isNull() | (F.col(_SEQ) < F.col("float_seq"))
    )
    # A float from 1e16 up prints without a point and is not counted.
    counted_float = (kind == KIND_FLOAT) & (F.abs("num") < 1e16)
    agg = (
        v.drop("clean")
        .join(lock, [*by, "column"])
        .groupBy(*by, "column", "any_date", "first_kind", "float_seq")
        .agg(
            F.max(F.when(kind == KIND_STRING, F.col("len"))).alias("len"),
            F.max(F.when(counted_int | counted_float, F.abs("num"))).alias("val"),
            F.max(F.when(counted_float, decimal_places(F.col("num")))).alias("places"),
        )
    )
    code = (
        F.when(_is_long_field(), KIND_STRING)
        .when(F.col("any_date"), KIND_DATE)
        .when(F.col("first_kind") == KIND_STRING, KIND_STRING)
        .when(F.col("float_seq").isNotNull(), KIND_FLOAT)
        .otherwise(KIND_INT)
    )
    # Long fields are never measured by the sequential reader.
    return _typed_output(
        agg.withColumn("code", code).withColumn("len", F.when(~_is_long_field(), F.col("len"))),
        by,
    )


def profile_files(
    spark: SparkSession, folder: str, typed: bool = False, pattern: str = PATTERN
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(inventory, profile, rejects)`` of a folder of record files.

    The files are parsed once. Columns are those that any record has, and the long fields always; ``inventory`` counts
    the records, the files and the folders that hold files or lead to them. ``operators.sizing`` makes column types of
    the profile.
    """
    parsed = materialize(parse_items(read_texts(spark, folder, folder, pattern)), "profile-files")
    records = parsed.filter(F.col("reason").isNull()).select("rel_path", F.explode("items").alias("fields"))
    long = records_to_long(records)
    profile = profile_typed(long) if typed else profile_simple(long)
    inventory = file_inventory(list_folder(spark, folder, pattern), records)
    rejects = parsed.filter(F.col("reason").isNotNull()).select("rel_path", "reason")
    return inventory, with_declared(profile, LONG_FIELDS), rejects
