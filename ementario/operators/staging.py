"""Source records -> staging rows: key names, cleaning, dates, widths, required fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ementario.functions.dates import apply_date_fields
from ementario.functions.text import (
    clean_array_if_text,
    clean_json_array,
    load_limits,
    truncate_columns,
    ws_normalize,
)
from ementario.schemas import (
    ARRAY_FIELDS,
    DATE_FIELDS,
    ID_COLUMN,
    ID_KEYS,
    LONG_FIELDS,
    REQUIRED_FIELDS,
    STAGING_WIDTHS,
)
from ementario.session import materialize
from ementario.sources.folders import list_folder, open_files
from ementario.sources.json_files import (
    PATTERN,
    parse_items,
    read_texts,
    record_id,
    typed_fields,
)
from ementario.sources.manifest import append_manifest, next_load, pending, read_manifest

rename_map_key = record_id

#: Columns that say where a row comes from, and why it was put aside; they are not cleaned.
PLACE = ("rel_path", "pos", "reason", "record")


def rename_key(df: DataFrame, to: str = ID_COLUMN, keys: tuple[str, ...] = ID_KEYS) -> DataFrame:
    """Merge the id columns, in any case, into one; the rightmost non-null value wins."""
    hits = [c for c in df.columns if c.lower() in keys or c == to]
    if not hits:
        return df
    rest = [c for c in df.columns if c not in hits]
    return df.select(F.coalesce(*[F.col(c) for c in reversed(hits)]).alias(to), *rest)


def clean_fields(df: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """Clean strings and arrays of strings, whether typed or JSON text; leave other types."""
    out = {}
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if isinstance(f.dataType, T.StringType) and f.name in ARRAY_FIELDS:
            out[f.name] = clean_json_array(F.col(f.name))
        elif isinstance(f.dataType, T.StringType):
            out[f.name] = ws_normalize(F.col(f.name))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            out[f.name] = clean_array_if_text(F.col(f.name))
    return df.withColumns(out) if out else df


def required_field_split(
    df: DataFrame, required: tuple[str, ...] = REQUIRED_FIELDS
) -> tuple[DataFrame, DataFrame]:
    """``(kept, rejected)``; a rejected row names the first missing field."""
    reason = F.coalesce(
        *[F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in required]
    )
    tagged = df.withColumn("reject_reason", reason)
    return (
        tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
        tagged.filter(F.col("reject_reason").isNotNull()),
    )


def treat(records: DataFrame, widths: str = "schema") -> DataFrame:
    """Cleaned and typed records, the good and the bad alike; no shuffle is involved."""
    renamed = rename_key(records)
    # Dates are read from the original text: a token ends at the first line break.
    dated = apply_date_fields(renamed)
    dates = tuple(c for c in dated.columns if c.lower() in DATE_FIELDS)
    cleaned = clean_fields(dated, skip=(*PLACE, *dates))
    return truncate_columns(cleaned, load_limits([c for c in cleaned.columns if c not in PLACE], widths))


def stage(records: DataFrame, widths: str = "schema") -> tuple[DataFrame, DataFrame]:
    """Run the whole per-record treatment: ``(kept, rejected)``."""
    return required_field_split(treat(records, widths))


def stage_texts(texts: DataFrame, widths: str = "schema") -> DataFrame:
    """Files to staging rows in one parse: good rows, rejected rows (``reason``, ``record``) and unreadable files.

    An unreadable file is one row with a ``reason`` and no ``pos``; a file without records one row with neither.
    """
    rows = parse_items(texts, "string").select("rel_path", "reason", F.posexplode_outer("items").alias("pos", "fields"))
    rows = rows.select("rel_path", "pos", "reason", F.to_json("fields").alias("record"), *typed_fields())
    missing = F.when(F.col("pos").isNotNull() & F.col(ID_COLUMN).isNull(), f"missing {ID_COLUMN}")
    out = treat(rows, widths).withColumn("reason", F.coalesce("reason", missing))
    return out.withColumn("record", F.when(F.col("reason").isNotNull(), F.col("record")))


def good_rows(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("pos").isNotNull() & F.col("reason").isNull())


def bad_rows(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("reason").isNotNull()).select("rel_path", "reason", "record")


def to_staging(rows: DataFrame, load_id: int) -> DataFrame:
    """Staging columns; arrays become JSON text and ``id_dw`` orders rows within a load."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}

    def column(name: str) -> Column:
        if name not in kinds:
            return F.lit(None).cast("string").alias(name)
        if isinstance(kinds[name], T.ArrayType):
            return F.to_json(F.col(name)).alias(name)
        return F.col(name).cast("string").alias(name)

    row_id = F.monotonically_increasing_id()
    return rows.select(
        row_id.alias("id_dw"),
        F.lit(load_id).cast("bigint").alias("load_id"),
        *[c for c in ("rel_path", "pos") if c in kinds],
        *[column(c) for c in [*STAGING_WIDTHS, *LONG_FIELDS]],
    )


def load_files(
    spark: SparkSession,
    folder: str,
    staging_path: str,
    quarantine_path: str,
    manifest_path: str,
    load_id: int | None = None,
    pattern: str = PATTERN,
) -> int | None:
    """Load the files not yet in the manifest; gives the load's number, or None if there was nothing to load.

    The number is the manifest's next one. A given number must be free: one that holds other files is refused. Data
    first, then quarantine, then manifest; each load owns the partition ``load_id=N``, so repeating a load that died
    half-way adds nothing twice. Unreadable files are left out of the manifest and retried. The executors list the folder,
    leave out what the manifest has and open the rest, so no file name passes through the driver. Rows
    keep ``rel_path`` and ``pos``, their place in the order of the load however Spark splits the files.
    """
    manifest = read_manifest(spark, manifest_path)
    todo = materialize(pending(list_folder(spark, folder, pattern), manifest), "pending-files")
    if todo.isEmpty():
        return None
    number = next_load(manifest, load_id)
    staged = materialize(stage_texts(open_files(todo, folder)), "staged")

    to_staging(good_rows(staged), number).drop("load_id").write.mode("overwrite").parquet(
        f"{staging_path}/load_id={number}"
    )
    bad_rows(staged).write.mode("overwrite").parquet(f"{quarantine_path}/load_id={number}")
    unreadable = spark.read.parquet(f"{quarantine_path}/load_id={number}").filter(F.col("record").isNull())
    append_manifest(todo.join(unreadable, "rel_path", "left_anti"), manifest_path, number)
    return number


def incremental_texts(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """``rel_path, text`` of the files not in the manifest, for dynamic readers."""
    return pending(read_texts(spark, folder, folder), manifest)
