"""Profiles -> suggested column types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ementario.schemas import LONG_FIELDS

# --- fixed values: sizing rules ----------------------------------------------------
TEXT_OVER = 255
EMPTY_WIDTH = 50
MIN_WIDTH = 50
MARGIN = 1.25
SMALLINT_MAX = 32767
INTEGER_MAX = 2147483647
FLOAT_DIGITS = 15
FLOAT_PLACES = 4
DATE_DDL = "DATE ou TIMESTAMP"
# --- end of fixed values -----------------------------------------------------------


def varchar_ddl(max_len: Column) -> Column:
    base = max_len * F.lit(MARGIN)

    def up_to(step: int) -> Column:
        return (F.ceil(base / step) * step).cast("int")

    width = (
        F.when(max_len == 0, EMPTY_WIDTH)
        .when(base < 100, F.greatest(up_to(10), F.lit(MIN_WIDTH)))
        .when(base < 500, up_to(50))
        .otherwise(up_to(100))
    )
    return F.when(max_len > TEXT_OVER, F.lit("TEXT")).otherwise(
        F.concat(F.lit("VARCHAR("), width.cast("string"), F.lit(")"))
    )


def integer_ddl(max_val: Column) -> Column:
    return (
        F.when(max_val <= SMALLINT_MAX, "SMALLINT")
        .when(max_val <= INTEGER_MAX, "INTEGER")
        .otherwise("BIGINT")
    )


def float_ddl(max_val: Column, places: Column) -> Column:
    whole = F.coalesce(
        F.char_length(max_val.try_cast("bigint").cast("string")),
        (F.floor(F.log10(max_val)) + 1).cast("int"),
        F.lit(1),
    )
    digits = whole + places
    return F.when(
        (digits > FLOAT_DIGITS) | (places > FLOAT_PLACES),
        F.concat(
            F.lit("NUMERIC("), (digits + 2).cast("string"), F.lit(", "), places.cast("string"), F.lit(")")
        ),
    ).otherwise("FLOAT8")


def suggest_ddl(profile: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``column, ddl`` ordered by column; works on simple and typed profiles."""
    is_long = F.col("column").isin(*LONG_FIELDS)
    rules = F.when(is_long, "TEXT").when(F.col("type") == "string", varchar_ddl(F.col("max_len")))
    if "precision" in profile.columns:
        rules = (
            rules.when(F.col("type") == "date", DATE_DDL)
            .when(F.col("type") == "float", float_ddl(F.col("max_val"), F.col("precision")))
            .when(F.col("type") == "boolean", "BOOLEAN")
        )
    ddl = rules.otherwise(integer_ddl(F.col("max_val")))
    return profile.select(*keep, "column", ddl.alias("ddl")).orderBy(*keep, "column")
