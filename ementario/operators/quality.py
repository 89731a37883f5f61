"""Constraint checks as queries: the rows, or counts of rows, that break a rule."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def fk_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose key is missing in the parent. Null keys break no rule."""
    p = parent.select(F.col(pk).alias("_pk"))
    return child.filter(F.col(fk).isNotNull()).join(p, F.col(fk) == F.col("_pk"), "left_anti")


def _per_column(df: DataFrame, aggs: dict[str, dict]) -> DataFrame:
    """Aggregate all columns in one pass, then turn the single row into one per column."""
    flat = [
        agg.alias(f"{column}\x1f{name}")
        for column, named in aggs.items()
        for name, agg in named.items()
    ]
    one = df.agg(*flat)
    rows = F.array(
        *[
            F.struct(
                F.lit(column).alias("column"),
                *[F.col(f"`{column}\x1f{name}`").alias(name) for name in named],
            )
            for column, named in aggs.items()
        ]
    )
    return one.select(F.inline(rows))


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    return _per_column(df, {c: {"n": F.count_if(F.col(c).isNull())} for c in columns})


def width_violations(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """Per column: its limit, the longest value and how many values are too long."""
    hit = {c: w for c, w in widths.items() if c in df.columns}
    out = _per_column(
        df,
        {
            c: {
                "max_len": F.max(F.char_length(c)),
                "n_over": F.count_if(F.char_length(c) > w),
            }
            for c, w in hit.items()
        },
    )
    limits = F.create_map(*[F.lit(x) for pair in hit.items() for x in pair])
    return out.select(
        "column", F.try_element_at(limits, F.col("column")).alias("limit"), "max_len", "n_over"
    )


def vector_dim_check(df: DataFrame, column: str, dim: int) -> DataFrame:
    """Rows whose vector is missing or has the wrong length."""
    return df.filter(F.col(column).isNull() | (F.size(column) != dim))
