"""Vector arithmetic on ``array<float>`` columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def norm(a: Column) -> Column:
    return F.sqrt(
        F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    )


def cosine_distance(a: Column, b: Column) -> Column:
    """``1 - cos(a, b)``; null for a zero vector or differing lengths."""
    size = norm(a) * norm(b)
    return F.when((F.size(a) == F.size(b)) & (size > 0), 1.0 - dot(a, b) / size)


def cosine_distance_to(a: Column, query: Sequence[float]) -> Column:
    """:func:`cosine_distance` to one fixed vector."""
    return cosine_distance(a, F.lit([float(x) for x in query]))


def vector_literal(a: Column) -> Column:
    """``[v1,v2,...]`` text of a vector."""
    return F.concat(F.lit("["), F.array_join(F.transform(a, lambda x: x.cast("string")), ","), F.lit("]"))
