"""Connected components by alternating large and small stars, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ementario.session import materialize


def _stars(links: DataFrame, least: str) -> DataFrame:
    """Links x-y and, for each x, the smallest node among x and its partners."""
    # Written first: then both sides of the join are plain exchanges and Spark splits a hub's rows.
    smaller = links.groupBy("x").agg(F.min("y").alias(least)).where(F.col(least) < F.col("x"))
    smaller = materialize(smaller, "cc-least")
    return links.join(smaller, "x", "left").withColumn(least, F.coalesce(least, "x"))


def connected_components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable), for every node of ``links`` (columns a and b, integers).

    Nulls and links from a node to itself are left out; repeated links are harmless; without links the result is
    empty. Each round is written to the shared folder, so lineage stays short and lost executors cost a re-read.
    The number of rounds grows with the logarithm of the longest path.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pairs = materialize(pairs.distinct(), "cc-links")
    seen = None
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = state
        both = pairs.select(F.col("u").alias("x"), F.col("v").alias("y")).union(
            pairs.select(F.col("v").alias("x"), F.col("u").alias("y"))
        )
        large = _stars(both, "m").where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = materialize(large.where("x <> y").distinct(), "cc-large")
        small = _stars(large, "m")
        pairs = small.where("y <> m").select(F.col("y").alias("u"), F.col("m").alias("v")).union(
            small.select(F.col("x").alias("u"), F.col("m").alias("v"))
        )
        pairs = materialize(pairs.distinct(), "cc-links")
