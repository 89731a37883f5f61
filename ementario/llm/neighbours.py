"""Near-duplicate embeddings by a pivot-permutation index.

Each vector is described by its nearest reference points (pivots) in order. Its inverted lists are keyed by pairs
of these pivots, so two vectors that meet in a list share at least two; the shared pivots of a pair are compared
again to count it in one list only. Pairs that meet are verified by their exact cosine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ementario.llm.components import connected_components
from ementario.llm.runs import map_groups, roots
from ementario.session import materialize

#: Pivots described per vector. Recall was measured with these (see the tests).
NEAREST = 6
LEAST_PIVOTS, MOST_PIVOTS = 64, 1024
#: Lists are compared in blocks of about so many vectors; a longer list is many pairs of blocks, each a task's group.
BLOCK = 2_000


def usable(vector: Column) -> Column:
    """Whether a vector can link: not null, finite and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def choose_pivots(classes: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Unit pivots for each vector length: a bounded sample, the vectors with the smallest hashes.

    Their number grows as the square root of the number of vectors, up to ``MOST_PIVOTS``. A length with too few vectors in
    the sample is filled up with directions from a fixed random seed.
    """
    many = min(MOST_PIVOTS, max(LEAST_PIVOTS, 1 << math.ceil(math.log2(max(1, n)) / 2)))
    picked = classes.orderBy(F.xxhash64("h1"), "h1", "h2").limit(many).select("dim", "vector").collect()
    out = {}
    for dim in {r.dim for r in picked}:
        own = np.array([r.vector for r in picked if r.dim == dim], np.float64)
        out[dim] = own
    for dim, own in out.items():
        if len(own) < LEAST_PIVOTS:
            more = np.random.default_rng(dim).normal(size=(LEAST_PIVOTS - len(own), dim))
            out[dim] = np.concatenate([own, more])
        out[dim] = unit(out[dim])
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that neither tiny nor huge components are lost."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def post(classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """One row per vector and list: its key columns, and the vector's sorted pivots in ``near``."""
    pairs = np.array(list(combinations(range(NEAREST), 2)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                rows = batch.filter(pa.array(dims == dim))
                if dim in pivots:
                    points = pivots[dim]
                else:  # a length that the sample missed
                    points = unit(np.random.default_rng(dim).normal(size=(LEAST_PIVOTS, dim)))
                near = np.argsort(-(unit(matrix(rows.column("vector"), dim)) @ points.T), axis=1, kind="stable")[:, :NEAREST]
                near = np.sort(near, axis=1).astype(np.int32)
                keys = near[:, pairs[:, 0]].astype(np.int64) * MOST_PIVOTS + near[:, pairs[:, 1]]
                lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), len(pairs)).cast(pa.list_(pa.int64()))
                sig = pa.FixedSizeListArray.from_arrays(pa.array(near.ravel()), NEAREST).cast(pa.list_(pa.int32()))
                kept = [rows.column(c) for c in ("node", "weight", "label", "dim", "vector")]
                yield pa.RecordBatch.from_arrays([*kept, sig, lists], [*names, "lists"])

    names = ["node", "weight", "label", "dim", "vector", "near"]
    schema = "node long, weight long, label long, dim int, vector array<double>, near array<int>, lists array<long>"
    return classes.select(*names[:5]).mapInArrow(run, schema).withColumn("list", F.explode("lists")).drop("lists")


def first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows of sorted pivots: the list key of the two smallest pivots that both rows have."""
    shared = (a[:, :, None] == b[:, None, :]).any(axis=2)
    order = np.argsort(~shared, axis=1, kind="stable")[:, :2]
    two = np.take_along_axis(a, order, axis=1).astype(np.int64)
    return two[:, 0] * MOST_PIVOTS + two[:, 1]


def verified(lists: DataFrame, least: float) -> DataFrame:
    """node, partner (the smallest node that the task linked it to) and n (the weight of its partners)."""

    def run(rows: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        node, weight = rows.column("node").to_numpy(), rows.column("weight").to_numpy()
        block, key = rows.column("block").to_numpy(), rows.column("list").to_numpy()
        dims = rows.column("dim").to_numpy()
        near = rows.column("near").combine_chunks()
        near = near.flatten().to_numpy().reshape(-1, NEAREST)
        vectors = rows.column("vector").combine_chunks()
        n = np.zeros(len(node), np.int64)
        links_a, links_b = [], []
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if hi - lo < 2:
                continue
            x = unit(matrix(vectors.slice(lo, hi - lo), int(dims[lo])))
            blocks = np.unique(block[lo:hi])
            one = np.flatnonzero(block[lo:hi] == blocks[0])
            two = one if len(blocks) == 1 and not rows.column("crossed")[lo].as_py() else np.flatnonzero(block[lo:hi] == blocks[-1])
            if two is not one and len(blocks) == 1:
                continue  # the other block of this pair is empty
            for at in range(0, len(one), BLOCK):
                part = one[at : at + BLOCK]
                i, j = np.nonzero(x[part] @ x[two].T >= least)
                a, b = part[i], two[j]
                if two is one:
                    a, b = a[a < b], b[a < b]
                # A pair is counted in the first of the lists that it shares.
                own = first_shared(near[lo + a], near[lo + b]) == key[lo]
                links_a.append(lo + a[own])
                links_b.append(lo + b[own])
        a = np.concatenate(links_a) if links_a else np.empty(0, np.int64)
        b = np.concatenate(links_b) if links_b else np.empty(0, np.int64)
        np.add.at(n, a, weight[b])
        np.add.at(n, b, weight[a])
        root = roots(len(node), a, b)
        linked = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[linked]), pa.array(node[root[linked]]), pa.array(n[linked])], ["node", "partner", "n"]
        )

    keys = ["label", "dim", "list", "pair"]
    return map_groups(lists, keys, run, "node long, partner long, n long", order=("block", "node"))


def blocked(lists: DataFrame) -> DataFrame:
    """Long lists as pairs of blocks: each row is copied to the pairs that its block is in."""
    keys = ["label", "dim", "list"]
    sizes = lists.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    sizes = materialize(sizes.select(*keys, F.ceil(F.col("n") / BLOCK).alias("blocks")), "pivot-long")
    joined = lists.join(sizes, keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    joined = joined.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    others = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda o: F.struct(
        (F.least(o, F.col("block")) * F.col("blocks") + F.greatest(o, F.col("block"))).alias("pair"),
        (o != F.col("block")).alias("crossed"),
    ))
    return joined.withColumn("p", F.explode(others)).select(
        "node", "weight", "vector", "near", *keys, "block", "p.pair", "p.crossed"
    )


def near_duplicates(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of (vec_id, embedding, label).

    Rows link when their labels are equal and not null, their vectors have the same length and a cosine of ``least`` or more
    in double precision. Null, empty, zero and non-finite vectors link with nothing and are components of their own.
    Equal vectors of a label are one class with a weight: any number of exact copies costs one row. Rows that share a
    vec_id are counted each. A null vec_id is never a component's name unless all of it is null. Other columns
    are not read. Of the links found in a task a spanning forest and each vector's count are passed on, never pairs.
    """
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), v.alias("vector"))
    good = usable(F.col("vector")) & F.col("label").isNotNull()
    hashed = rows.withColumn("good", good).withColumns({
        "h1": F.when(F.col("good"), F.xxhash64("vector")), "h2": F.when(F.col("good"), F.xxhash64(F.lit(7), "vector")),
        "dim": F.when(F.col("good"), F.size("vector")),
    })
    hashed = materialize(hashed, "pivot-rows")
    members = hashed.select("vec_id", "label", "h1", "h2", "dim")
    classes = hashed.where(F.col("good") & F.col("vec_id").isNotNull()).groupBy("label", "dim", "h1", "h2").agg(
        F.min("vec_id").alias("node"), F.count("*").alias("weight"), F.first("vector").alias("vector")
    )
    classes = materialize(classes, "pivot-classes")
    pivots = choose_pivots(classes, classes.count())
    lists = materialize(post(classes, pivots), "pivot-lists")
    found = materialize(verified(blocked(lists), least), "pivot-links")
    groups = connected_components(found.select(F.col("node").alias("a"), F.col("partner").alias("b")))
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    keys = ["label", "dim", "h1", "h2"]
    named = classes.join(counts, "node", "left").join(groups, "node", "left").select(
        *keys, F.coalesce("component", "node").alias("component"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n")
    )
    named = materialize(named, "pivot-named")
    return members.join(named, keys, "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
