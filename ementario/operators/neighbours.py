"""Exact k nearest vectors of every query by a metric index: cells around centres, cut into rings.

Unit vectors are points on a sphere, where the squared distance of two points is twice their cosine distance, so the triangle
inequality holds: a query at distance D of a centre is at least D - r away from all that lies within r of it. Vectors
are dealt to their nearest centre and, within its cell, to blocks of rings. A query first meets one block near to it, which
bounds how far its k-th nearest can be, and then only those blocks that can hold anything nearer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ementario.session import materialize

# Distances are compared at this many decimals so that equal vectors tie, whatever the
# summation order, and ties go to the smaller id.
DISTANCE_DECIMALS = 9
#: Vectors that a cell should hold, and the centres there are at most (a sample by hash, so bounded on the driver).
CELL_ROWS, MOST_CENTRES = 2_000, 4_096
#: Rows of a block, and of the queries that meet it first in one task.
BLOCK_ROWS = 20_000
#: Queries that a task holds while vectors pass by, and elements of a matrix of distances.
SHARD_ROWS, MATRIX = 100_000, 2 << 20
#: Vectors of neighbouring small blocks that are met together when most queries want them all.
TOGETHER = 512
#: Rings of a cell, of equal width, before they are joined to blocks.
RINGS = 64
#: What rounding may take off a distance, and a cosine distance at ``DISTANCE_DECIMALS``.
SLACK, ROUNDING = 1e-7, 2e-9

_CANDIDATES = "qid bigint, vid bigint, dist double"
_PLACED = "id bigint, dim int, vec array<double>, cell int, ring int"


def unit_vectors(df: DataFrame, key: str) -> DataFrame:
    """``id, dim, vec``: vectors that have a direction, at length one."""
    vec = F.col("embedding").cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda a, x: a + x * x))
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.when(finite, vec).alias("vec"), F.when(finite, norm).alias("n"))
    rows = rows.filter((F.col("n") > 0) & (F.col("n") < float("inf")))
    unit = F.transform("vec", lambda x: x / F.col("n"))
    return rows.select("id", F.size("vec").alias("dim"), unit.alias("vec"))


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of all rows of two sets of unit vectors."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ y.T)))


class Centres:
    """The centres of each vector length, numbered through. A length without a centre is one cell of its own, -dim."""

    def __init__(self, picked: list[tuple[int, list[float]]]) -> None:
        self.points: dict[int, np.ndarray] = {}
        self.first: dict[int, int] = {}
        at = 0
        for dim in sorted({d for d, _ in picked}):
            own = np.unique(np.array([v for d, v in picked if d == dim]), axis=0)  # copies are one centre
            self.points[dim], self.first[dim] = own, at
            at += len(own)

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and distance to its centre of each row."""
        dim = x.shape[1]
        if dim not in self.points:
            return np.full(len(x), -dim), np.zeros(len(x))
        near, least = np.empty(len(x), dtype=np.int64), np.empty(len(x))
        for part in _steps(len(x), len(self.points[dim])):
            far = _apart(x[part], self.points[dim])
            near[part] = far.argmin(axis=1)
            least[part] = far.min(axis=1)
        return near + self.first[dim], least

    def distances(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Of each row to the centres of ``cells``; to a cell without a centre it is 0, which bounds nothing."""
        dim = x.shape[1]
        if dim not in self.points:
            return np.zeros((len(x), len(cells)))
        # The wanted centres only: a caller may ask for one block at a time.
        return _apart(x, self.points[dim][cells - self.first[dim]])


def _centres(units: DataFrame, n: int) -> Centres:
    """A bounded sample, the vectors with the smallest hashes: it shapes the cells, and no result depends on it."""
    if n <= 1:
        return Centres([])
    picked = units.orderBy(F.xxhash64("id", "dim"), "id").limit(n).select("dim", "vec").collect()
    return Centres([(r.dim, r.vec) for r in picked])


def _place(units: DataFrame, centres: Centres) -> DataFrame:
    """Each vector with its cell and the ring of its distance to the centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                rows = batch.filter(pa.array(dims == dim))
                cell, far = centres.place(_matrix(rows.column("vec"), dim))
                ring = np.minimum((far * (RINGS / 2)).astype(np.int32), RINGS - 1)
                columns = [*(rows.column(c) for c in ("id", "dim", "vec")), pa.array(cell, pa.int32()), pa.array(ring, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "dim", "vec", "cell", "ring"])

    return units.mapInArrow(run, _PLACED)


class Blocks:
    """Neighbouring rings of a cell, up to ``BLOCK_ROWS`` vectors; a fuller ring is a block in several parts.

    There are at most ``MOST_CENTRES`` * ``RINGS`` rings, whatever the number of vectors.
    """

    def __init__(self, rings: list[tuple[int, int, int, int]], block_rows: int) -> None:
        found: list[list[int]] = []  # dim, cell, first ring, last ring, vectors
        for dim, cell, ring, n in sorted(rings):
            if found and found[-1][:2] == [dim, cell] and found[-1][4] + n <= block_rows:
                found[-1][3:] = [ring, found[-1][4] + n]
            else:
                found.append([dim, cell, ring, ring, n])
        self.table = np.array(found, dtype=np.int64).reshape(-1, 5)
        self.dim, self.cell, self.n = self.table[:, 0], self.table[:, 1], self.table[:, 4]
        # Without a centre all distances are given as 0, and the block reaches as far as a sphere does.
        self.low = np.where(self.cell < 0, 0.0, self.table[:, 2] * (2 / RINGS))
        self.high = np.where(self.cell < 0, 2.0, (self.table[:, 3] + 1) * (2 / RINGS))
        self.parts = -(-self.n // block_rows)

    def rows(self) -> list[tuple[int, int, int]]:
        """block, cell and ring of every ring."""
        return [(b, int(r[1]), ring) for b, r in enumerate(self.table) for ring in range(r[2], r[3] + 1)]

    def bounds(self, far: np.ndarray, which: np.ndarray) -> np.ndarray:
        """The least distance that a vector of each block can have, given distances to the blocks' centres."""
        return np.maximum(0.0, np.maximum(far - self.high[which], self.low[which] - far)) - SLACK


def _steps(n: int, width: int) -> Iterator[slice]:
    """Rows dealt to matrices of at most some million elements, whatever their number and width."""
    step = max(1, MATRIX // max(width, 1))
    return (slice(at, at + step) for at in range(0, n, step))


def _first(queries: DataFrame, centres: Centres, blocks: Blocks) -> DataFrame:
    """Each query once, with the nearest block."""
    schema = "id bigint, dim int, vec array<double>, block int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                which = np.flatnonzero(blocks.dim == dim)
                if not len(which):
                    continue
                rows = batch.filter(pa.array(dims == dim))
                x, near = _matrix(rows.column("vec"), dim), []
                for part in _steps(len(x), len(which)):
                    far = centres.distances(x[part], blocks.cell[which])
                    near.append(np.lexsort((far, blocks.bounds(far, which)), axis=1)[:, 0])
                found = pa.array(which[np.concatenate(near)], pa.int32())
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("id", "dim", "vec")), found], names=["id", "dim", "vec", "block"])

    return queries.mapInArrow(run, schema)


def _wanted(known: DataFrame, centres: Centres, blocks: Blocks, k: int) -> DataFrame:
    """``shard, block``: the blocks that can hold a vector at most ``reach`` away from any query of a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, shards = batch.column("dim").to_numpy(), batch.column("shard").to_numpy()
            reach = batch.column("reach").to_numpy()
            for dim in np.unique(dims).tolist():
                which = np.flatnonzero(blocks.dim == dim)
                mine = np.flatnonzero(dims == dim)
                x = _matrix(batch.column("vec").take(pa.array(mine)), dim)
                for part in _steps(len(x), len(which)):
                    far = centres.distances(x[part], blocks.cell[which])
                    # As many vectors as asked for lie within the blocks of smallest farthest distance.
                    most = far + blocks.high[which]
                    order = most.argsort(axis=1, kind="stable")
                    enough = (np.cumsum(blocks.n[which][order], axis=1) > k).argmax(axis=1)
                    sure = np.take_along_axis(most, order, axis=1)[np.arange(len(far)), enough]
                    sure = np.where(blocks.n[which].sum() > k, sure, np.inf)
                    limit = np.minimum(reach[mine[part]], (sure + SLACK) ** 2 / 2) + ROUNDING
                    go = np.maximum(0.0, blocks.bounds(far, which)) ** 2 / 2 <= limit[:, None]
                    for shard in np.unique(shards[mine[part]]).tolist():
                        found = which[go[shards[mine[part]] == shard].any(axis=0)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(found), shard), pa.int32()), pa.array(found, pa.int32())], names=["shard", "block"]
                        )

    return known.select("dim", "vec", "reach", "shard").mapInArrow(run, "shard int, block int").distinct()


def _top_k(names: np.ndarray, qids: np.ndarray, q: np.ndarray, vids: np.ndarray, v: np.ndarray, k: int, exclude_self: bool) -> pa.Table:
    """The ``k`` nearest rows of ``v`` for each row of ``q``, as ``qid`` (its name), ``vid, dist``."""
    out = []
    order = np.argsort(vids, kind="stable")  # columns in id order, for ties
    vids, v = vids[order], v[order]
    for part in _steps(len(q), len(v)):
        block, ids = q[part], qids[part]
        dist = np.round(1.0 - block @ v.T, DISTANCE_DECIMALS)
        if exclude_self:
            dist[ids[:, None] == vids[None, :]] = np.inf
        if k < len(vids):
            # Below the k-th distance, then as many of its ties, by id, as still fit: a
            # group of equal vectors adds at most k rows.
            limit = np.partition(dist, k - 1, axis=1)[:, k - 1 : k]
            nearer, tied = dist < limit, dist == limit
            room = k - nearer.sum(axis=1, keepdims=True)
            keep = nearer | (tied & (np.cumsum(tied, axis=1, dtype=np.int32) <= room))
            rows, cols = np.nonzero(keep & np.isfinite(dist))
        else:
            rows, cols = np.nonzero(np.isfinite(dist))
        out.append(pa.table({"qid": names[part][rows], "vid": vids[cols], "dist": dist[rows, cols]}))
    return pa.concat_tables(out)


def _part(n: Column) -> Column:
    return F.pmod(F.xxhash64("id", "vec"), n).cast("int")


def _reach(first: DataFrame, vectors: DataFrame, asked: dict[int, int], blocks: Blocks, k: int, exclude_self: bool, block_rows: int, counter: Accumulator | None) -> DataFrame:
    """The queries with their ``reach``: the distance of the ``k``-th nearest vector in one part of their first block.

    It bounds the distance of the ``k``-th nearest of all. A task holds at most about ``block_rows`` rows of either side, however many
    vectors a block has and however many queries ask for it.
    """
    spark = first.sparkSession
    shape = [(b, int(blocks.parts[b]), -(-n // block_rows)) for b, n in asked.items()]
    shape = spark.createDataFrame(shape, "block int, v_parts int, q_parts int")
    left = first.join(shape, "block").select(
        "block", _part(F.col("q_parts")).alias("piece"),
        F.col("id").alias("qid"), F.col("dim").alias("qdim"), F.col("vec").alias("qvec"),  # the two sides may be one table
    )
    pieces = F.filter(F.sequence(F.lit(0), F.col("q_parts") - 1), lambda i: i % F.col("v_parts") == F.col("vp"))
    right = vectors.join(shape, "block").withColumn("vp", _part(F.col("v_parts"))).select("block", F.explode(pieces).alias("piece"), "id", "dim", "vec")

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        reach = np.full(a.num_rows, np.inf)
        if a.num_rows and b.num_rows >= k:
            if counter is not None:
                counter.add(a.num_rows * b.num_rows)
            dim = a.column("qdim")[0].as_py()
            q, v = _matrix(a.column("qvec"), dim), _matrix(b.column("vec"), dim)
            near = _top_k(np.arange(len(q)), a.column("qid").to_numpy(), q, b.column("id").to_numpy(), v, k, exclude_self)
            rows = near.column("qid").to_numpy()
            far = np.full(len(q), -np.inf)
            np.maximum.at(far, rows, near.column("dist").to_numpy())
            full = np.bincount(rows, minlength=len(q)) == k
            reach[full] = far[full]
        return pa.table({"block": a.column("block"), "id": a.column("qid"), "dim": a.column("qdim"), "vec": a.column("qvec"), "reach": reach})

    keys = ["block", "piece"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, "block int, id bigint, dim int, vec array<double>, reach double")


def _shards(asked: dict[int, int], shard_rows: int, least: int) -> tuple[list[tuple[int, int, int]], int]:
    """``block, first shard, shards`` for the queries of each block, and how many shards there are.

    Queries of neighbouring blocks share a shard, those of a block that many ask for are dealt to several. At least ``least``
    shards, so that all cores work, and as many more as ``shard_rows`` queries in a shard take.
    """
    total = sum(asked.values())
    size = max(1, min(shard_rows, -(-total // least)))
    out, shard, held = [], 0, 0
    for block, n in sorted(asked.items()):
        if held and held + n > size:
            shard, held = shard + 1, 0
        parts = -(-n // size)
        out.append((block, shard, parts))
        shard, held = (shard, held + n) if parts == 1 else (shard + parts, 0)
    return out, shard + 1


class _Held:
    """The queries of a shard and the ``k`` nearest vectors that each has met."""

    def __init__(self, rows: pa.Table, dim: int, k: int, exclude_self: bool) -> None:
        self.ids, self.x = rows.column("id").to_numpy(), _matrix(rows.column("vec"), dim)
        self.reach = rows.column("reach").to_numpy().copy()
        self.k, self.exclude_self = k, exclude_self
        self.dist, self.vid = np.full((len(self.ids), k), np.inf), np.zeros((len(self.ids), k), dtype=np.int64)

    def meet(self, which: np.ndarray, vids: np.ndarray, v: np.ndarray) -> None:
        """Some of the queries and some vectors. Only those that come as near as what is known are ranked."""
        for part in _steps(len(which), len(v)):
            rows = which[part]
            near = (self.x[rows] @ v.T).max(axis=1) >= 1.0 - self.reach[rows] - ROUNDING
            rows = rows[near]
            if not len(rows):
                continue
            found = _top_k(np.arange(len(rows)), self.ids[rows], self.x[rows], vids, v, self.k, self.exclude_self)
            at, dist, vid = (found.column(c).to_numpy() for c in ("qid", "dist", "vid"))
            at = np.concatenate([np.repeat(np.arange(len(rows)), self.k), at])
            dist, vid = np.concatenate([self.dist[rows].ravel(), dist]), np.concatenate([self.vid[rows].ravel(), vid])
            order = np.lexsort((vid, dist, at))
            start = np.searchsorted(at[order], np.arange(len(rows)))
            best = order[(start[:, None] + np.arange(self.k)).ravel()]  # each query has at least k entries, its own
            self.dist[rows], self.vid[rows] = dist[best].reshape(-1, self.k), vid[best].reshape(-1, self.k)
            self.reach[rows] = np.minimum(self.reach[rows], self.dist[rows, -1])

    def table(self) -> pa.Table:
        rows, cols = np.nonzero(np.isfinite(self.dist))
        return pa.table({"qid": self.ids[rows], "vid": self.vid[rows, cols], "dist": self.dist[rows, cols]})


def _meet(known: DataFrame, vectors: DataFrame, n_shards: int, centres: Centres, blocks: Blocks, k: int, exclude_self: bool, counter: Accumulator | None) -> DataFrame:
    """The ``k`` nearest of each query. Its shard's task holds the queries, each once, and the vectors of the wanted blocks pass by.

    So a vector is sent to a shard once, however many of the queries there meet it, and a task holds the queries of one shard
    (a bounded number) and one batch of vectors. What a query has met so far tells which blocks it may still leave out.
    """
    wanted = _wanted(known, centres, blocks, k)
    queries = known.select("shard", F.lit(-1).alias("block"), "id", "dim", "vec", "reach")
    passing = vectors.join(wanted, "block").select("shard", "block", "id", "dim", "vec", F.lit(0.0).alias("reach"))
    rows = queries.union(passing).repartitionById(n_shards, F.col("shard")).sortWithinPartitions("block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        held: dict[int, _Held] = {}
        for batch in batches:
            of = batch.column("block").to_numpy()
            at = int(np.searchsorted(of, 0))  # the queries sort first
            if at:
                waiting.append(batch.slice(0, at))
            if at == len(of):
                continue
            if waiting:
                asked = pa.Table.from_batches(waiting)
                waiting, dims = [], asked.column("dim").to_numpy()
                held = {d: _Held(asked.filter(pa.array(dims == d)), d, k, exclude_self) for d in np.unique(dims).tolist()}
            batch, of = batch.slice(at), of[at:]
            ids, ends = batch.column("id").to_numpy(), np.array([*np.flatnonzero(np.diff(of)) + 1, len(of)])
            starts, passed, last = np.array([0, *ends[:-1]]), of[ends - 1], 0
            while last < len(ends):
                first, dim = last, int(blocks.dim[passed[last]])
                last += 1
                if dim not in held:
                    continue
                mine = held[dim]
                most = first + max(1, MATRIX // max(1, len(mine.ids)))
                while last < min(most, len(ends)) and blocks.dim[passed[last]] == dim and ends[last] - starts[first] <= TOGETHER:
                    last += 1
                near = passed[first:last]
                least = np.maximum(0.0, blocks.bounds(centres.distances(mine.x, blocks.cell[near]), near)) ** 2 / 2
                together = last - first > 1 and (least <= (mine.reach + ROUNDING)[:, None]).mean() > 0.5
                for a, b in [(first, last)] if together else [(i, i + 1) for i in range(first, last)]:
                    which = np.flatnonzero((least[:, a - first : b - first] <= (mine.reach + ROUNDING)[:, None]).any(axis=1))
                    start, end = int(starts[a]), int(ends[b - 1])
                    if counter is not None:
                        counter.add(len(which) * (end - start))
                    if len(which):
                        mine.meet(which, ids[start:end], _matrix(batch.column("vec").slice(start, end - start), dim))
        for mine in held.values():
            yield from mine.table().to_batches()

    return rows.mapInArrow(run, _CANDIDATES)


def best(candidates: DataFrame, k: int) -> DataFrame:
    """Final ranking of the per-task candidates; limited per group before the shuffle."""
    by_query = Window.partitionBy("qid").orderBy("dist", "vid")
    return (
        candidates.withColumn("rank", F.row_number().over(by_query))
        .filter(F.col("rank") <= k)
        .select("qid", "rank", "vid", "dist")
    )


def knn_join(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 3,
    query_key: str = "vec_id",
    key: str = "vec_id",
    exclude_self: bool = False,
    cell_rows: int = CELL_ROWS,
    block_rows: int = BLOCK_ROWS,
    counter: Accumulator | None = None,
) -> DataFrame:
    """Exact ``k`` nearest vectors of every query: ``qid, rank, vid, dist``.

    Vectors of another length than the query's, and those without a direction, have no distance and are never returned. A task
    returns at most ``k`` rows per query, never its pairs. A query is sent to one task, which keeps its nearest, and a vector to
    each task that wants its block, at most once: their number depends on the cores until tasks hold ``SHARD_ROWS`` queries each. A
    table of no more than ``cell_rows`` vectors is one cell. On data without any structure the bounds exclude little and all blocks
    are met, as an exact answer must; ``counter`` (an accumulator) counts the pairs that were compared.
    """
    same = queries is vectors and query_key == key
    units = unit_vectors(vectors, key)
    centres = _centres(units, min(MOST_CENTRES, -(-vectors.count() // cell_rows)))
    placed = materialize(_place(units, centres), "knn-vectors")
    q = placed if same else materialize(unit_vectors(queries, query_key), "knn-queries")
    rings = placed.groupBy("dim", "cell", "ring").agg(F.count("*").alias("n")).collect()
    blocks = Blocks([tuple(r) for r in rings], block_rows)
    of_block = q.sparkSession.createDataFrame(blocks.rows(), "block int, cell int, ring int")
    held = placed.join(of_block, ["cell", "ring"]).select("block", "id", "dim", "vec")
    first = materialize(_first(q, centres, blocks), "knn-first")
    asked = {r["block"]: r["n"] for r in first.groupBy("block").agg(F.count("*").alias("n")).collect()}
    shape, n_shards = _shards(asked, SHARD_ROWS, 2 * q.sparkSession.sparkContext.defaultParallelism)
    shape = q.sparkSession.createDataFrame(shape, "block int, shard int, parts int")
    reached = _reach(first, held, asked, blocks, k, exclude_self, block_rows, counter).join(shape, "block")
    known = materialize(reached.select("id", "dim", "vec", "reach", (F.col("shard") + _part(F.col("parts"))).alias("shard")), "knn-known")
    return best(_meet(known, held, n_shards, centres, blocks, k, exclude_self, counter), k)
