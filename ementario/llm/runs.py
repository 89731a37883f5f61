"""Groups streamed through Arrow batches: many small groups per call, none held longer than needed."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Groups are handed over together until they have so many rows.
ROWS = 20_000


def ends_of_groups(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Positions at which another group begins, the start and the end left out. Keys are integers without nulls."""
    change = np.zeros(max(0, table.num_rows - 1), dtype=bool)
    for k in keys:
        v = table.column(k).to_numpy()
        change |= v[1:] != v[:-1]
    return np.flatnonzero(change) + 1


def map_groups(
    df: DataFrame,
    keys: list[str],
    fn: Callable[[pa.Table, np.ndarray], Iterable[pa.RecordBatch]],
    schema: str,
    order: tuple[str, ...] = (),
) -> DataFrame:
    """``fn(rows, bounds)`` over whole groups of ``keys``: rows sorted by keys and ``order``, ``bounds`` from 0 to the
    number of rows.

    Rows are dealt out and sorted by Spark. A task keeps the rows of its current group and at most ``ROWS`` more,
    so callers split groups that may be large.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hand(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            rows = rows.combine_chunks()
            yield from fn(rows, np.concatenate(([0], ends_of_groups(rows, keys), [rows.num_rows])))

        kept: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            kept.append(batch)
            n += batch.num_rows
            if n < ROWS:
                continue
            rows = pa.Table.from_batches(kept)
            cut = ends_of_groups(rows, keys)
            if len(cut):
                yield from hand(rows.slice(0, cut[-1]))
                rows = rows.slice(cut[-1])
            kept, n = rows.to_batches(), rows.num_rows if len(cut) else 0  # a large group waits for its end
        rows = pa.Table.from_batches(kept) if kept else None
        if rows is not None and rows.num_rows:
            yield from hand(rows)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that it reaches by the links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label
