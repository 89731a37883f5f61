"""Long texts stored once in files that all executors reach, and read back by their places.

A join gives a copy of a text to each row that wants it, and a sort after that moves every copy. Rows that carry a place
instead stay narrow while they are joined, dealt and sorted; whoever holds them in the end reads their texts.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ementario.session import materialize, scratch_path
from ementario.sources.folders import file_system

PLACE = "_text_place"
#: file (the task that wrote it), first byte, bytes there, and bytes of the texts themselves.
_PLACE = T.StructType([T.StructField("file", T.LongType()), T.StructField("at", T.LongType()), T.StructField("size", T.LongType()), T.StructField("raw", T.LongType())])
#: Text that a task holds at a time, bytes between two wanted records that are read with them, and files held open.
PIECE_BYTES, GAP_BYTES, OPEN_FILES = 16 << 20, 16 << 10, 64


def store_texts(df: DataFrame, columns: list[str]) -> tuple[DataFrame, str]:
    """The other columns of ``df`` with the ``PLACE`` of the row's string ``columns``, and the folder these were written to.

    A task writes one file, under a number that no other attempt has, so a repeated task leaves a file that nobody asks for.
    """
    folder = scratch_path(df.sparkSession, "texts")
    schema = T.StructType([*(f for f in df.schema.fields if f.name not in columns), T.StructField(PLACE, _PLACE)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = file_system(folder)
        system.create_dir(path, recursive=True)
        number, codec, at = TaskContext.get().taskAttemptId(), pa.Codec("lz4_raw"), 0
        with system.open_output_stream(f"{path}/{number}") as out:
            for batch in batches:
                starts, sizes, raws = [], [], []
                for texts in zip(*(batch.column(c).cast(pa.binary()).to_pylist() for c in columns)):
                    head = struct.pack(f"<{len(texts)}q", *(-1 if t is None else len(t) for t in texts))
                    whole = b"".join(t for t in texts if t)
                    body = head + (codec.compress(whole, asbytes=True) if whole else b"")
                    out.write(body)
                    starts.append(at)
                    sizes.append(len(body))
                    raws.append(len(whole))
                    at += len(body)
                numbers = pa.array(np.full(len(starts), number), pa.int64())
                place = pa.StructArray.from_arrays([numbers, *(pa.array(x, pa.int64()) for x in (starts, sizes, raws))], names=_PLACE.names)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in schema.names[:-1]), place], names=schema.names)

    return materialize(df.select(*schema.names[:-1], *columns).mapInArrow(run, schema), "text-places"), folder


class _Files:
    """Reads records by place; neighbouring ones at once."""

    def __init__(self, folder: str, n_columns: int) -> None:
        self.system, self.path = file_system(folder)
        self.codec, self.head = pa.Codec("lz4_raw"), struct.Struct(f"<{n_columns}q")
        self.open: dict[int, pa.NativeFile] = {}

    def _file(self, number: int) -> pa.NativeFile:
        if number not in self.open:
            if len(self.open) >= OPEN_FILES:
                self.close()
            self.open[number] = self.system.open_input_file(f"{self.path}/{number}")
        return self.open[number]

    def close(self) -> None:
        for file in self.open.values():
            file.close()
        self.open.clear()

    def _texts(self, body: bytes, raw: int) -> list[bytes | None]:
        lengths, at, out = self.head.unpack_from(body), 0, []
        whole = self.codec.decompress(body[self.head.size :], raw, asbytes=True) if raw else b""
        for n in lengths:
            out.append(None if n < 0 else whole[at : at + n])
            at += max(0, n)
        return out

    def read(self, place: np.ndarray) -> list[list[bytes | None]]:
        """The texts at each row of file, at, size and raw. A place asked for twice is read once."""
        place, back = np.unique(place, axis=0, return_inverse=True)  # in the order of the files
        ends = place[:, 1] + place[:, 2]
        cut = (np.diff(place[:, 0]) != 0) | (place[1:, 1] - ends[:-1] > GAP_BYTES)
        edges, found = [0, *(np.flatnonzero(cut) + 1).tolist(), len(place)], []
        for first, last in zip(edges[:-1], edges[1:]):
            start = int(place[first, 1])
            span = self._file(int(place[first, 0])).read_at(int(ends[last - 1]) - start, start)
            for _, at, size, raw in place[first:last].tolist():
                found.append(self._texts(span[at - start : at - start + size], raw))
        return [found[i] for i in back.ravel().tolist()]


def _pieces(raw: np.ndarray) -> Iterator[tuple[int, int]]:
    """Neighbouring rows with at most about ``PIECE_BYTES`` of text; one with more is a piece of its own."""
    first, held = 0, 0
    for i, n in enumerate(raw.tolist()):
        if i > first and held + n > PIECE_BYTES:
            yield first, i
            first, held = i, 0
        held += n
    if len(raw) > first:
        yield first, len(raw)


def read_texts(df: DataFrame, columns: list[str], folder: str) -> DataFrame:
    """``df`` with the texts at its ``PLACE``, null where it has none. Rows stay where they are and in their order."""
    schema = T.StructType([*(f for f in df.schema.fields if f.name != PLACE), *(T.StructField(c, T.StringType()) for c in columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder, len(columns))
        try:
            for batch in batches:
                place = batch.column(PLACE)
                known = place.is_valid().to_numpy(zero_copy_only=False)
                # A null struct's fields are null too where Spark wrote it, but need not be.
                parts = [np.where(known, place.field(n).fill_null(0).to_numpy(zero_copy_only=False), 0) for n in _PLACE.names]
                place = np.stack(parts, axis=1)
                for first, last in _pieces(place[:, 3]):
                    here = known[first:last]
                    texts = np.empty((last - first, len(columns)), dtype=object)
                    if here.any():
                        texts[here] = np.array(files.read(place[first:last][here]), dtype=object).reshape(-1, len(columns))
                    made = [pa.array(texts[:, i], pa.binary()).view(pa.string()) for i in range(len(columns))]
                    some = batch.slice(first, last - first)
                    own = [some.column(n) for n in schema.names[: len(schema) - len(columns)]]
                    yield pa.RecordBatch.from_arrays([*own, *made], names=schema.names)
        finally:
            files.close()

    return df.select(*(f.name for f in schema.fields[: len(schema) - len(columns)]), F.col(PLACE)).mapInArrow(run, schema)
