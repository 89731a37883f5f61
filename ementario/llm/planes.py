"""Token files of byte planes: blocks of ids are transposed and each plane is compressed by itself.

A chunk holds whole documents. Its bytes are a header (magic, number of ids, ids per block, kind of plane, number of
entries), the index (one 32-bit size per block and plane) and the compressed planes, block after
block. Any block is read without the others. A token file is a folder of Parquet files whose rows are chunks, with the index
of documents beside them: Spark commits it whole or not at all, on any storage that it can write to, and a lost
executor's part is written again.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ementario.llm.tokens import VOCABULARY, encode_texts, slices

MAGIC = b"BPL1"
HEADER = struct.Struct("<4sQIBI")
BYTE_PLANES, BIT_PLANES = 0, 1
#: Ids in a block, and ids after which a chunk ends with the document.
BLOCK, CHUNK = 1 << 16, 1 << 18


def encode_chunk(ids: np.ndarray, block: int = BLOCK, kind: int = BYTE_PLANES, level: int = 3) -> bytes:
    """Ids (unsigned 32-bit) as the bytes of a chunk."""
    packer = zstandard.ZstdCompressor(level=level)
    planes: list[bytes] = []
    for at in range(0, len(ids), block):
        rows = ids[at : at + block].astype("<u4").view(np.uint8).reshape(-1, 4)
        if kind == BIT_PLANES:
            columns = np.packbits(np.unpackbits(rows, axis=1, bitorder="little").T, axis=1)
        else:
            columns = np.ascontiguousarray(rows.T)
        planes += [packer.compress(c.tobytes()) for c in columns]
    sizes = np.array([len(p) for p in planes], "<u4").tobytes()
    return b"".join([HEADER.pack(MAGIC, len(ids), block, kind, len(planes)), sizes, *planes])


def decode_chunk(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``last`` of a chunk; only the blocks that hold them are decompressed."""
    magic, n, block, kind, entries = HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a chunk of token ids")
    last = n if last is None else min(n, last)
    sizes = np.frombuffer(data, "<u4", entries, HEADER.size).astype(np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes))) + HEADER.size + 4 * entries
    per = 32 if kind == BIT_PLANES else 4
    unpacker = zstandard.ZstdDecompressor()
    out = [np.empty(0, np.uint32)]
    for b in range(first // block, -(-last // block)):
        size = min(block, n - b * block)
        rows = [
            np.frombuffer(unpacker.decompress(data[starts[k] : starts[k + 1]]), np.uint8)
            for k in range(b * per, (b + 1) * per)
        ]
        if kind == BIT_PLANES:
            rows = np.packbits(np.stack([np.unpackbits(r, count=size) for r in rows]).T, axis=1, bitorder="little")
        else:
            rows = np.stack(rows).T
        out.append(np.ascontiguousarray(rows).view("<u4").reshape(-1))
    skipped = first // block * block
    return np.concatenate(out)[first - skipped : max(first, last) - skipped]


CHUNKS = "shard int, chunk int, first long, n_ids long, data binary, doc_ids array<long>, doc_sizes array<long>"


def write_tokens(
    docs: DataFrame, path: str, end_id: int = 2, vocabulary: str = VOCABULARY, block: int = BLOCK, kind: int = BYTE_PLANES
) -> None:
    """Write the ids of every whole text, ``end_id`` after each, in ascending doc_id order.

    Spark deals the documents out by ranges of doc_id and sorts each range: a shard. Null texts are empty and null ids come
    first. Documents are never cut at a chunk's end, so a chunk is as long as its last document asks for.
    """
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        chunk = first = 0
        parts: list[bytes] = []
        names: list[int | None] = []

        def row() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            sizes = [len(p) // 4 for p in parts]
            values = ([shard], [chunk], [first], [len(ids)], [encode_chunk(ids, block, kind)], [names], [sizes])
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], fields)

        held = 0
        for batch in batches:
            for rows in slices(batch):
                texts = encode_texts(rows.column("text"), vocabulary)
                for name, ids in zip(rows.column("doc_id").to_pylist(), texts, strict=True):
                    parts.append(ids + end)
                    names.append(name)
                    held += len(ids) // 4 + 1
                    if held >= CHUNK:
                        yield row()
                        chunk, first, held, parts, names = chunk + 1, first + held, 0, [], []
        if parts:
            yield row()

    longs = pa.list_(pa.int64())
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), longs, longs]
    fields = ["shard", "chunk", "first", "n_ids", "data", "doc_ids", "doc_sizes"]
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    # The planes are compressed already.
    ordered.mapInArrow(run, CHUNKS).write.option("compression", "uncompressed").parquet(path)


def shard_starts(spark: SparkSession, path: str) -> np.ndarray:
    """For each shard the ids of all shards before it.

    The index has one row per shard, and there are no more shards than Spark has shuffle partitions, so it fits the driver.
    """
    sums = spark.read.schema(CHUNKS).parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()
    starts = np.zeros(max((r.shard for r in sums), default=-1) + 2, np.int64)
    for r in sums:
        starts[r.shard + 1] = r.n
    return np.cumsum(starts)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned 32-bit), from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids = decode_chunk(batch.column("data")[k].as_py()).astype("<u4")
                sizes = batch.column("doc_sizes")[k].values.to_numpy()
                ends = np.cumsum(sizes)
                starts = ends - sizes
                base = starts_of[batch.column("shard")[k].as_py()] + batch.column("first")[k].as_py()
                blobs = [ids[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [batch.column("doc_ids")[k].values, pa.array(base + starts), pa.array(sizes), pa.array(blobs, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])

    starts_of = shard_starts(spark, path)
    return spark.read.schema(CHUNKS).parquet(path).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary"
    )
