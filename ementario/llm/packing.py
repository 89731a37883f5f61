"""Best-fit packing of token sequences by exact complements.

Only the number of pieces of each length matters to the plan, so it is made from a histogram: for the longest length
left, its gap is closed exactly by one, two or three lengths found in an index of sums, for as many copies as there
are; where nothing closes it exactly, the longest length that fits goes in and the rest of the gap is
tried again. Spark ranks the pieces of each length, and a piece's rank says which place of the plan is its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ementario.llm.tokens import VOCABULARY, encode_texts, slices
from ementario.session import materialize

END = b"\0\0\0\0"
#: Pieces of one length are ranked in groups of about so many rows.
RANKED = 100_000


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids; only the first may be shorter than ``most``."""
    first = n % most or most
    return [(0, first), *((at, most) for at in range(first, n, most))] if n > most else [(0, n)]


def token_pieces(docs: DataFrame, most: int = 2048, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ``ids`` of every document, id 0 at its end.

    Null text is empty: its one piece holds the end id alone. Repeated rows are pieces of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
                texts = encode_texts(rows.column("text"), vocabulary)
                for doc_id, ids in zip(rows.column("doc_id").to_pylist(), texts, strict=True):
                    ids += END
                    for k, (start, length) in enumerate(cut(len(ids) // 4, most)):
                        part = ids[4 * start : 4 * (start + length)]
                        values = (doc_id, k, start, length, zlib.crc32(part), part)
                        for column, v in zip(out.values(), values, strict=True):
                            column.append(v)
                if not with_ids:
                    del out["ids"]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=False)], list(out))

    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


class Sums:
    """The lengths that are left, and for each sum how many of its pairs of lengths can be taken.

    Pairs are counted once, at the start, and the counts follow each length as it runs out or comes down to one piece.
    """

    def __init__(self, counts: np.ndarray) -> None:
        self.left = np.zeros_like(counts)
        self.have = np.zeros(len(counts), bool)
        self.pairs = np.zeros(2 * len(counts), np.int64)
        for x in np.flatnonzero(counts[1:]) + 1:
            self.add(int(x), int(counts[x]))

    def add(self, x: int, n: int) -> None:
        """``n`` more pieces of length x, or fewer if it is negative."""
        before, after = int(self.left[x]), int(self.left[x]) + n
        self.left[x] = after
        if (before > 0) != (after > 0):
            self.have[x] = False
            others = np.flatnonzero(self.have)
            self.pairs[others + x] += 1 if after else -1
            self.have[x] = after > 0
        self.pairs[2 * x] += (after > 1) - (before > 1)

    def pair(self, total: int, most: int) -> tuple[int, int] | None:
        """The pair of this sum whose longer length is the longest that is at most ``most``."""
        if total < 2 or not self.pairs[total]:
            return None
        a = np.arange((total + 1) // 2, min(most, total - 1, len(self.left) - 1) + 1)
        fits = a[self.have[a] & self.have[total - a] & ((2 * a != total) | (self.left[a] > 1))]
        return (int(fits[-1]), total - int(fits[-1])) if len(fits) else None

    def complement(self, gap: int) -> tuple[int, ...]:
        """One, two or three lengths that are left and fill the gap exactly, the longest first; empty if there are none."""
        if self.have[gap]:
            return (gap,)
        if two := self.pair(gap, gap):
            return two
        a = np.arange(-(-gap // 3), gap - 1)  # the longest of three is at least a third of the gap
        a = a[self.have[a] & (self.pairs[gap - a] > 0)]
        for x in a[::-1].tolist():
            self.add(x, -1)  # not to be taken twice where one is left
            two = self.pair(gap - x, x)
            self.add(x, 1)
            if two:
                return (x, *two)
        return ()


def complement(left: np.ndarray, gap: int) -> tuple[int, ...]:
    """``Sums.complement`` for lengths that are counted only for this gap."""
    return Sums(left).complement(gap)


def plan(counts: np.ndarray, most: int) -> list[tuple[int, tuple[int, ...]]]:
    """(times, lengths) of the sequences that use every piece; ``counts[l]`` pieces have length l.

    Each entry uses up a length, or all but fewer of it than one sequence takes, so that the plan has at most a few
    entries for each length, however many pieces there are.
    """
    sums = Sums(counts)
    left = sums.left
    out = []
    for longest in range(most, 0, -1):
        while left[longest]:
            lengths, gap = [longest], most - longest
            sums.add(longest, -1)
            taken = [longest]
            while gap:
                if exact := sums.complement(gap):
                    lengths += exact
                    gap = 0
                    for x in exact:
                        sums.add(x, -1)
                    taken += exact
                    break
                fits = np.flatnonzero(left[1 : gap + 1])
                if not len(fits):
                    break
                best = int(fits[-1]) + 1
                lengths.append(best)
                sums.add(best, -1)
                taken.append(best)
                gap -= best
            more = min(int(left[x]) // taken.count(x) for x in set(taken))
            for x in taken:
                sums.add(x, -more)
            out.append((1 + more, tuple(lengths)))
    return out


def places(entries: list[tuple[int, tuple[int, ...]]], most: int) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted: ranks from the first on take the sequences from the first on."""
    rank = np.zeros(most + 1, np.int64)
    rows = []
    sequence = 0
    for times, lengths in entries:
        offset = 0
        for x in lengths:
            rows.append((x, int(rank[x]), sequence, offset))
            rank[x] += times
            offset += x
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """Pieces with ``rank``: their number among those of their length, from 0. A common length is many small groups."""
    salts = max(1, total // RANKED)
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts))
    salted = pieces.withColumn("salt", salt)
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "salt", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    return salted.withColumn("k", F.row_number().over(order) - 1).join(bases, ["length", "salt"]).withColumn(
        "rank", F.col("base") + F.col("k")
    ).drop("salt", "k", "base")


def pack(pieces: DataFrame, most: int = 2048) -> DataFrame:
    """The rows of ``pieces`` (written ones: they are read three times) with ``sequence_id`` and ``offset``.

    The driver sees the histogram, ``most`` rows, and sends out the plan, a few rows for each length. An empty table
    gives an empty result; equal pieces are interchangeable and each has its own place.
    """
    counts = np.zeros(most + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most ``most`` rows
        counts[row["length"]] = row["count"]
    table = places(plan(counts, most), most)
    keys = table[:, 0] << 44 | table[:, 1]
    fields = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            found = table[at]
            sequence = found[:, 2] + rank - found[:, 1]
            columns = [batch.column(f) for f in fields[:5]] + [pa.array(sequence), pa.array(found[:, 3])]
            yield pa.RecordBatch.from_arrays(columns, fields)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked(pieces, int(counts.sum())).select(*fields[:5], "rank").mapInArrow(run, schema)


def pack_documents(docs: DataFrame, most: int = 2048, vocabulary: str = VOCABULARY) -> DataFrame:
    """Where each piece of each document goes: see ``token_pieces`` and ``pack``."""
    return pack(materialize(token_pieces(docs, most, vocabulary), "packing-pieces"), most)


def sequences(docs: DataFrame, placed: DataFrame, most: int = 2048, vocabulary: str = VOCABULARY) -> DataFrame:
    """sequence_id and ``ids`` of the packed sequences, from the documents and the places of their pieces.

    For tables without repeated (doc_id, piece); a sequence has at most ``most`` ids.
    """
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = token_pieces(docs, most, vocabulary, with_ids=True).join(placed, keys)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return whole.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids")
    )
