"""Filter interaction audit: what five filters do to each part of the corpus in every order, by wide packed counters.

Which filters a document fails is a mask of five bits. Every mask (with two label bits) stands for one big integer, whose fields
of 64 bits hold what happens to such a document at each of the 600 steps of the 120 orders. The sum of the integers
of a part's documents holds all its counts, whatever their number: a field counts documents, of which there are
fewer than 2^63, so none runs over into the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ementario.llm.columns import let, words
from ementario.session import materialize

FILTERS = "ABCDE"
ORDERS = tuple("".join(p) for p in permutations(FILTERS))
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
SHAPE = (len(ORDERS), len(FILTERS), len(COUNTS))
#: Bits of a code beyond the five of the filters.
GOOD, TOXIC, CODES = 32, 64, 128
#: Parts that a task holds at once, and integers that are added up in one group.
PARTS, FAN_IN = 1000, 256


@cache
def packed(code: int) -> int:
    """The integer of one document that fails the filters of ``code`` and has its labels."""
    fails = {f for k, f in enumerate(FILTERS) if code >> k & 1}
    fields = np.zeros(SHAPE, dtype="<u8")
    for o, order in enumerate(ORDERS):
        gone = False
        for s, f in enumerate(order):
            here = f in fails and not gone
            redundant = f in fails and gone
            gone = gone or here
            fields[o, s] = (
                not gone, here, redundant, fails == {f}, here and bool(code & GOOD), here and bool(code & TOXIC)
            )
    return int.from_bytes(fields.tobytes(), "little")


def pack(counts: np.ndarray) -> int:
    """The sum of the integers of ``counts[code]`` documents of each code."""
    return sum(int(n) * packed(code) for code, n in enumerate(counts) if n)


def unpack(total: int) -> np.ndarray:
    """The fields of a sum: order, step, count."""
    return np.frombuffer(total.to_bytes(int(np.prod(SHAPE)) * 8, "little"), dtype="<u8").reshape(SHAPE)


def failures(text: Column) -> Column:
    """Bits of the filters A to D; null text is empty."""
    text = F.coalesce(text, F.lit(""))

    def short_or_repetitive(w: Column) -> Column:
        n = F.size(w)
        return F.when(n < 100, 1).otherwise(0) + F.when(100 * F.size(F.array_distinct(w)).cast("long") < 80 * n.cast("long"), 2).otherwise(0)

    capitals, chars = F.regexp_count(text, F.lit("[A-Z]")).cast("long"), F.char_length(text).cast("long")
    loud = F.when(100 * capitals > 10 * chars, 4).otherwise(0)
    signs = F.when(F.regexp_like(text, F.lit("[#$%&*|]")), 8).otherwise(0)
    return let(words(text), short_or_repetitive) + loud + signs


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, code, n``: documents of each text, part and code, filter E included.

    A text is compared by its SHA-256. All rows of one text and code are one row after a map-side partial, whatever the number
    of copies; then the smallest doc_id of a text is the smallest of its few rows.
    """
    rows = docs.select(
        F.col("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), failures(F.col("text")).alias("code"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("digest"),
    )
    marks = labels.groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, GOOD).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, TOXIC).otherwise(0)).alias("toxic")
    )
    # Measured once, below the write: a join's filters cannot run the measuring a second time.
    marked = materialize(rows, "audit-masks").join(marks, "doc_id", "left")
    code = F.col("code") + F.coalesce("good", F.lit(0)) + F.coalesce("toxic", F.lit(0))
    once = marked.groupBy("doc_id", "digest", "part", code.alias("code")).agg(F.count("*").alias("m"))  # repeated rows
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "m")))
    texts = once.groupBy("digest", "part", "code").agg(
        F.sum("m").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("m")).otherwise(0)).alias("no_id"), first.alias("first")
    )
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))  # rows of a text: parts and codes, not copies
    own = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.m")).otherwise(0)
    split = texts.withColumn("least", least).withColumn("fresh", F.col("no_id") + own)
    both = F.array(
        F.struct(F.col("code").alias("code"), F.col("fresh").alias("n")),
        F.struct((F.col("code") + 16).alias("code"), (F.col("n") - F.col("fresh")).alias("n")),
    )
    return split.select("part", F.inline(both))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part the sum of the integers of this task's documents."""
    held: dict[str, np.ndarray] = {}

    def out() -> pa.RecordBatch:
        totals = [pack(c).to_bytes(int(np.prod(SHAPE)) * 8, "little") for c in held.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(totals, pa.binary())], names=["part", "total"])

    for batch in batches:
        parts = batch.column("part").dictionary_encode()
        where = parts.indices.to_numpy().astype(np.int64) * CODES + batch.column("code").to_numpy()
        added = np.zeros(len(parts.dictionary) * CODES, dtype=np.int64)
        np.add.at(added, where, batch.column("n").to_numpy())
        for part, counts in zip(parts.dictionary.to_pylist(), added.reshape(-1, CODES), strict=True):
            held[part] = held[part] + counts if part in held else counts
        if len(held) >= PARTS:
            yield out()
            held.clear()
    if held:
        yield out()


def _total(table: pa.Table) -> int:
    return sum(int.from_bytes(b.as_py(), "little") for b in table.column("total"))


def _merged(table: pa.Table) -> pa.Table:
    total = _total(table).to_bytes(int(np.prod(SHAPE)) * 8, "little")
    return pa.table({"part": table.column("part").slice(0, 1).cast(pa.string()), "total": pa.array([total], pa.binary())})


def _rows(table: pa.Table) -> pa.Table:
    """The 600 rows of a part."""
    fields = unpack(_total(table)).astype(np.int64)
    place = np.array([[order.index(f) for f in FILTERS] for order in ORDERS])  # order, filter -> step
    removed = np.take_along_axis(fields[:, :, COUNTS.index("removed")], place, axis=1).sum(axis=0)  # by filter
    letters = np.array([[FILTERS.index(f) for f in order] for order in ORDERS])
    n = len(ORDERS) * len(FILTERS)
    return pa.table({
        "part": pa.array([table.column("part")[0].as_py()] * n, pa.string()),
        "filter_order": pa.array([o for o in ORDERS for _ in FILTERS], pa.string()),
        "step": pa.array(np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))),
        **{c: pa.array(fields[:, :, k].ravel()) for k, c in enumerate(COUNTS)},
        "shapley": pa.array(removed[letters].ravel()),
    })


RESULT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in (*COUNTS, "shapley"))


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (lang; null is the empty string), order of the five filters and step, with counts of documents.

    Null text is empty. A row without doc_id never fails E and is nobody's earlier copy; rows that share doc_id and text are
    no copies of each other and count each. Several labels of one document count as good or toxic if one of them says so.
    Other columns are left out, so none can clash; an empty table gives an empty result. Each task adds up its own
    documents, then at most ``FAN_IN`` integers (of 28,800 bytes) are added at a time, so that no group holds more than a bounded number of them.
    """
    sums = mask_counts(docs, labels).mapInArrow(_sums, "part string, total binary")
    sums = materialize(sums.withColumn("lot", F.floor(F.spark_partition_id() / FAN_IN)), "audit-sums")
    lots = sums.groupBy("part", "lot").applyInArrow(_merged, "part string, total binary")
    return lots.groupBy("part").applyInArrow(_rows, RESULT)
