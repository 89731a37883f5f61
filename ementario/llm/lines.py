"""Line deduplication: explode, hash, count distinct documents, drop, reassemble by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ementario.llm.columns import BLANKS, ascii_lower, let
from ementario.session import materialize


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return F.trim(line, F.lit(BLANKS))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Drop lines that many documents share, except in the document with the largest id.

    A line's key is hashed to 128 bits. Keys of at least ``min_chars`` characters found in at least
    ``min_docs`` distinct doc_ids lose all their lines but those in the largest doc_id holding them. All columns
    stay, ``text`` is rewritten and ``n_lines`` and ``n_dropped`` are added (columns of that name are replaced).
    Null and empty texts count one empty line and become the empty string. Rows that share a doc_id are one
    document for counting; each is rewritten by its own lines. A null doc_id is never counted and its lines
    go where others hold the key. Only hashes are shuffled for counting, with map-side partials, so that a
    line found everywhere is one row per task; texts are shuffled once, with the few positions to drop.
    """
    rows = docs.withColumn("_row", F.struct("doc_id", F.xxhash64("text").alias("h")))
    keyed = rows.select("_row", F.posexplode(_lines(ascii_lower(F.col("text")))).alias("pos", "line")).select(
        "_row", "pos", line_key(F.col("line")).alias("key")
    ).where(F.char_length("key") >= min_chars)
    # Two seeds make 128 bits: no two keys meet by chance even among 10^12 lines.
    hashed = keyed.select("_row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))
    # What is read twice is written once: 30 bytes a line.
    hashed = materialize(hashed, "line-hashes")
    shared = hashed.groupBy("h1", "h2").agg(
        F.countDistinct("_row.doc_id").alias("n"), F.max("_row.doc_id").alias("last")
    ).where(F.col("n") >= min_docs).select("h1", "h2", "last")
    # Written too: a join of two plain exchanges lets Spark split the rows of a frequent line.
    shared = materialize(shared, "line-shared")
    dropped = hashed.join(shared, ["h1", "h2"]).where(~F.col("_row.doc_id").eqNullSafe(F.col("last")))
    # Repeated rows yield the same positions more than once.
    dropped = dropped.groupBy("_row").agg(F.collect_set("pos").alias("_drop")).withColumnRenamed("_row", "_row_d")

    joined = rows.join(dropped, F.col("_row").eqNullSafe(F.col("_row_d")), "left")
    lines = _lines(F.col("text"))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_drop"))  # by a hash set, in order
    kept = let(lines, lambda x: F.array_join(F.transform(stay, lambda i: F.get(x, i)), "\n"))
    text = F.when(F.col("_drop").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept)
    gone = F.coalesce(F.array_size("_drop"), F.lit(0))
    return joined.withColumns({
        "n_lines": F.size(lines).cast("long"), "n_dropped": gone.cast("long"), "text": text,
    }).drop("_row", "_row_d", "_drop")
