"""Benchmark decontamination: a broadcast hash set of test windows, scanned over the windows of every training text.

Every hit is verified by its words. Hits are spans of words, from which documents are reported, cut or dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ementario.llm.columns import ascii_lower, let
from ementario.session import materialize

#: Words are runs of ASCII letters and digits and of all characters beyond ASCII. What they hold is spelt out: Java takes many
#: times as long for the negated class, which is the same.
WORD, GAP = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WIDTH = 10
#: Windows that are broadcast at once, some 100 bytes each. A larger benchmark takes more than one scan of the documents.
BLOCK = 400_000


def test_words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; null has none."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP), lambda w: w != "")


test_words.__test__ = False  # a name that pytest would take for a test


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _window_hash(hashes: Column, start: Column, size: Column) -> Column:
    """Of ``size`` words from ``start`` (counted from 0), by the hashes of the words."""
    return F.xxhash64(F.slice(hashes, start + 1, size))


def _window_text(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start + 1, size), " ")


def item_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """``item_id, size, h, window``: every ``width`` consecutive words of an item, or all words of a shorter one."""
    items = benchmark.select("item_id", test_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    items = items.withColumn("size", F.least(F.size("w"), F.lit(width)))

    def windows(w: Column) -> Column:
        return let(_hashes(w), lambda hs: F.transform(
            F.sequence(F.lit(0), F.size(w) - F.col("size")),
            lambda i: F.struct(_window_hash(hs, i, F.col("size")).alias("h"), _window_text(w, i, F.col("size")).alias("window")),
        ))

    return items.select("item_id", "size", F.inline(let(F.col("w"), windows))).distinct()


def find_hits(docs: DataFrame, windows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``doc_id, t, pos, size, window``: where a test window occurs; t is a hash of the text, pos the first word, from 0.

    ``windows`` are those of ``item_windows``, written. They are broadcast as distinct windows, at most about ``block`` at once:
    a larger benchmark is dealt out by hash, and the documents are scanned once for each part, so that no size is broadcast
    unchecked and no window of a document is ever shuffled.
    """
    distinct = windows.select("size", "h", "window").distinct()
    sizes = [r["size"] for r in distinct.select("size").distinct().collect()]  # at most as many as WIDTH
    parts = -(-distinct.count() // block)
    schema = docs.select("doc_id", F.xxhash64("text").alias("t"), F.lit(0).alias("pos"), F.lit(0).alias("size"), F.lit("").alias("window"))
    hits = schema.where("false")
    for part in range(parts):
        # Only known windows are compared: the hash finds them, their words verify them.
        known = distinct.where(F.pmod("h", F.lit(parts)) == part).withColumnRenamed("size", "n")
        texts = docs.select("doc_id", F.xxhash64("text").alias("t"), test_words(F.col("text")).alias("w"))
        sized = texts.select("*", F.explode(F.array(*map(F.lit, sizes))).alias("size"))

        def every(w: Column) -> Column:
            starts = F.sequence(F.lit(0), F.size(w) - F.col("size"))
            return F.when(F.size(w) >= F.col("size"), let(
                _hashes(w), lambda hs: F.transform(starts, lambda i: _window_hash(hs, i, F.col("size")))
            ))

        spans = sized.select("*", F.posexplode(let(F.col("w"), every)).alias("pos", "h"))
        met = spans.join(F.broadcast(known), "h").where(
            (F.col("size") == F.col("n")) & (_window_text(F.col("w"), F.col("pos"), F.col("size")) == F.col("window"))
        )
        hits = hits.union(materialize(met.select("doc_id", "t", "pos", "size", "window"), "leak-hits"))
    return hits


def covered_words(hits: DataFrame) -> DataFrame:
    """``doc_id, t, n_hit``: words inside any hit, each counted once. Rows that share doc_id and text share their hits."""
    end = F.col("pos") + F.col("size")
    before = Window.partitionBy("doc_id", "t").orderBy("pos", "size").rowsBetween(Window.unboundedPreceding, -1)
    fresh = end - F.greatest("pos", F.coalesce(F.max(end).over(before), F.lit(0)))  # a document's rows are as many as its words
    return hits.select("doc_id", "t", F.greatest(fresh, F.lit(0)).alias("fresh")).groupBy("doc_id", "t").agg(
        F.sum("fresh").cast("long").alias("n_hit")
    )


def hit_items(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """``doc_id, t, items``: the ids of items with a window in the document, as sorted text. Items without id are left out."""
    once = hits.select("doc_id", "t", "window").distinct()
    found = once.join(windows.where("item_id IS NOT NULL").select("window", "item_id"), "window")
    return found.groupBy("doc_id", "t").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))


def _beside(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with what was found for their doc_id and text; null ids are equal to each other."""
    found = found.withColumnsRenamed({"doc_id": "doc_id_f", "t": "t_f"})
    same = F.col("doc_id").eqNullSafe(F.col("doc_id_f")) & F.col("t").eqNullSafe(F.col("t_f"))
    return rows.join(found, same, "left").drop("doc_id_f", "t_f")


def report(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items, contaminated``.

    Null and empty texts have no words and are clean; an empty benchmark leaves all clean; items without words match
    nothing. Repeated rows are reported each. Windows of items without an id count as hits and are in no list. Only
    hits are shuffled, by document; other columns of both tables are left out, so none can clash.
    """
    windows = materialize(item_windows(benchmark, width), "leak-windows")
    hits = find_hits(docs, windows)
    rows = docs.select("doc_id", F.xxhash64("text").alias("t"), F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("n_words"))
    found = _beside(_beside(rows, covered_words(hits)), hit_items(hits, windows))
    return found.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", width: int = WIDTH) -> DataFrame:
    """The documents without test material; all columns stay.

    ``remove="documents"`` drops every row with a hit. ``remove="spans"`` cuts hit words and what stands between two of them
    out of ``text``, and leaves everything else as it was; a text without hits is unchanged, null stays null.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove must be spans or documents, not {remove}")
    hits = find_hits(docs, materialize(item_windows(benchmark, width), "leak-windows"))
    place = F.explode(F.sequence("pos", F.col("pos") + F.col("size") - 1)).alias("k")
    gone = hits.select("doc_id", "t", place).distinct().groupBy("doc_id", "t").agg(F.collect_list("k").alias("_gone"))
    rows = docs.withColumn("_t", F.xxhash64("text"))
    gone = gone.withColumnsRenamed({"doc_id": "_doc_id", "t": "_t_f"})
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("_t").eqNullSafe(F.col("_t_f"))
    if remove == "documents":
        return rows.join(gone, same, "left_anti").drop("_t")

    first = F.when(F.regexp_like("text", F.lit("^" + GAP)), F.lit(1)).otherwise(F.lit(0))  # words and gaps alternate

    def kept(pieces: Column) -> Column:
        both = F.array_intersect("_gone", F.transform("_gone", lambda k: k - 1))  # words whose next word goes as well
        drop = F.concat(F.transform("_gone", lambda k: 2 * k + first), F.transform(both, lambda k: 2 * k + 1 + first))
        stay = F.array_except(F.sequence(F.lit(0), F.size(pieces) - 1), drop)
        return F.array_join(F.transform(stay, lambda i: F.get(pieces, i)), "")

    pieces = F.regexp_extract_all("text", F.lit(f"{WORD}|{GAP}"), F.lit(0))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(let(pieces, kept))
    return rows.join(gone, same, "left").withColumn("text", text).drop("_t", "_doc_id", "_t_f", "_gone")
