"""Quality rules whose cutoffs come from the data: mergeable quantile sketches per language and source.

The sketch of a measure is a histogram over logarithmic bins (relative error ``ACCURACY``). Two
sketches merge by adding their counts, so one aggregate with map-side partials builds them, a
language's sketch is the sum of its sources' sketches, and the corpus' sketch that of its languages'.
No rows are sampled and the result does not depend on their order.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ementario.llm.columns import let, words
from ementario.session import materialize

#: Relative error of a quantile read from a sketch.
ACCURACY = 0.02
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
#: Values up to this one share the bin of zero.
TINY = 1e-3


@dataclass(frozen=True)
class Measure:
    """A ratio ``count`` / ``of``; ``unit`` is what one event adds to the count. A mean has no counts."""

    name: str
    count: str | None = None
    of: str | None = None
    unit: int = 0


MEASURES = (
    Measure("symbol_ratio", "n_symbols", "n_words", 1),
    Measure("dup_line_ratio", "n_dup_lines", "n_lines", 1),
    # A three-word window that occurs twice covers six words.
    Measure("repeat_ratio", "n_repeat_words", "n_words", 6),
    Measure("word_length"),
)
#: The quantiles that a fence is read from, and how many times their distance it lies above the upper one.
MIDDLE, UPPER, REACH = 0.5, 0.9, 3
#: A group's own fence counts as its documents do, its parent's as so many more.
PRIOR = 200
#: Deviations and events by which a document may be above the fence by chance.
CHANCE = 3


def repeated_words(ws: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the list."""

    def covered(at: Column) -> Column:  # sorted window starts
        steps = F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, s: acc + s)

    def starts(by_hash: Column) -> Column:
        def twice(x: Column, k: Column) -> Column:
            def same(y: Column) -> Column:
                return F.coalesce(y["h"] == x["h"], F.lit(False))

            return same(F.get(by_hash, k - 1)) | same(F.get(by_hash, k + 1))

        return F.array_sort(F.transform(F.filter(by_hash, twice), lambda x: x["i"]))

    def count(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            let(F.array_sort(pairs), lambda by_hash: let(starts(by_hash), covered))
        )

    def windows(w: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        )
        return F.when(F.size(w) < 3, F.lit(0).cast("long")).otherwise(let(each, count))

    return let(ws, windows)


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, t (a hash of the text) and the base counts of every text.

    Null text has no words and no lines. Other columns are left out, so none can clash.
    """
    text = F.coalesce(F.col("text"), F.lit(""))

    def measure(w: Column) -> Column:
        lines = F.filter(F.split(text, "\n", -1), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.struct(
                F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")
            )).alias("lines"),
            repeated_words(w).alias("n_repeat_words"),
        )

    # A filter on a computed column would run the measuring twice, so none follows before the write.
    measured = docs.select("doc_id", "lang", "source", F.xxhash64("text").alias("t"), let(words(F.col("text")), measure).alias("m"))
    return measured.select(
        "doc_id", "lang", "source", "t", "m.n_words", "m.word_chars", "m.n_symbols",
        F.col("m.lines.n").alias("n_lines"), F.col("m.lines.dup").alias("n_dup_lines"), "m.n_repeat_words",
    )


def with_measures(counts: DataFrame) -> DataFrame:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return counts.withColumns({
        "symbol_ratio": F.col("n_symbols") / n,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
        "repeat_ratio": F.col("n_repeat_words") / n,
        "word_length": F.col("word_chars") / n,
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    })


def bin_of(value: Column) -> Column:
    return F.when(value <= TINY, F.lit(-1_000_000)).otherwise(F.ceil(F.log(value) / math.log(GAMMA)).cast("int"))


def bin_value(b: Column) -> Column:
    return F.when(b == -1_000_000, F.lit(0.0)).otherwise(F.pow(F.lit(GAMMA), b) * (2 / (1 + GAMMA)))


def sketches(measured: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group, measure and bin, with the number of documents in it."""
    pairs = F.array(*(F.struct(F.lit(m.name).alias("measure"), bin_of(F.col(m.name)).alias("bin")) for m in MEASURES))
    return measured.select(*keys, F.explode(pairs).alias("p")).groupBy(*keys, "p.measure", "p.bin").agg(
        F.count("*").alias("n")
    )


def merge(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser groups, from those of finer ones."""
    return sketch.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Per group and measure: its document count and the upper fence, read from the sketch alone."""
    by = Window.partitionBy(*keys, "measure")
    upto = by.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketch.withColumns({"below": F.sum("n").over(upto), "total": F.sum("n").over(by)})

    def quantile(q: float) -> Column:
        return bin_value(F.min(F.when(F.col("below") >= q * F.col("total"), F.col("bin"))))

    middle, upper = quantile(MIDDLE), quantile(UPPER)
    return ranked.groupBy(*keys, "measure").agg(F.max("total").alias(f"{name}_n"), (upper + REACH * (upper - middle)).alias(name))


def thresholds(measured: DataFrame) -> DataFrame:
    """One row per language and source with a fence for each measure.

    Sketches hold the documents that pass the base rule, so what is rejected anyway sets no standard. Less than a tenth of a
    group may be junk for its fence to show it. A source's fence is weighed against its language's, a language's
    against the corpus' one, by the number of its documents: there is no size at which one takes over from the other.
    Null languages and sources are groups of their own.
    """
    fine = sketches(measured.where("NOT base_failed"), ["lang", "source"])
    by_lang = merge(fine, ["lang"])
    own, lang = fences(fine, ["lang", "source"], "own"), fences(by_lang, ["lang"], "langs")
    whole = fences(merge(by_lang, []), [], "whole")
    joined = own.join(lang.withColumnRenamed("measure", "measure_l").withColumnRenamed("lang", "lang_l"),
                      F.col("lang").eqNullSafe(F.col("lang_l")) & (F.col("measure") == F.col("measure_l")))
    joined = joined.join(whole, "measure")

    def weighed(n: str, fence: str, parent: Column) -> Column:
        return (F.col(n) * F.col(fence) + PRIOR * parent) / (F.col(n) + PRIOR)

    limit = weighed("own_n", "own", weighed("langs_n", "langs", F.col("whole")))
    return joined.groupBy("lang", "source").agg(
        *(F.max(F.when(F.col("measure") == m.name, limit)).alias(f"max_{m.name}") for m in MEASURES)
    )


def above(m: Measure) -> Column:
    """Whether a document is above its group's fence by more than chance.

    A ratio is compared as a count: a few events in a short text, or as many more than the fence as a count deviates, are no
    outlier. A mean is compared as it is, but for the sketch's error.
    """
    fence = F.col(f"max_{m.name}")
    if m.count is None:
        return F.col(m.name) > fence * (1 + 2 * ACCURACY)
    expected = F.col(m.of) * fence
    return F.col(m.count) > expected + CHANCE * F.sqrt(m.unit * expected) + CHANCE * m.unit


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """Every document with its counts, ``base_failed`` and ``kept``.

    A document is kept if the base rule holds and no measure is above its group's fence (see ``above``). Texts are read
    once and never shuffled; the counts are written to the shared folder for the two passes over them.
    An empty table gives an empty result; repeated rows are judged each; null text fails the base rule.
    """
    return row_verdicts(docs).drop("lang", "source", "t")


def row_verdicts(docs: DataFrame) -> DataFrame:
    """``quality_verdicts`` with lang, source and t, the hash of the text: rows equal in these and doc_id have one verdict."""
    counts = with_measures(materialize(text_counts(docs), "quality-counts"))
    limits = thresholds(counts).withColumnsRenamed({"lang": "lang_t", "source": "source_t"})
    limits = materialize(limits, "quality-limits")
    over = F.lit(False)
    for m in MEASURES:
        over = over | F.coalesce(above(m), F.lit(False))
    same = F.col("lang").eqNullSafe(F.col("lang_t")) & F.col("source").eqNullSafe(F.col("source_t"))
    return counts.join(limits, same, "left").select(
        "lang", "source", "t", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~over).alias("kept"),
    )
