"""Spelling variants: words one edit apart, by a frontier of states walked over a distributed trie, level by level.

An edit lies in one block of a word; what stands before and after the block is the same in both words. So each word enters
one trie for each block, rooted at all that lies outside of it, and only the block is walked. A word of up to 2 * ``SPAN``
characters has two blocks, its halves: the number of levels is bounded by ``SPAN`` for words of any length, and a trie
holds only words that share half of their characters. Edges and states are tables; a level is one join of the two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ementario.llm.columns import ascii_lower
from ementario.session import materialize, scratch_path

#: A-Z, a-z and À-ÿ one by one and not as ranges: Java looks single Latin-1 characters up in a table, but tests range after range.
LETTER = f"[{''.join(map(chr, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]))}]"
#: One run in so many loses a character, so that variants are there to be found.
TYPOS = 31
LEAST_CHARS, LEAST_TIMES = 7, 2
#: Characters of a block.
SPAN = 12
#: A form must be so many times as frequent as its variant.
TIMES = 10
#: Letters share these bits of a mask; one more says that a word ends.
BITS = 62
END = 1 << BITS


def word_counts(docs: DataFrame, least_chars: int = LEAST_CHARS, least_times: int = LEAST_TIMES) -> DataFrame:
    """``word, n``: the runs of letters of all texts, A-Z lower-cased, some of them with one character lost.

    Runs shorter than ``least_chars`` can give no word, so they are never taken out. Counts have map-side partials.
    """
    long_runs = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"{LETTER}{{{least_chars},}}"), F.lit(0))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(long_runs).alias("run"))
    # Of a run of ASCII letters this is what ``lower`` does, which does not look each character up.
    low = F.when(F.octet_length("run") == F.char_length("run"), F.lower("run")).otherwise(ascii_lower(F.col("run")))
    runs = runs.select("id", low.alias("run"))
    runs = runs.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"), F.char_length("run").alias("m"))
    at = (F.col("h") % F.col("m")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.col("m")))
    words = runs.select(F.when(F.col("h") % TYPOS == 0, cut).otherwise(F.col("run")).alias("word"))
    words = words.where(F.char_length("word") >= least_chars)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_times)


def _bit(letter: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(letter) % BITS)


def _left(text: Column, n: Column) -> Column:
    return text.substr(F.lit(1), n.cast("int"))


def blocks(words: DataFrame) -> DataFrame:
    """``word, root, mid, asks``: each word's place in the tries that may hold a neighbour of it.

    A trie belongs to a length and a block of that length, and is rooted at the characters outside of the block. A word asks in
    the tries of its own length; it can be found there and, with one more character in the block, in those of the
    length below. Roots under which no other word stands are left out.
    """
    m = F.char_length("word")
    sized = words.select("word", m.alias("m"), F.explode(F.array(m, m - 1)).alias("size"))
    n = F.greatest(F.lit(2), F.ceil(F.col("size") / SPAN)).cast("int")
    cut = sized.select("*", n.alias("of")).select("*", F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("b"))
    start = F.floor(F.col("b") * F.col("size") / F.col("of")).cast("int")
    after = (F.col("size") - F.floor((F.col("b") + 1) * F.col("size") / F.col("of"))).cast("int")
    cut = cut.select("word", "m", "size", "b", start.alias("s"), after.alias("a"))
    word = F.col("word")
    root = F.xxhash64("size", "b", _left(word, F.col("s")), word.substr(F.col("m") - F.col("a") + 1, F.col("a")))
    mid = word.substr(F.col("s") + 1, F.col("m") - F.col("a") - F.col("s"))
    placed = materialize(cut.select("word", root.alias("root"), mid.alias("mid"), (F.col("size") == F.col("m")).alias("asks")), "variant-blocks")
    shared = placed.groupBy("root").agg(F.count("*").alias("n"), F.max("asks").alias("any")).where("n > 1 AND any").select("root")
    return materialize(placed.join(materialize(shared, "variant-roots"), "root", "left_semi"), "variant-entries")


def _node(depth: Column) -> Column:
    return F.xxhash64("root", _left(F.col("mid"), depth))


def edges(entries: DataFrame) -> str:
    """Write the tries' edges, ``node, ch, child, below``, by level; the mask ``below`` has the letters that follow the child,
    and the end of a word. The folder is returned."""
    mid = F.col("mid")
    at = entries.where(F.char_length("mid") > 0).select(
        "root", "mid", F.explode(F.sequence(F.lit(0), F.char_length("mid") - 1)).alias("level")
    )
    level = F.col("level")
    follow = F.when(level + 1 == F.char_length("mid"), F.lit(END)).otherwise(_bit(mid.substr(level + 2, F.lit(1))))
    rows = at.select("level", _node(level).alias("node"), mid.substr(level + 1, F.lit(1)).alias("ch"), _node(level + 1).alias("child"), follow.alias("follow"))
    path = scratch_path(entries.sparkSession, "variant-edges")
    found = rows.groupBy("level", "node", "ch", "child").agg(F.bit_or("follow").alias("below"))
    found.write.partitionBy("level").parquet(path)
    return path


def neighbours(words: DataFrame) -> DataFrame:
    """``word, near``: all pairs of words that differ by exactly one inserted, deleted or replaced character, both ways.

    States ``word, mid, pos, node, edits`` start at the root of each trie in which a word asks and go down one level per join. A
    state without an edit may follow its own letter, take another one instead of it, or take one before it; a state
    with an edit follows its own letters. Only states whose next letter (or end) is below the child go on. Those that end where
    a word ends, with one edit, are neighbours; a deletion is an insertion seen from the other word. The edit distance of the
    words themselves is tested last, so equal hashes of different nodes cannot link words.
    """
    spark = words.sparkSession
    entries = blocks(words)
    levels = entries.agg(F.max(F.char_length("mid"))).first()[0] or 0
    path = edges(entries)
    schema = "node long, ch string, child long, below long, level int"
    all_edges = spark.read.schema(schema).parquet(path) if levels else None
    states = entries.where("asks").select(
        "word", "mid", F.lit(0).alias("pos"), _node(F.lit(0)).alias("node"), F.lit(0).alias("edits")
    )
    empty = states.where("false").select("word", "node")
    ended = empty
    pos, mid = F.col("pos"), F.col("mid")
    for level in range(levels):
        # What a state wants is worked out once, not for each edge that it meets.
        asks = states.withColumns({"at": mid.substr(pos + 1, F.lit(1)), "after": mid.substr(pos + 2, F.lit(1))})
        asks = asks.withColumns({f"need_{c}": F.when(F.col(c) == "", F.lit(END)).otherwise(_bit(F.col(c))) for c in ("at", "after")})
        steps = asks.drop("after").join(all_edges.where(F.col("level") == level).drop("level"), "node")

        def goes_on(letter: str) -> Column:
            return F.col("below").bitwiseAND(F.col(f"need_{letter}")) != 0

        own, fresh = F.col("ch") == F.col("at"), F.col("edits") == 0
        to = {
            "follow": (own & ((fresh & (F.col("below") != END)) | (~fresh & goes_on("after"))), pos + 1, F.col("edits")),
            # A letter equal to the next one is inserted after it, never before.
            "replace": (~own & fresh & (F.col("at") != "") & goes_on("after"), pos + 1, F.lit(1)),
            "insert": (~own & fresh & goes_on("at"), pos, F.lit(1)),
        }
        moves = F.array_compact(F.array(*(
            F.when(ok, F.struct(p.alias("pos"), F.col("child").alias("node"), e.alias("edits"))) for ok, p, e in to.values()
        )))
        # Most edges lead nowhere: no array is made for them.
        steps = steps.where(to["follow"][0] | to["replace"][0] | to["insert"][0])
        states = materialize(steps.select("word", "mid", F.inline(moves)), "variant-states")
        ended = ended.union(states.where((F.col("edits") == 1) & (pos == F.char_length("mid"))).select("word", "node"))
    words_at = entries.select(_node(F.char_length("mid")).alias("node"), F.col("word").alias("near"))
    pairs = ended.join(words_at, "node").where(F.levenshtein("word", "near", 1) == 1).select("word", "near")
    pairs = materialize(pairs.distinct(), "variant-pairs")
    longer = pairs.where(F.char_length("near") > F.char_length("word"))
    return pairs.union(longer.select(F.col("near").alias("word"), F.col("word").alias("near")))


def _followed(forms: DataFrame) -> DataFrame:
    """``word, root``: each word's form, and its form's form, to the last. Frequencies grow along the way, so it ends."""
    roots = materialize(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialize(roots.join(onward, "root", "left"), "variant-roots")
        if moved.where("further IS NOT NULL").isEmpty():
            return roots
        roots = moved.select("word", F.coalesce("further", "root").alias("root"))


def group_variants(docs: DataFrame, times: int = TIMES, **which: int) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: every word with its more frequent near word, if there is one.

    A word's form is its near word of largest n (ties: the smallest in code-point order) if that is at least ``times`` its
    own n; its root is reached by following forms. Null and empty texts have no words, an empty table gives an empty
    result, repeated rows count again, a null doc_id reads as the empty string; other columns are left out.
    Words of any length are compared whole. ``which`` goes to ``word_counts``.
    """
    words = materialize(word_counts(docs, **which), "variant-words")
    near = neighbours(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    # The smallest struct: the largest n, then the smallest word.
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    judged = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.minus") >= times * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.minus")).alias("form_n"))).alias("f"),
    )
    judged = materialize(judged.select("word", "n", "n_near", "f.form", "f.form_n"), "variant-forms")
    roots = _followed(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
