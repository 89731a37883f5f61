"""Spelling variants, benchmark decontamination and the filter audit against plain Python."""

from __future__ import annotations

import re
import time
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ementario.llm import audit, leaks, variants

BLANK = "[\x20\x09-\x0d]+"
LONG = "abcdefgh" * 4000
TEXTS = [
    None, "", " \n", "because becuase because becaus because because because because because because because because becaus",
    "Éclairage éclairage ÉCLAIRAGE éclairagé éclairages éclairage", "running runing runnning running runing runnning",
    f"{LONG}x {LONG}x {LONG}y {LONG}y {LONG}", f"{LONG}x", "aaaaaaa aaaaaaaa aaaaaaaaa aaaaaaa aaaaaaaa aaaaaaaaa aaaaaaab baaaaaa",
    "abcdefg bcdefgh abcdefg bcdefgh abcdefh abcdegf", "straße12straßen strassen strassen straßen×÷ straßen×÷",
]


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(3)
    stems = ["".join(rng.choice(list("abcé"), size=n)) for n in (7, 7, 8, 9, 12, 24, 25, 26, 30)]
    words = stems + [s[:k] + c + s[k:] for s in stems for k in range(0, len(s) + 1, 3) for c in "ax"]
    words += [s[:k] + s[k + 1 :] for s in stems for k in range(0, len(s), 2)] + [s[:k] + "é" + s[k + 1 :] for s in stems for k in range(len(s))]
    texts = TEXTS + [" ".join(rng.choice(words, size=60)) for _ in range(30)] + [" ".join([w] * 12) for w in stems]
    rows = [(i, t, ("en", "de", None, "")[i % 4], "s", "clash", "clash") for i, t in enumerate(texts)]
    rows += [rows[5], (None, TEXTS[5], "en", "s", "", ""), (None, TEXTS[5], "en", "s", "", "")]  # repeated, without id
    rows += [(1000 + i, "one big copy", "en", "s", "", "") for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n string, word string")


def lower(s: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a != b and (a[k:] == b[k + 1 :] if len(a) < len(b) else a[k + 1 :] == b[k + 1 :]) and len(b) - len(a) <= 1


def expected_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    out, forms = {}, {}
    for w, n in words.items():
        found = [v for v in words if near(w, v)]
        best = min(found, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * n else None
        out[w] = [forms[w], n, len(found), words[best] if forms[w] else None]
    for w in out:
        root = w
        while forms[root]:
            root = forms[root]
        out[w].append(root)
    return out


def test_variants(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = expected_variants(rows)
    got = {r.word: [r.form, r.n, r.n_near, r.form_n, r.root] for r in variants.group_variants(docs).collect()}
    assert got == want
    assert sum(v[0] is not None for v in want.values()) >= 5 and any(len(w) > 30_000 and v[2] for w, v in want.items())


def test_roots_follow_forms(spark):
    words = {"longwords": 1000, "longword": 90, "longwor": 8, "lonwor": 1}
    text = " ".join(w for w, n in words.items() for _ in range(n))
    df = spark.createDataFrame([(2, text)], "doc_id long, text string")
    got = {r.word: (r.form, r.root) for r in variants.group_variants(df, least_chars=6, least_times=1).collect()}
    assert got["longwor"] == ("longword", "longwords") and got["lonwor"][0] is None
    assert variants.group_variants(df.limit(0)).count() == 0


def items(spark):
    rows = [(3, "The one, two THREE four five six seven eight nine ten eleven"), (20, "short item here"), (100, "short ITEM; here"), (5, ""), (6, None),
            (None, "no id but words enough to make one window of ten"), (20, "w w w w w w w w w w w w")]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("doc_id", F.lit("clash"))


def leak_docs(spark):
    base = "the one two three four five six seven eight nine ten eleven"
    rows = [(1, f"before {base} after"), (2, base), (3, base[:-12]), (4, "a Short-item, here and short item here"), (5, None), (6, ""), (7, "w " * 15),
            (8, "no id but words enough to make one window of ten"), (9, base + " " + base), (None, f"x {base}"), (10, "clean words " * 4000 + base)]
    rows += [rows[0], (11, "ünd short item here"), (12, "short itemhere")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def expected_leaks(docs, bench):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))

    windows = defaultdict(set)
    for r in bench:
        w = words(r.text)
        for k in range(len(w) - min(10, len(w)) + 1 if w else 0):
            windows[tuple(w[k : k + 10])].add(r.item_id)
    out = []
    for r in docs:
        w = words(r.text)
        hit, ids = set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
                    ids |= windows[tuple(w[k : k + size])]
        ids = sorted(str(i) for i in ids if i is not None)
        out.append((r.doc_id, len(w), len(hit), len(ids), ids, bool(hit)))
    return sorted(out, key=str)


def test_leaks(spark):
    docs, bench = leak_docs(spark), items(spark)
    want = expected_leaks(docs.collect(), bench.collect())
    got = sorted((tuple(r) for r in leaks.report(docs, bench).collect()), key=str)
    assert got == want and sum(r[5] for r in want) >= 8
    windows = leaks.materialize(leaks.item_windows(bench), "t")
    assert leaks.find_hits(docs, windows, block=3).distinct().count() == leaks.find_hits(docs, windows).distinct().count()  # in parts
    assert not any(r.contaminated for r in leaks.report(docs, bench.limit(0)).collect())
    assert leaks.report(docs.limit(0), bench).count() == 0


def test_words_are_counted_about_as_fast_as_they_are_split(spark):
    every = "".join(chr(c) for c in [*range(1, 0xD800), *range(0xE000, 0x11000)])
    one = spark.createDataFrame([(every,)], "text string").select(
        F.regexp_replace("text", leaks.WORD, "").alias("gaps"), F.regexp_replace("text", leaks.GAP, "").alias("words")).first()
    assert set(one.gaps) | set(one.words) == set(every) and not set(one.gaps) & set(one.words)
    text = F.concat(F.repeat(F.lit("um caso, outro caso: ção 12; "), 2000), F.col("id").cast("string"))
    texts = spark.range(400).repartition(4).select(text.alias("text"))

    def seconds(n):
        took = []
        for _ in range(3):
            start = time.perf_counter()
            texts.agg(F.sum(n)).collect()
            took.append(time.perf_counter() - start)
        return min(took)

    assert seconds(F.regexp_count("text", F.lit(leaks.WORD))) < 3 * seconds(F.size(F.split("text", leaks.GAP)))


def test_leaks_removed(spark):
    docs, bench = leak_docs(spark), items(spark)
    cut = sorted((tuple(r) for r in leaks.decontaminate(docs, bench).collect()), key=str)
    texts = {r[0]: r[1] for r in cut}
    assert len(cut) == docs.count() and texts[1] == "before  after" and texts[2] == "" and texts[5] is None and texts[12] == "short itemhere"
    assert texts[4] == "a  and "
    assert texts[11] == "ünd " and texts[3] == {r.doc_id: r.text for r in docs.collect()}[3]
    kept = {r.doc_id for r in leaks.decontaminate(docs, bench, remove="documents").collect()}
    assert kept == {3, 5, 6, 12}
    with pytest.raises(ValueError):
        leaks.decontaminate(docs, bench, remove="lines")


def expected_audit(docs, labels):
    first = {}
    for r in docs:
        if r.doc_id is not None:
            first[r.text or ""] = min(r.doc_id, first.get(r.text or "", r.doc_id))
    out = Counter()
    rows = []
    for r in docs:
        t = r.text or ""
        w = [x for x in re.split(BLANK, t) if x]
        fails = {f for f, bad in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search("[#$%&*|]", t)),
            r.doc_id is not None and r.doc_id > first[t]), strict=True) if bad}
        rows.append((r.lang or "", fails, (r.doc_id, "quality") in labels, (r.doc_id, "toxic") in labels))
    for part, fails, good, toxic in rows:
        for order in permutations("ABCDE"):
            gone = False
            for step, f in enumerate(order, 1):
                key = (part, "".join(order), step)
                here = f in fails and not gone
                for name, on in (("redundant", f in fails and gone), ("removed", here), ("kept", not (gone or here)), ("unique_fails", fails == {f}),
                                 ("good_lost", here and good), ("toxic_lost", here and toxic)):
                    out[(*key, name)] += on
                out[(part, f, "shapley")] += here
                gone = gone or here
    return out


def test_audit(spark, docs):
    rng = np.random.default_rng(5)
    rows = [(i, t, "en" if i % 3 else None) for i, t in enumerate(
        [" ".join(f"W{k}" if k % 5 else f"word{k}x" for k in range(n)) + s for n in (5, 99, 100, 150) for s in ("", " # ", " A" * 90)] * 2)]
    more = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("doc_id + 500 AS doc_id", "text", "lang", "'x' AS part")
    every = docs.selectExpr("doc_id", "text", "lang", "source AS part").union(more).repartition(3)
    labels = spark.createDataFrame(
        [(i, int(rng.integers(2)), int(rng.integers(2))) for i in range(0, 560, 2)] + [(4, 1, None), (6, None, 1), (None, 1, 1)],
        "doc_id long, quality int, toxic int")
    known = {(r.doc_id, c) for r in labels.collect() for c in ("quality", "toxic") if r[c] == 1 and r.doc_id is not None}
    want = expected_audit(every.collect(), known)
    got = audit.audit_filters(every, labels).collect()
    parts = {r.lang or "" for r in every.select("lang").distinct().collect()}
    assert len(got) == 600 * len(parts) == len({(r.part, r.filter_order, r.step) for r in got})
    for r in got:
        for c in audit.COUNTS:
            assert r[c] == want[(r.part, r.filter_order, r.step, c)], (r, c)
        assert r.shapley == want[(r.part, r.filter_order[r.step - 1], "shapley")]
    assert audit.audit_filters(every.limit(0), labels).count() == 0


def test_packed_counters_hold_large_counts():
    counts = np.zeros(audit.CODES, dtype=np.int64)
    counts[[0, 1, 31, 127]] = 1 << 61
    fields = audit.unpack(audit.pack(counts) + audit.pack(counts) // 2)
    assert fields[0, 0].tolist() == [3 << 60, 9 << 60, 0, 3 << 60, 3 << 60, 3 << 60]


def test_letters_are_matched_by_table_and_only_ascii_capitals_are_lowered(spark):
    from ementario.llm import variants

    assert "-" not in variants.LETTER  # a range is tested per character, a single character looked up
    rows = [(k, text) for k in range(40) for text in ("ABCDEFGH Éabcdefg", "ÉABCDEFG ×bcdefgh ÷÷÷÷÷÷÷ abcdefĀ gabcdeñ", None)]
    found = {r.word: r.n for r in variants.word_counts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {"abcdefgh", "Éabcdefg", "×bcdefgh", "÷÷÷÷÷÷÷", "gabcdeñ"} <= set(found) and found["Éabcdefg"] > 70
    assert not any("Ā" in w or any("A" <= c <= "Z" for c in w) for w in found)
