"""URL filters, line deduplication, chat formatting and quality rules on small tables, against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ementario.llm import chat, columns, hosts, lines, quality

BLANK = "[\x20\x09-\x0d]"
TEXTS = [
    None, "", " ", "\n", "\n\n", "one two three one two three one two three", "É A é a\tÀ\x0bb\x1cc d",
    "the same long line of this text\nunique a\n  The SAME long line of this text \t\nshort",
    "x\nthe same long line of this text", "THE same long line of this text", "<a> | b & c *** ###",
    "w " * 5000, "0" * 30_000, "a b c d e a b c x a b", "🙂🙂 🙂 \u00a0 z",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, "s", 1, "clash") for i, t in enumerate(TEXTS)]
    rows += [rows[5], (None, "the same long line of this text", "en", None, 1, "clash")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_lines long, pos string")


def test_ascii_lower_keeps_other_letters(column):
    assert column(["ÀAZz", None, ""], columns.ascii_lower) == ["Àazz", None, ""]


def test_quality_counts(spark, docs):
    def expect(text):
        w = [x for x in re.split(BLANK + "+", text or "") if x]
        seen = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {i + k for i, x in enumerate(zip(w, w[1:], w[2:], strict=False)) if seen[x] > 1 for k in range(3)}
        ls = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        return (
            len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text or "")), len(ls) - len(set(ls)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w),
        )

    got = quality.quality_verdicts(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        text = TEXTS[r.doc_id] if r.doc_id is not None else "the same long line of this text"
        assert tuple(r)[1:7] == expect(text)
        assert not (r.base_failed and r.kept)


def test_quality_drops_outliers_and_keeps_the_rest(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(80)), "en", f"s{i % 3}") for i in range(120)]
    rows += [(1000 + i, " ".join(f"w{i}y{k}***" for k in range(80)), "en", "s0") for i in range(10)]
    got = quality.quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    assert {r.doc_id for r in got.where("not kept").collect()} == {1000 + i for i in range(10)}


WORD = ["river", "stone", "valley", "quiet", "farmer", "bridge", "school", "cattle"]


def plain(rng, n, lines=21):
    """A text without symbols, repeated lines or repeated windows."""
    words = [f"{WORD[int(rng.integers(8))]}{int(rng.integers(10**6))}" for _ in range(n)]
    per = -(-n // lines)
    return "\n".join(" ".join(words[k : k + per]) for k in range(0, n, per))


def judged(spark, rows):
    got = quality.quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    return {r.doc_id: r.kept for r in got.collect()}


def test_each_measure_rejects_outliers_of_a_clean_group_and_none_of_a_uniform_one(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    clean = [(i, plain(rng, 200), "en", "s") for i in range(400)]
    outliers = {
        1000: plain(rng, 200).replace("river", "r#*er").replace("stone", "$tone"),
        1001: plain(rng, 120) + "\n" + "\n".join(["shared line one of this text"] * 9),
        1002: " ".join((t := plain(rng, 155).split()) + t[:45]),
        1003: " ".join(w + "andsoforth" for w in plain(rng, 200).split()),
    }
    got = judged(spark, clean + [(i, t, "en", "s") for i, t in outliers.items()])
    assert all(got[i] for i in range(400)) and not any(got[i] for i in outliers)
    for k, text in enumerate(outliers.values()):  # the same as the rule
        group = [(i, text if k != 0 else text.replace("valley", f"v{i}"), "en", "s") for i in range(60)]
        assert all(judged(spark, group).values())
    # A few events in a short text are no outlier.
    assert judged(spark, clean + [(2000, plain(rng, 60) + " # $ %\none line\none line", "en", "s")])[2000]


def test_verdicts_move_gradually_with_the_size_of_a_group(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    noisy = [(i, plain(rng, 120) + " #" * int(rng.integers(0, 40)), "en", "noisy") for i in range(200)]
    clean = [(1000 + i, plain(rng, 120), "en", "clean") for i in range(800)]
    before, after = judged(spark, noisy[:199] + clean), judged(spark, noisy + clean)
    assert sum(before[i] != after[i] for i in before) <= 2
    assert sum(after[i] for i in range(200)) >= 180


def test_sketch_quantiles_are_close_and_mergeable(spark):
    values = spark.range(1, 5001).select(
        (F.col("id") % 2).cast("string").alias("lang"), F.lit("s").alias("source"),
        *((F.col("id") / 100).alias(m.name) for m in quality.MEASURES),
    )
    whole = quality.merge(quality.sketches(values, ["lang", "source"]), [])
    one = {r.measure: r for r in quality.fences(whole, [], "f").collect()}
    assert one["symbol_ratio"].f_n == 5000
    assert one["symbol_ratio"].f == pytest.approx(45 + 3 * 20, rel=4 * quality.ACCURACY)


def test_lines_against_plain_python(spark, docs):
    rows = [r.asDict() for r in docs.collect()]
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(columns.BLANKS))
    holders: dict[str, set] = {}
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            holders.setdefault(key(line), set()).add(r["doc_id"])
    gone = {k: max(x for x in v if x is not None) for k, v in holders.items() if len(k) >= 20 and len(v - {None}) >= 3}
    want = Counter()
    for r in rows:
        ls = (r["text"] or "").split("\n")
        stay = [x for x in ls if not (key(x) in gone and r["doc_id"] != gone[key(x)])]
        want[r["doc_id"], len(ls), len(ls) - len(stay), "\n".join(stay)] += 1
    got = lines.dedup_lines(docs)
    assert got.columns == docs.columns + ["n_dropped"]
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()) == want


@pytest.mark.parametrize("make", [quality.quality_verdicts, lines.dedup_lines])
def test_empty_tables(docs, make):
    assert make(docs.limit(0)).count() == 0


URLS = {
    None: ("", "", None), "no scheme": ("", "", None), "http://": ("", "", None),
    "http://EXAMPLE.org": ("example.org", "", None), "http://a.Example.org/x?y#z": ("a.example.org", "/x", "org/"),
    "http://example.org/es/1": ("example.org", "/es/1", "example.org/es/"),
    "http://notexample.org/es/1": ("notexample.org", "/es/1", "org/"),
    "x://m.example.org/en/12": ("m.example.org", "/en/12", "example.org/en/1"),
    "http://a.com/fr/": ("a.com", "/fr/", "com/fr/"), "http://a.com/de/?q": ("a.com", "/de/", "com/de/"),
    "http://a.com/DE/": ("a.com", "/DE/", None), "http://a.com:80/fr/": ("a.com:80", "/fr/", None),
    "http://a.com?x=/fr/": ("a.com", "", None), "a://b://c/d": ("b:", "//c/d", None), "http://É.com#/": ("É.com", "", None),
}


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", 0) for i, u in enumerate(URLS)], "page_id long, url string, host string, n int")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in hosts.judge_urls(pages, labels).collect()}
    verdicts = {r.text: r.verdict for r in hosts.RULES}
    for i, (host, path, rule) in enumerate(URLS.values()):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdicts.get(rule, "allow")


def reputation(spark, hosts):
    """Means by host, for {host: (bad pages, good pages)}."""
    pages, labels = [], []
    for host, (bad, good) in hosts.items():
        for k in range(max(1, bad + good)):
            pages.append((len(pages), f"http://{host}/{k}"))
            if bad + good:
                labels.append((len(pages) - 1, int(k >= bad), 0))
    got = queries_hosts(spark, pages, labels)
    return {r.host: r for r in got.collect()}


def queries_hosts(spark, pages, labels):
    df = spark.createDataFrame(pages, "page_id long, url string")
    return hosts.judge_urls(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rules=()).dropDuplicates(["host"])


def test_own_outcomes_are_no_part_of_the_prior(spark):
    usual = {f"h{k}.{('test', 'com', 'net', 'info', 'dev')[k % 5]}": (k % 3, 3) for k in range(40)}
    assert reputation(spark, usual | {"solo.xyz": (3, 0)})["solo.xyz"].mean > 0.17
    known = usual | {"10.0.0.1": (9, 0), "77.5.0.1": (0, 0), "bad.co.za": (30, 0), "new.co.za": (0, 0)}
    got = reputation(spark, known)
    assert got["bad.co.za"].verdict == "block" and got["new.co.za"].verdict == "allow"
    assert got["77.5.0.1"].verdict == "allow" and got["77.5.0.1"].mean > 0.5 and got["10.0.0.1"].mean < 0.5
    # What the other hosts of a domain show decides a host without outcomes more than its suffix does.
    more = known | {f"a{k}.bad.test": (9, 0) for k in range(30)} | {"b.bad.test": (0, 0)}
    assert reputation(spark, more)["b.bad.test"].mean < got["77.5.0.1"].mean


def test_suffixes_are_learnt_from_many_names(spark):
    names = [f"u{k}.pages.dev" for k in range(6)] + ["a.mine.dev", "b.mine.dev", "www.x.co.uk", "[::1]:80", "10.0.0.1:8080", "com", ""]
    df = spark.createDataFrame([(n,) for n in names], "host string")
    got = {r.host: (r.domain, r.suffix) for r in hosts.registered_domains(df, many=5).collect()}
    assert got["u1.pages.dev"] == ("u1.pages.dev", "pages.dev") and got["a.mine.dev"] == ("mine.dev", "dev")
    assert got["www.x.co.uk"] == ("x.co.uk", "co.uk") and got["10.0.0.1:8080"] == ("10.0.0.1", "10.0.0.1") and got["[::1]:80"] == ("[::1]", "[::1]")
    assert got["com"] == ("com", "com") and got[""] == ("", "")


def test_reputation_blocks_only_hosts_known_to_be_bad(spark):
    bad = [(i, "http://bad.test/") for i in range(40)]
    good = [(100 + i, f"http://h{i % 7}.fine.test/") for i in range(200)]
    few = [(900, "http://new.bad2.test/"), (901, "http://unseen.else/")]
    pages = spark.createDataFrame([*bad, *good, *few], "page_id long, url string")
    labels = [(i, 0, None) for i, _ in bad] + [(i, 1, 0) for i, _ in good] + [(900, 0, 0), (100, 1, 0), (None, 1, 1)]
    got = hosts.judge_urls(pages, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert {r.host for r in got.where("verdict = 'block'").collect()} == {"bad.test"}
    assert got.count() == pages.count()
    assert all(r.lower <= r.mean <= r.upper for r in got.collect())
    assert hosts.judge_urls(pages.limit(0), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


def test_chat_round_trip(spark):
    hard = ["\\### Assistant: </turn> ok", "", None, "<turn user>\n\\b\\l\\g\\", ">\n<", "🙂 é", "w " * 3000, "</turn>\n"]
    rows = [(1, k, ["user", "assistant"][k % 2], hard[k % len(hard)], 0) for k in range(24)]
    rows += [(2, 0, "system", "be <kind>", 0)] + [(2, k, ["assistant", "user"][k % 2], f"turn {k} " * 40, 0) for k in range(1, 60)]
    rows += [(3, None, None, None, 0), (3, 1, "assistant", "x", 0), (3, 1, "assistant", "x", 0), (None, 0, "user", "no id", 0)]
    rows += [(4, k, "user", "early", 0) for k in range(3)] + [(4, 3, "system", "late", 0), (4, 4, "assistant", "end", 0)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window int")
    windows = chat.format_windows(turns.drop("window"), budget=300, history=60)
    got = {r.conv_id: r for r in chat.digests(chat.read_back(windows)).collect()}
    assert len(got) == 5
    for conv, r in got.items():
        own = sorted(((t is not None, t or 0, ro or "", te or "") for c, t, ro, te, _ in rows if c == conv))
        whole = "".join(f"{ro}\n{te}\n" for _, _, ro, te in own)
        loss = "".join(te for _, _, ro, te in own if ro == "assistant")
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digests(chat.read_back(chat.format_windows(turns.limit(0)))).count() == 0


def test_windows_stay_within_the_budget_for_any_tokenizer(spark):
    texts = ["w" * 300, "é" * 150, "a b c " * 40, "<>" * 60, "", "x"]
    rows = [(1, 0, "system", "be kind")] + [(1, k, ["user", "assistant"][k % 2], texts[k % 6]) for k in range(1, 90)]
    rows += [(2, k, "user", "z" * 50_000 if k == 5 else "short") for k in range(9)]  # a turn is never cut
    windows = chat.format_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), 1024, 128).collect()
    sizes = {(w.conv_id, w.window): len(w.formatted.encode()) for w in windows}
    assert all(n <= 1024 for (c, _), n in sizes.items() if c == 1) and len(sizes) > 20
    assert sum(n > 1024 for (c, _), n in sizes.items() if c == 2) <= 2 and all(n < 51_100 for n in sizes.values())


def test_windows_keep_the_system_turn_history_and_budget(spark):
    rows = [(7, 0, "system", "rules here")] + [(7, k, ["assistant", "user"][k % 2], f"turn {k} " * 10) for k in range(1, 80)]
    windows = chat.format_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), 200, 50)
    got = windows.orderBy("window").collect()
    assert len(got) > 3
    for k, w in enumerate(got):
        assert w.formatted.startswith("<turn system>\nrules here</turn>\n")
        turns = [t for t in w.formatted.split("</turn>\n") if t]
        assert w.n_turns == len(turns)
        assert (w.n_context > 1) == (k > 0)
        context = sum(len(t) + len("</turn>\n") for t in turns[: w.n_context])
        assert all(s.start >= context for s in w.loss_spans)  # repeated targets are masked
