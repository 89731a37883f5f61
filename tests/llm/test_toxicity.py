"""Restoring disguised words, held-out accuracy of the score, and the pipeline on a small corpus."""

from __future__ import annotations

import zlib
from itertools import product

import numpy as np
import pytest

from ementario.llm import queries, toxicity

WORDS = "the river runs along a quiet valley where farmers keep their cattle and children play after school near old stone bridges".split()
BAD = ["idiot", "loser", "moron", "worthless"]


def corpus():
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(400):
        words = rng.choice(WORDS, rng.integers(30, 60)).tolist()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                words.insert(int(rng.integers(len(words))), str(rng.choice(BAD)))
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    marks = spark.createDataFrame([*labels, (3, 1, 1), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    return docs, marks, toxicity.fit(docs, marks)


def test_counts_of_triples():
    counts = toxicity.count_triples("Ab 1a", toxicity.symbol_table(), np.zeros(toxicity.SYMBOLS**3, np.int64))
    cube = counts.reshape(toxicity.SYMBOLS, toxicity.SYMBOLS, toxicity.SYMBOLS)
    assert cube[0, 0, 1] == 2 and cube[0, 1, 2] == 1 and cube[1, 2, 0] == 1 and cube[0, 1, 0] == 1 and cube.sum() == 5


@pytest.mark.parametrize(
    "token, word",
    [("1d10t", "idiot"), ("l0s3r", "loser"), ("m*ron", "moron"), ("i.d.i.o.t", "idiot"), ("looooser", "loser"), ("w0rthl3$s", "worthless"), ("m0r0n!!", "moron")],
)
def test_disguised_words_are_restored(fitted, token, word):
    restorer = toxicity.Restorer(toxicity.LanguageModel(fitted[2].triples))
    assert word in restorer.forms(token)


def test_plain_words_are_left(fitted):
    restorer = toxicity.Restorer(toxicity.LanguageModel(fitted[2].triples))
    assert restorer.forms("valley,") == {"valley"} and restorer.forms("***") == set() and restorer.forms("2024") == {"2024"}
    assert toxicity.spaced_words("an i d i o t here, and a-b") == ["idiot"]


def test_held_out_documents(spark, fitted):
    docs, marks, _ = fitted
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, marks).collect()}
    assert len(got) == 400
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1
    assert sum(r.predicted != (i % 4 == 0) for i, r in got.items()) <= 4


def test_edge_texts_and_disguise(spark, fitted):
    model = fitted[2]
    texts = [None, "", " \n", "you i d i o t", "what an 1d10t and l0s3r", "river " * 50_000, "a" * 100_000, "the quiet valley", "****", "🙂"]
    docs = spark.createDataFrame([(k, t, 0.5) for k, t in enumerate(texts)], "doc_id long, text string, score double")
    got = {r.doc_id: r.score for r in toxicity.score_documents(docs, model).collect()}
    assert [k for k, s in got.items() if s >= 0.5] == [3, 4]
    assert toxicity.score_documents(docs.limit(0), model).count() == 0


def test_without_labels_nothing_is_toxic(spark, fitted):
    docs, marks, _ = fitted
    assert toxicity.score_toxicity(docs, marks.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.score_toxicity(docs.limit(0), marks).count() == 0


def test_pipeline_on_planted_cases(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(7)
    rows, labels = corpus()
    vocabulary = [a + b + c for a in ("ba", "re", "lo", "ti") for b in ("n", "st", "m", "l") for c in ("a", "er", "on", "is", "ek")]
    clean = [(2000 + k, " ".join(rng.choice(vocabulary, 150)), "en", "s", 0) for k in range(30)]
    copies = [(3000 + k, clean[0][1].replace(" ", "  ", 1), "en", "s", 0) for k in range(5)]
    toxic = [(4000, clean[1][1].replace(" ", " idiot loser ", 2) + " moron", "en", "s", 0)]
    junk = [(5000, "", "en", "s", 0), (5001, None, None, None, None), (5002, "buy now " * 60, "en", "s", 0)]
    shared = "this passage stands in many documents of the corpus"
    lined = [(6000 + k, " ".join(rng.choice(vocabulary, 120)) + "\n" + shared, "en", "s", 0) for k in range(4)]
    every = [*rows, *clean, *copies, *toxic, *junk, *lined]
    spark.createDataFrame(every, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if name != "best-fit packing":
            assert out.columns == corpus_pipeline.COLUMNS
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
    for i in (5000, 5001, 5002):
        assert i not in seen["quality rules"]
    good = {r[0] for r in [*clean, *lined]}
    assert good <= set(seen["quality rules"]) and good <= set(seen["toxicity"]) and good <= set(seen["simhash near-dedup"])
    assert 4000 in seen["quality rules"] and 4000 not in seen["toxicity"]
    assert [i for i in range(6000, 6004) if shared in seen["line dedup"][i].text] == [6003]
    # The last copy kept its text and is one of the group of document 2000; the others lost it and one of them stands for all.
    assert {r[0] for r in copies} & set(seen["simhash near-dedup"]) == {3000} and not seen["line dedup"][3000].text
    assert set(seen["best-fit packing"]) == set(seen["simhash near-dedup"])
    empty = docs.sparkSession.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_null_and_repeated_ids_in_the_pipeline(spark):
    import corpus_pipeline

    text = lambda k: " ".join(f"w{k}x{j}" for j in range(80))
    rows = [(k, text(k), "en", "s", 0) for k in range(6)]
    rows += [(None, text(10), "en", "s", 0), (None, text(11), None, None, 0), (None, text(0), "en", "s", 0)]
    rows += [(3, "buy now " * 60, "en", "s", 0), (4, text(12), "en", "s", 0), rows[5], (None, text(10), "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    judged = corpus_pipeline.quality_stage(spark, docs, "")
    key = lambda rs: sorted((-1 if r[0] is None else r[0], r[1]) for r in rs)
    assert key(judged.collect()) == key(r for r in rows if "buy" not in r[1])
    left = corpus_pipeline.near_copy_stage(spark, judged, "")
    assert left.columns == corpus_pipeline.COLUMNS
    assert key(left.collect()) == key([*rows[:8], (4, text(12))])


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)} | {"pipeline"}


SPACED = [
    ("you are a i d i o t", {"a", "idiot"}), ("y o u i d i o t", {"you", "idiot"}), ("an i d ! o t", {"idiot"}), ("l 0 $ 3 r", {"loser"}),
    ("i\nd\ni\no\nt", {"idiot"}), ("m  o.r - o n!", {"moron"}), ("too b a d now", {"bad"}), ("m o r o n l o s e r", {"moron", "loser"}),
]


@pytest.mark.parametrize("text, words", SPACED)
def test_spaced_runs_go_through_the_lattice(fitted, text, words):
    triples = toxicity.count_triples("you are not a bad " * 200, toxicity.symbol_table(), fitted[2].triples.copy())
    restorer = toxicity.Restorer(toxicity.LanguageModel(triples))
    assert words <= set().union(*(restorer.forms(t) for t in toxicity.tokens_of(text)))
    assert not toxicity.spaced_runs("1 2 3 4 and a plain text, a-b and so on")


LONG = [
    ("lo" + "o" * 40 + "ser", {"loser"}), ("iiddiioott", {"idiot"}), ("m0r0n/l0s3r-1d10t_w0rthl3ss.quiet_valley", {"moron", "loser", "idiot", "worthless"}),
    ("x" + "/quiet-valley" * 2_000 + "/1d10t", {"idiot"}),
]


@pytest.mark.parametrize("token, words", LONG)
def test_tokens_of_any_length_are_decoded(fitted, token, words):
    assert words <= toxicity.Restorer(toxicity.LanguageModel(fitted[2].triples)).forms(token)


def all_paths(token, model):
    """Every path's text, last state and cost."""
    for pieces in product(*toxicity.lattice(token)):
        state, cost = 0, 0.0
        for letters, extra in pieces:
            cost += extra
            for ch in letters:
                s = model.of(ch) if ch.isalpha() else 0
                cost += model.flat[state * toxicity.SYMBOLS + s]
                state = state % toxicity.SYMBOLS * toxicity.SYMBOLS + s
        yield "".join(letters for letters, _ in pieces), state, cost + model.flat[state * toxicity.SYMBOLS]


def test_viterbi_against_all_paths(fitted):
    model = toxicity.LanguageModel(fitted[2].triples)
    rng = np.random.default_rng(4)
    tokens = ["".join(rng.choice(list("aeilorst1034$@!.-*/"), size=n)) for n in rng.integers(1, 7, size=150)]
    for token in [*tokens, "m*r*n", "ll11", "a.b-c", "i d ! o t"]:
        best, cheapest = {}, {}
        for text, state, cost in all_paths(token, model):
            best[state] = min(cost, best.get(state, np.inf))
            cheapest[text] = min(cost, cheapest.get(text, np.inf))
        want = [c for c in sorted(best.values())[:4] if c <= min(best.values()) + 4.0]
        got = toxicity.viterbi(token, model)
        assert np.allclose(sorted(cheapest[t] for t in got), want, atol=1e-3), token


def test_what_is_not_decoded_has_no_weight(fitted):
    rng = np.random.default_rng(6)
    weights = {f: float(rng.uniform(1, 6)) for w in [*BAD, "stupid", "good", "s.o.b", "l33t", "bookkeeper"] for f in toxicity.features(w) if rng.random() < 0.6}
    scorer = toxicity.Scorer(toxicity.Model(fitted[2].triples, weights))
    plain = {"i": "1!|", "o": "0*", "e": "3", "s": "$5", "t": "7+", "a": "@4", "l": "1|"}

    def disguise(word):
        out = []
        for ch in word:
            r = rng.random()
            out.append(rng.choice(list(plain[ch])) if r < 0.25 and ch in plain else ch * int(rng.integers(2, 5)) if r < 0.35 else ch + str(rng.choice(list(".-_*/"))) if r < 0.45 else ch)
        return str(rng.choice(["", "(", '"', "x", "quiet-"])) + "".join(map(str, out)) + str(rng.choice(["", "!", "...", "ish", "/valley", "*"]))

    tokens = [disguise(str(rng.choice([*BAD, *WORDS, "stupidity", "goodness", "l33t", "s.o.b"]))) for _ in range(1500)]
    tokens += [" ".join(t) for t in tokens[:150]] + ["", "***", "a", "- -", "go*d", "g00d", "book.keeper"]
    told = 0
    for t in tokens:
        want = max((weights.get(f, 0.0) for form in scorer.restorer.forms(t) for f in toxicity.features(form)), default=0.0)
        assert scorer.weight(t) == want, t
        told += want > 0
    assert 100 < told < len(tokens) and sum(scorer.reach.token(t) for t in tokens) < len(tokens) - 200
    text = "you 1d10t and l0s3r, m o r o n of the quiet valley"
    hits = [w for w in (max((weights.get(f, 0.0) for form in scorer.restorer.forms(t) for f in toxicity.features(form)), default=0.0)
                        for t in toxicity.tokens_of(text)) if w > 0]
    strong = sum(w >= toxicity.STRONG for w in hits)
    assert scorer.evidence(text) == pytest.approx((max(hits), np.log1p(strong), np.log1p(sum(w for w in hits if w < toxicity.STRONG))))


def test_doubled_letters_are_decided_as_in_the_lattice(fitted):
    model = toxicity.LanguageModel(fitted[2].triples)
    for word in ["iiddiioott", "valley", "oo", "ttll", "moronn", "looser", "keepp", "schooll", "bbook", "xx", "aab"]:
        assert sorted(toxicity.doubled(word, model)) == sorted(toxicity.viterbi(word, model))


def test_the_sample_is_found_without_sorting_texts(spark, monkeypatch):
    plans, write = [], toxicity.materialize

    def kept(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(toxicity, "materialize", kept)
    docs = spark.createDataFrame([(k, f"a{k} b{k} c{k} d{k}") for k in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = {r.id for r in toxicity.labelled_sample(docs, labels).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(ids) > 30 and len(plans) == 1 and "SortMergeJoin" not in plans[0]
