"""Toxicity of texts that may be disguised: decode first, then score.

The channel writes letters as digits or signs, stretches them, hides them behind a mask or spaces them out. A disguised
word, or a run of spaced characters, whose gaps may each end a word, is a lattice of characters; the path with the best sum of channel and language model cost is
its restored form. The language model counts character triples over the whole corpus. Words with one path
(plain letters) are their own restored form. The score weighs restored words and their beginnings,
learnt from labelled documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ementario.llm.simhash import shingle_hashes
from ementario.session import materialize

#: Symbols of the language model: end of word, a-z, the next most usual small letters, any other letter.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýßœ"
SYMBOLS = 64
OTHER = SYMBOLS - 1
# What a sign may stand for, after the usual substitutions of letters.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
MASKS = "*#%_?"
FILLERS = ".-_*~'’/\\,"
#: Costs (negative logarithms) of the channel: a sign for a letter, a masked letter, a filler dropped or read as the end of
#: a word, a stretched letter.
SIGN, MASK, DROP, STRETCH = 1.0, 2.5, 0.7, 0.5
#: Labelled documents that the model learns from, at most. Its features are words of these, so they are bounded with it.
MAX_LABELLED = 30_000
PREFIXES = range(4, 8)
#: Weight (logarithm of odds) from which a word is strong evidence.
STRONG = 4.5

EDGES = "\"“”„«»()[]{}<>.,;:!?*#$%&|~'’`…-_=/\\"
_SIGNS = "".join(map(re.escape, LOOKS_LIKE)) + "".join(map(re.escape, MASKS + FILLERS))
_DISGUISED = re.compile(rf"[{_SIGNS}]|(.)\1")
_STRETCHED, _RUNS = re.compile(r"(.)\1\1"), re.compile(r"(.)\1*", re.DOTALL)
_GAPS = r"\s" + "".join(map(re.escape, FILLERS))
_UNIT = rf"[^\W_{"".join(map(re.escape, FILLERS))}]|[{"".join(map(re.escape, [*LOOKS_LIKE, *(c for c in MASKS if c not in FILLERS)]))}]"
#: Three or more single characters (letters, digits or signs, each maybe stretched) with any gaps between them.
_SPACED = re.compile(rf"(?<![^\W_])({_UNIT})\1*(?:[{_GAPS}]+({_UNIT})\2*){{2,}}(?![^\W_])")


class LanguageModel:
    """Costs of character triples, smoothed with pairs and single characters."""

    def __init__(self, triples: np.ndarray) -> None:
        c3 = triples.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
        c2, c1 = c3.sum(0), c3.sum((0, 1))
        p1 = (c1 + 1) / (c1.sum() + SYMBOLS)
        p2 = (c2 + 20 * p1) / (c2.sum(1, keepdims=True) + 20)
        p3 = (c3 + 5 * p2[None]) / (c3.sum(2, keepdims=True) + 5)
        self.cost = (-np.log(p3)).astype(np.float32)
        self.flat = self.cost.ravel().tolist()
        self.symbol = {c: k + 1 for k, c in enumerate(LETTERS)}

    def of(self, ch: str) -> int:
        return self.symbol.get(ch, OTHER)


def count_triples(text: str, table: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Counts of the triples of symbols in a text; anything but a letter ends a word."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    sym = table[np.minimum(codes, len(table) - 1)].astype(np.int64)
    ended = np.concatenate(([0, 0], sym, [0]))
    triple = (ended[:-2] * SYMBOLS + ended[1:-1]) * SYMBOLS + ended[2:]
    return np.add(space, np.bincount(triple[(ended[1:-1] > 0) | (ended[2:] > 0)], minlength=SYMBOLS**3), out=space)


def symbol_table() -> np.ndarray:
    """The symbol of each character of the basic plane; capital letters count as small ones."""
    table = np.zeros(1 << 16, np.uint8)
    for code in range(1 << 16):
        ch = chr(code).lower()
        if ch.isalpha():
            table[code] = LETTERS.find(ch) + 1 if len(ch) == 1 and ch in LETTERS else OTHER
    return table


def language_model(docs: DataFrame) -> np.ndarray:
    """Counts of character triples over every whole text. Tasks send sums; the result has 64^3 numbers at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = symbol_table()
        sums = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                if text.is_valid and (t := text.as_py()):
                    count_triples(t, table, sums)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[at])], ["triple", "n"])

    counted = docs.select("text").mapInArrow(run, "triple int, n long").groupBy("triple").agg(F.sum("n").alias("n"))
    out = np.zeros(SYMBOLS**3, np.int64)
    found = counted.toPandas()
    out[found["triple"].to_numpy()] = found["n"].to_numpy()
    return out


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each place (a run of one character) what may have been written there, with its cost.

    An entry is a string: empty for a dropped filler, a space where it ends a word, two letters for a doubled one.
    """
    out = []
    for m in re.finditer(r"(.)\1*", token, re.DOTALL):
        ch, run = m[1], len(m[0])
        options: dict[str, float] = {}

        def add(text: str, cost: float, options: dict[str, float] = options) -> None:
            options[text] = min(cost, options.get(text, math.inf))

        if ch.isalpha():
            for times in (1, 2):
                add(ch * times, STRETCH * abs(run - times) if run > 2 else 0.0 if run == times else 3.0)
        elif ch.isspace():
            options = {"": 0.0, " ": 0.0}
        else:
            for letter in LOOKS_LIKE.get(ch, ""):
                for times in {1, min(run, 2)}:
                    add(letter * times, SIGN * times + STRETCH * (run - times))
            if ch in MASKS:
                for letter in LETTERS[:26]:
                    if run == 1:
                        add(letter, MASK)
            if ch in FILLERS or ch in MASKS:
                add("", DROP)
            if ch in FILLERS:
                add(" ", DROP)
            if not options:
                add(ch * run, 0.0)
        out.append(list(options.items()))
    return out


def viterbi(token: str, model: LanguageModel, most: int = 4, margin: float = 4.0) -> list[str]:
    """The best path through the token's lattice, and the best ones into other last states within ``margin`` of it.

    A state is the last two symbols; the best path into each is kept. There are ``SYMBOLS`` squared states at most, so the cost is
    linear in the runs of characters. A path is its last piece and the path before it.
    """
    flat, of = model.flat, model.of
    paths: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for options in lattice(token):
        coded = [(letters, [of(ch) if ch.isalpha() else 0 for ch in letters], extra) for letters, extra in options]
        best: dict[int, tuple[float, tuple | None]] = {}
        for state, (cost, path) in paths.items():
            for letters, symbols, extra in coded:
                now, total = state, cost + extra
                for s in symbols:
                    total += flat[now * SYMBOLS + s]
                    now = now % SYMBOLS * SYMBOLS + s
                if now not in best or total < best[now][0]:
                    best[now] = (total, (path, letters) if letters else path)
        paths = best

    def spelt(path: tuple | None) -> str:
        pieces = []
        while path:
            path, letters = path
            pieces.append(letters)
        return "".join(reversed(pieces))

    ends = sorted((cost + flat[state * SYMBOLS], k) for k, (state, (cost, _)) in enumerate(paths.items()))[:most]
    found = [path for _, path in paths.values()]
    return [spelt(found[k]) for cost, k in ends if cost <= ends[0][0] + margin]


def doubled(token: str, model: LanguageModel, margin: float = 4.0) -> list[str]:
    """What ``viterbi`` finds for a token of letters in runs of one or two: there each run is decided on its own.

    Whether a letter c between x and y is written once or twice changes no other triple than (x, c, y), or (x, c, c) and (c, c, y).
    """
    flat, of = model.flat, model.of
    runs = [(m[1], len(m[0])) for m in _RUNS.finditer(token)]
    symbols = [0, *(of(c) for c, _ in runs), 0]
    best, last = [], 0.0
    for k, (c, n) in enumerate(runs, 1):
        x, s, y = symbols[k - 1 : k + 2]
        xs = (x * SYMBOLS + s) * SYMBOLS
        # Above zero: cheaper once.
        last = flat[xs + s] + flat[(s * SYMBOLS + s) * SYMBOLS + y] - flat[xs + y] + (3.0 if n == 1 else -3.0)
        best.append(c if last >= 0 else c * 2)
    out = ["".join(best)]
    if abs(last) <= margin:
        c = runs[-1][0]
        out.append("".join(best[:-1]) + (c * 2 if last >= 0 else c))
    return out


class Restorer:
    """Restored forms of tokens, kept in a bounded table per worker."""

    def __init__(self, model: LanguageModel) -> None:
        self.model = model

    def forms(self, token: str) -> set[str]:
        """The token without signs at its edges, and the words that its lattice restores to. Of a spaced run only these.

        Every token with more than one path is decoded, whatever its length.
        """
        spaced = any(map(str.isspace, token))
        bare = token.strip(EDGES)
        out = set() if spaced else {bare}
        for t in {token} if spaced else {bare, token.rstrip(".,;:?\"')").lstrip("\"'(")}:
            if t and (spaced or _DISGUISED.search(t)) and any(map(str.isalpha, t)):
                plain = t.isalpha() and not _STRETCHED.search(t)
                for form in (doubled if plain else viterbi)(t, self.model):
                    out.update(form.split())
        out.discard("")
        return out


def spaced_runs(text: str) -> list[str]:
    """Runs of characters that stand one at a time, with their gaps. Where words end in them is for the lattice to say."""
    return [m[0] for m in _SPACED.finditer(text) if any(map(str.isalpha, m[0]))]


def spaced_words(text: str) -> list[str]:
    """The runs with all their gaps left out, as if each were one word."""
    return [re.sub(f"[{_GAPS}]", "", run) for run in spaced_runs(text)]


def tokens_of(low: str) -> set[str]:
    """What is looked up of a text in small letters: its tokens, and its spaced runs with and without gaps."""
    runs = spaced_runs(low)
    return {*low.split(), *runs, *(re.sub(f"[{_GAPS}]", "", run) for run in runs)}


def features(form: str) -> list[str]:
    """A restored word and its beginnings; the end mark tells a whole word from a beginning."""
    return [form + "$", *(form[:n] for n in PREFIXES if len(form) >= n)]


@dataclass
class Model:
    """What scoring needs: counts of the language model, weights of features, and the final curve."""

    triples: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, ...] = (-5.0, 1.0, 0.6, 0.1)


class Reach:
    """Which tokens can spell a weighted feature at all: their lattice and a trie of the features are walked together.

    Trie and walk take runs of one letter as one, so how often a letter is written does not matter here. What is refused has no
    path, likely or not, that spells a feature; only the rest has to be decoded.
    """

    END, ANY = "end", "any"  # longer than a character, so no step of the walk

    def __init__(self, weights: Iterable[str]) -> None:
        self.root: dict = {}
        for feature in weights:
            whole = feature.endswith("$")
            node = self.root
            for m in _RUNS.finditer(feature[:-1] if whole else feature):
                node = node.setdefault(m[1], {})
            node[self.END if whole else self.ANY] = True

    def bare(self, word: str) -> bool:
        """Whether a word as it stands, its letters written more or less often, has a feature."""
        node, before = self.root, ""
        for ch in word:
            if ch != before:
                node = node.get(ch)
                if node is None:
                    return False
                if self.ANY in node:
                    return True
                before = ch
        return self.END in node

    def lattice(self, token: str) -> bool:
        """Whether any path through the token's lattice spells a word with a feature."""
        end, any_, root = self.END, self.ANY, self.root
        nodes: dict[int, tuple[dict, str]] = {0: (root, "")}  # by identity: a node and the letter that led to it
        for m in _RUNS.finditer(token):
            ch = m[1]
            letters, drops, ends = _options(ch)
            if not nodes and not ends:
                continue
            after = dict(nodes) if drops else {}
            for node, before in nodes.values():
                if ends and end in node:
                    return True
                for c in node if letters is None else letters:
                    if c == before:
                        after[id(node)] = (node, before)
                    to = node.get(c)
                    if to is None or to is True:
                        continue
                    if any_ in to:
                        return True
                    after[id(to)] = (to, c)
                if letters is None and before:
                    after[id(node)] = (node, before)
            if ends:
                after[0] = (root, "")
            nodes = after
        return any(end in node for node, _ in nodes.values())

    def token(self, token: str) -> bool:
        """Whether any form of the token can have a feature."""
        if token.isalpha():
            return self.bare(token)
        spaced = any(map(str.isspace, token))
        bare = token.strip(EDGES)
        if not spaced and self.bare(bare):
            return True
        for t in {token} if spaced else {bare, token.rstrip(".,;:?\"')").lstrip("\"'(")}:
            if t and not t.isalpha() and (spaced or _DISGUISED.search(t)) and self.lattice(t):
                return True
        return False


@cache
def _options(ch: str) -> tuple[tuple[str, ...] | None, bool, bool]:
    """What a run of the character can stand for in ``lattice``: letters (None: any), nothing, the end of a word."""
    if ch.isalpha():
        return (ch,), False, False
    if ch.isspace():
        return (), True, True
    if ch in MASKS:
        return None, True, ch in FILLERS
    letters = tuple(LOOKS_LIKE.get(ch, ""))
    return letters if letters or ch in FILLERS else (ch,), ch in FILLERS, ch in FILLERS


class Scorer:
    """Per worker: evidence of words, with a bounded table of those met."""

    def __init__(self, model: Model, kept: int = 400_000) -> None:
        self.model, self.kept = model, kept
        self.restorer, self.reach = Restorer(LanguageModel(model.triples)), Reach(model.weights)
        self.known: dict[str, float] = {}

    def weight(self, token: str) -> float:
        found = self.known.get(token)
        if found is None:
            get, found = self.model.weights.get, 0.0
            if self.reach.token(token):
                found = max((get(f, 0.0) for form in self.restorer.forms(token) for f in features(form)), default=0.0)
            if len(self.known) >= self.kept:
                self.known.clear()
            self.known[token] = found
        return found

    def evidence(self, text: str) -> tuple[float, float, float]:
        """The strongest word, how many distinct words are strong, and the sum of the weak; zero for a text without any."""
        tokens = tokens_of(text.lower())
        known, weight = self.known, self.weight
        hits = []
        for t in tokens:
            w = known.get(t)
            if w is None:
                w = weight(t)
            if w > 0:
                hits.append(w)
        if not hits:
            return 0.0, 0.0, 0.0
        strong = sum(w >= STRONG for w in hits)
        return max(hits), math.log1p(strong), math.log1p(sum(sorted(w for w in hits if w < STRONG)))

    def score(self, text: str) -> float:
        z = self.model.curve[0] + sum(c * x for c, x in zip(self.model.curve[1:], self.evidence(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """text and toxic of at most ``most`` labelled documents outside the held-out fifth, one of each group of copies.

    Copies would lend their chance words the weight of many documents, so of the texts that share the smallest, or
    the next smallest, hash of their three-word shingles one is kept. The sample is bounded before that by
    the hash of doc_id, twice as large as what is kept. Labels that contradict each other for one doc_id are left out.
    """
    one = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).groupBy(
        F.col("doc_id").alias("id")
    ).agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("top")).where("toxic = top")
    picked = one.orderBy(F.xxhash64("id"), "id").limit(2 * most).select("id", "toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = np.zeros((batch.num_rows, 2), np.int64)
            for k, text in enumerate(batch.column("text")):
                h = np.unique(shingle_hashes(text.as_py(), 3))[:2].view(np.int64)
                low[k, : len(h)] = h
            columns = [batch.column(c) for c in ("id", "text", "toxic")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(low[:, 0]), pa.array(low[:, 1])], ["id", "text", "toxic", "m1", "m2"])

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    # Ids of the bounded sample are sent to the texts: no text is shuffled to be looked at, and no task sorts texts.
    rows = rows.join(F.broadcast(picked), "id").select("id", "text", F.col("toxic").cast("int").alias("toxic"))
    hashed = materialize(rows.mapInArrow(run, "id long, text string, toxic int, m1 long, m2 long"), "toxic-sample")
    keys = hashed.select("id", "toxic", "m1", "m2").groupBy("m1").agg(F.min_by(F.struct("id", "m2"), "id").alias("r"))
    keys = keys.groupBy("r.m2").agg(F.min("r.id").alias("id"))
    chosen = keys.orderBy(F.xxhash64("id"), "id").limit(most).select("id")
    return hashed.join(F.broadcast(chosen), "id").dropDuplicates(["id"]).select("id", "text", "toxic")


def count_features(sample: DataFrame, triples: np.ndarray) -> DataFrame:
    """``feature, a0, b0, a1, b1``: documents with the feature, toxic and clean ones, of either half of the sample.

    Every token of the sample is restored once. The table is written.
    """
    counts = Model(triples)
    names = ["b0", "a0", "b1", "a1"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(LanguageModel(counts.triples))
        tallies = tuple(Counter() for _ in names)
        for batch in batches:
            groups = batch.column("half").to_numpy() * 2 + (batch.column("toxic").to_numpy() > 0)
            for text, group in zip(batch.column("text"), groups.tolist(), strict=True):
                found = set()
                for t in tokens_of(text.as_py().lower()):
                    for form in restorer.forms(t):
                        found.update(features(form))
                tallies[group].update(found)
                if sum(map(len, tallies)) > 1_000_000:  # bounded memory: sums go out early
                    yield from rows(tallies)
                    tallies = tuple(Counter() for _ in names)
        yield from rows(tallies)

    def rows(tallies: tuple[Counter, ...]) -> Iterator[pa.RecordBatch]:
        for k, tally in enumerate(tallies):
            n = pa.array(list(tally.values()), pa.int64())
            none = pa.array(np.zeros(len(n), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(list(tally), pa.string()), *(n if i == k else none for i in range(4))], ["feature", *names])

    tallied = sample.select("text", "toxic", "half").mapInArrow(run, "feature string, " + ", ".join(f"{c} long" for c in names))
    sums = tallied.groupBy("feature").agg(*(F.sum(c).alias(c) for c in names))
    return materialize(sums.where("a0 + b0 + a1 + b1 >= 3"), "toxic-features")


def weigh(counted: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Features that tell toxic documents from others, with the logarithm of their odds, from their counts ``a`` and ``b`` in
    ``toxic`` and ``clean`` documents.

    A feature counts if the likelihood ratio of the two shares is beyond chance for as many features as were tested. All that do
    reach the driver: words of a bounded sample.
    """
    if not toxic or not clean:
        return {}
    a, b = F.col("a"), F.col("b")
    sums = counted.where(a + b >= 3)
    tested = sums.count()

    def part(seen: Column, of: int) -> Column:
        return F.when(seen > 0, seen * F.log(seen * (toxic + clean) / ((a + b) * of))).otherwise(0.0)

    odds = F.log((a + 0.5) / (toxic + 1)) - F.log((b + 0.5) / (clean + 1))
    told = sums.withColumns({"weight": odds, "ratio": 2 * (part(a, toxic) + part(b, clean))})
    # About one feature in all passes by chance.
    told = told.where((F.col("weight") > 1.5) & (F.col("ratio") > 2 * math.log(max(2, tested))))
    return {r.feature: r.weight for r in told.select("feature", "weight").collect()}


#: Where the curve starts from: a word's odds against the prior odds, as naive Bayes has it. Few documents hold one strong
#: word alone, so data move it from here only as far as they outweigh ``CURVE_PRECISION``.
CURVE = (-5.0, 1.0, 0.6, 0.1)
CURVE_PRECISION = (100.0, 50.0, 5.0, 20.0)


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton steps, with a Gaussian prior around ``CURVE``."""
    x1 = np.column_stack([np.ones(len(x)), x])
    mean, prior = np.array(CURVE), np.array(CURVE_PRECISION)
    w = mean.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        g = x1.T @ (p - y) + prior * (w - mean)
        h = (x1 * (p * (1 - p) + 1e-6)[:, None]).T @ x1 + np.diag(prior)
        step = np.linalg.solve(h, g)
        w = w - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> Model:
    """The language model of all texts, and weights and curve from the labelled sample.

    Without labels of both kinds every score is that of no evidence, below one half. Half of the sample gives weights, the
    other half the curve, so that the curve sees weights as they are on new texts; then all of it gives the weights.
    """
    triples = language_model(docs)
    sample = materialize(labelled_sample(docs, labels, most), "toxic-distinct")
    sample = sample.withColumn("half", F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(2)))
    sizes = {(r.half, r.t): r.n for r in sample.groupBy("half", (F.col("toxic") > 0).alias("t")).agg(F.count("*").alias("n")).collect()}
    counted = count_features(sample, triples)
    draft = Model(triples, weigh(counted.select("feature", F.col("a0").alias("a"), F.col("b0").alias("b")), sizes.get((0, True), 0), sizes.get((0, False), 0)))
    every = counted.select("feature", (F.col("a0") + F.col("a1")).alias("a"), (F.col("b0") + F.col("b1")).alias("b"))
    weights = weigh(every, *(sum(n for (_, t), n in sizes.items() if t == kind) for kind in (True, False)))
    if not draft.weights:
        return Model(triples, weights, CURVE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(draft)
        for batch in batches:
            seen = np.array([scorer.evidence(t.as_py()) for t in batch.column("text")], np.float64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(seen[:, k]) for k in range(3)), batch.column("toxic")], ["x1", "x2", "x3", "y"]
            )

    shown = sample.where("half = 1").select("text", "toxic").mapInArrow(run, "x1 double, x2 double, x3 double, y int")
    pdf = shown.toPandas()  # at most ``most`` rows of four numbers
    y = (pdf["y"].to_numpy() > 0).astype(float)
    curve = fit_curve(pdf[["x1", "x2", "x3"]].to_numpy(), y) if 0 < y.sum() < len(y) else CURVE
    return Model(triples, weights, curve)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and ``score``, 0 to 1. Texts are scored whole; null text counts as empty.

    The model is bounded (64^3 counts, and words of a bounded sample), so each task gets a copy.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            scores = [scorer.score(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"])

    base = docs.drop("score")
    schema = StructType([*base.schema.fields, StructField("score", DoubleType())])
    return base.mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; a null doc_id is not held out. See ``fit``."""
    scored = score_documents(docs.select("doc_id", "text"), fit(docs.select("doc_id", "text"), labels)).drop("text")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )



