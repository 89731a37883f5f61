"""SimHash tries, similar texts, embeddings and components against brute force."""

from __future__ import annotations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ementario.llm import neighbours, simhash
from ementario.llm.components import connected_components
from ementario.llm.runs import roots


def components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    n = min(size, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(len(words) - n + 1)] if n else []
    return sum(1 << k for k in range(64) if hashes and 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


@given(st.lists(st.integers(0, 2**16 - 1), max_size=60), st.integers(0, 3), st.integers(1, 3))
@settings(max_examples=60, deadline=None)
def test_traversal_finds_all_pairs_once(values, budget, groups):
    values = np.array(values, np.uint64)
    cuts = np.unique(np.linspace(0, len(values), groups + 1).astype(int))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        values[lo:hi].sort()
    got = [(min(x), max(x)) for a, b in simhash.traverse(values, cuts, 16, budget) for x in zip(a.tolist(), b.tolist(), strict=True)]
    want = {
        (i, j) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True) for i in range(lo, hi) for j in range(i + 1, hi)
        if (int(values[i]) ^ int(values[j])).bit_count() <= budget
    }
    assert len(got) == len(set(got)) and set(got) == want


def test_roots_follow_long_chains():
    n = 500
    order = np.random.default_rng(5).permutation(n)
    assert (roots(n, order[:-1], order[1:]) == 0).all()
    assert (roots(4, np.array([3]), np.array([2])) == [0, 1, 2, 2]).all()


def test_components(spark):
    rng = np.random.default_rng(3)
    chain = [(k, k + 1) for k in range(100, 160)]
    links = [*chain, *((5, int(x)) for x in rng.integers(6, 90, 200)), (7, 7), (200, 201), (201, 200), (None, 3)]
    got = connected_components(spark.createDataFrame(links, "a long, b long"))
    true = [(a, b) for a, b in links if a is not None and a != b]
    want = components({x for pair in true for x in pair}, true)
    assert {r.node: r.component for r in got.collect() if r.node != r.component} == {k: v for k, v in want.items() if k != v}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 5)  # keys are split into pairs of nodes
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in range(300)]
    texts = [None, "", " \n\x0b", "one", "One", "one two", "one\ttwo", "É é", "x " * 20_000]
    for _ in range(12):
        base = rng.choice(words, 120).tolist()
        for _ in range(6):
            copy = list(base)
            for k in rng.integers(0, 120, rng.integers(0, 2)):
                copy[k] = str(rng.choice(words))
            texts.append(" ".join(copy))
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(3, "one", 0), (None, "only here", 0), (None, "one", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = simhash.near_duplicates(docs).collect()
    prints = {i: fingerprint(t) for i, t, _ in rows if i is not None}
    ids = sorted(prints)
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    want = components(ids, links)
    assert len(got) == len(rows) and len(set(want.values())) < len(ids)
    for r in got:
        if r.doc_id is not None:
            assert (r.fp % 2**64, r.component_id) == (prints[r.doc_id], want[r.doc_id])
    assert sum(r.component_id is None for r in got) == 1
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_similar_texts(spark):
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(5000)]
    rows = []
    for g in range(15):
        base = rng.choice(words, 400).tolist()
        for c in range(4):
            copy = list(base)
            for k in rng.integers(0, 400, c * 2):  # up to 6 edits: a similarity of 0.86 and more
                copy[k] = str(rng.choice(words))
            rows.append((g * 10 + c, " ".join(copy)))
    rows += [(1000 + k, " ".join(rng.choice(words, 300))) for k in range(40)]
    rows += [(2000, "short"), (2001, "SHORT"), (2002, ""), (2003, None), (2004, ""), (None, "short")]
    got = simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r.doc_id: r.component_id for r in got}
    for i, _ in rows:
        if i is not None and i < 1000:
            assert found[i] == i // 10 * 10
        elif i is not None:
            assert found[i] == {2001: 2000, 2003: 2002, 2004: 2002}.get(i, i)  # texts without words are copies
    assert len(got) == len(rows)
    assert simhash.similar_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_similar_texts_are_told_at_the_threshold(spark):
    rng = np.random.default_rng(11)
    rows, made = [], {}
    for k in range(120):
        shared = (390, 400, 410)[k % 3]  # of 500 shingles in both: a similarity of 0.78, 0.80, 0.82
        words = [f"{x:x}" for x in rng.integers(1 << 40, size=shared + 4)]
        for c in range(2):
            own = [f"{x:x}" for x in rng.integers(1 << 40, size=(500 - shared) // 2)]
            rows.append((2 * k + c, " ".join(words + own)))
        made[k] = len(set(simhash.shingle_hashes(rows[-1][1], 5)) & set(simhash.shingle_hashes(rows[-2][1], 5)))
    assert [made[k] for k in range(3)] == [390, 400, 410]
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    linked = [sum(got[2 * k + 1] == 2 * k for k in range(g, 120, 3)) for g in range(3)]
    assert linked[0] == 0 and linked[1] >= 39 and linked[2] >= 39


@pytest.mark.parametrize("compared", [512, 5])
def test_large_groups_of_similar_texts_are_compared_in_blocks(spark, monkeypatch, compared):
    monkeypatch.setattr(simhash, "COMPARED", compared)
    rng = np.random.default_rng(12)
    words = [f"{x:x}" for x in rng.integers(1 << 40, size=204)]
    rows = [(k, " ".join([*words[: 204 - k], *(f"n{k}x{j}" for j in range(k))])) for k in range(0, 60, 2)]
    sets = {i: set(simhash.shingle_hashes(t, 5).tolist()) for i, t in rows}
    close = [(a, b) for a in sets for b in sets if a < b and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    got = simhash.similar_documents(spark.createDataFrame([*rows, rows[3]], "doc_id long, text string")).collect()
    assert len(got) == len(rows) + 1
    assert {r.doc_id: r.component_id for r in got} == components(sets, close)


def by_brute_force(rows, similarity=0.8):
    sets = {i: set(simhash.shingle_hashes(t, 5).tolist()) for i, t in rows}
    return [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9 and sets[a]]


def test_short_texts_are_linked_exactly(spark):
    rng = np.random.default_rng(13)
    rows = []
    for k in range(120):
        words = [f"{x:x}" for x in rng.integers(1 << 40, size=int(rng.integers(2, 26)))]
        rows.append((10 * k, " ".join(words)))
        for c in range(1, 4):
            copy = [*words[c % 2 :], *(f"{x:x}" for x in rng.integers(1 << 40, size=int(rng.integers(0, 2))))]
            rows.append((10 * k + c, " ".join(copy)))
    close = by_brute_force(rows)
    assert len(close) > 100
    got = simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == components([i for i, _ in rows], close)


def test_large_groups_with_stragglers(spark, monkeypatch):
    monkeypatch.setattr(simhash, "COMPARED", 8)
    rng = np.random.default_rng(14)
    base = [f"{x:x}" for x in rng.integers(1 << 40, size=150)]
    rows = []
    for k in range(90):  # most are copies with one word changed, some have so many changed that they link with few or none
        copy = list(base)
        for at in rng.integers(150, size=1 if k < 50 else int(rng.integers(2, 8))):
            copy[at] = f"{k}x{at}"
        rows.append((k, " ".join(copy)))
    got = simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == components([i for i, _ in rows], by_brute_force(rows))


def vector_rows():
    rng = np.random.default_rng(4)
    rows, k = [], 0
    for label in (0, 1, None):
        for _ in range(25):
            centre = rng.normal(size=24)
            for _ in range(5):
                v = centre + rng.normal(size=24) * rng.choice([0.0, 0.1, 0.3])
                rows.append((k, [float(x) for x in v * rng.choice([1, 7.5])], label))
                k += 1
    bad = [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23, [1.0] * 3, [1e-300] * 3, [1e300] * 3]
    for v in bad:
        rows.append((k, v, 1))
        k += 1
    return rows + [rows[0], (None, rows[1][1], rows[1][2])]


@pytest.mark.parametrize("block", [2_000, 8])
def test_embeddings_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    rows = vector_rows()
    got = neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert len(got) == len(rows)
    named = [r for r in rows if r[0] is not None]

    def linked(x, y):
        if x[2] is None or x[2] != y[2] or not x[1] or not y[1] or len(x[1]) != len(y[1]) or None in x[1] + y[1]:
            return False
        a, b = np.array(x[1]), np.array(y[1])
        if not (np.isfinite(a).all() and np.isfinite(b).all() and a.any() and b.any()):
            return False
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
        return a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.93

    links = [(i, j) for i in range(len(named)) for j in range(i + 1, len(named)) if linked(named[i], named[j])]
    degree = np.bincount(np.array(links).ravel(), minlength=len(named))
    want = {}
    for i, r in enumerate(named):
        want[r[0]] = int(degree[i])
    group = components([r[0] for r in named], [(named[a][0], named[b][0]) for a, b in links])
    total = sum(want.values())
    by_id = {r.vec_id: r for r in got if r.vec_id is not None}
    assert all(r.n_links <= want[i] for i, r in by_id.items())  # nothing below the limit
    assert sum(r.n_links for r in by_id.values()) >= 0.97 * total
    assert sum(r.component_id != group[i] for i, r in by_id.items()) <= 0.02 * len(group)
    assert all(r.kept == (r.component_id == r.vec_id) for r in by_id.values())
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    assert neighbours.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("many", [64, 256, 1024])
def test_recall_of_pairs_at_the_limit(many):
    """Pairs at cosine 0.93 share two of their nearest pivots in over nine of ten cases."""
    rng = np.random.default_rng(0)
    x = neighbours.unit(rng.normal(size=(2000, 64)))
    z = rng.normal(size=(2000, 64))
    z = neighbours.unit(z - (z * x).sum(1, keepdims=True) * x)
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * z
    p = neighbours.unit(rng.normal(size=(many, 64)))
    near = [np.argsort(-(v @ p.T), axis=1)[:, : neighbours.NEAREST] for v in (x, y)]
    assert ((near[0][:, :, None] == near[1][:, None, :]).sum((1, 2)) >= 2).mean() > 0.93
