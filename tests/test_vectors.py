"""Nearest neighbours against brute force, embedding jobs, prompts."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ementario.operators import neighbours as nn
from ementario.operators import vectors as ve
from ementario.operators.links import download_plan
from ementario.operators.retrieval import LANGUAGE_TEMPLATE, SYSTEM_TEMPLATE, fill, rag_prompts
from ementario.schemas import VECTORS
from ementario.session import scratch_run

RNG = np.random.default_rng(7)


def data(spark):
    m = RNG.normal(size=(120, 8)).astype("float32")
    m[40:80] = m[3]  # a third of all rows are copies
    rows = [(i, v.tolist()) for i, v in enumerate(m)]
    rows[5] = (5, [0.0] * 8)
    rows[6] = (6, [1.0] * 7)
    rows[7] = (7, None)
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)


def brute(rows, k, exclude_self):
    out = set()
    good = [(i, np.array(v, dtype=float)) for i, v in rows if v is not None and len(v) == 8 and any(v)]
    for qi, q in good:
        near = sorted(
            (round(1 - float(q @ v) / float(np.linalg.norm(q) * np.linalg.norm(v)), 9) + 0.0, vi)
            for vi, v in good if not (exclude_self and vi == qi))
        out |= {(qi, r + 1, vi) for r, (_, vi) in enumerate(near[:k])}
    return out


@pytest.mark.parametrize("exclude_self", [True, False])
def test_knn_join(spark, exclude_self):
    rows, df = data(spark)
    want = brute(rows, 4, exclude_self)
    for cell_rows in (1000, 30):
        got = nn.knn_join(df, df, 4, exclude_self=exclude_self, cell_rows=cell_rows)
        assert {(r.qid, r["rank"], r.vid) for r in got.collect() if r.qid != 6} == want
    assert nn.knn_join(df.limit(0), df, 4).count() == 0
    wide = nn.knn_join(df.filter("vec_id <> 6"), df, 500, exclude_self=exclude_self)
    assert wide.count() == len(brute(rows, 500, exclude_self))


def clustered(spark, n=3000, dim=16):
    centres = RNG.normal(size=(40, dim))
    m = centres[RNG.integers(40, size=n)] + RNG.normal(scale=0.02, size=(n, dim))
    m[: n // 3] = m[0]  # copies, more than a block holds
    m[-1] = -m[0]
    rows = [(i, v.tolist()) for i, v in enumerate(m)] + [(n + i, RNG.normal(size=7).tolist()) for i in range(3)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)


def exact(rows, dim, asked, k, exclude_self):
    ids = np.array([i for i, v in rows if len(v) == dim])
    m = np.array([v for _, v in rows if len(v) == dim])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    out = set()
    for i in asked:
        dist = np.round(1 - m @ m[np.flatnonzero(ids == i)[0]], 9)
        if exclude_self:
            dist[ids == i] = np.inf
        near = np.lexsort((ids, dist))[:k]
        out |= {(i, r + 1, int(ids[j])) for r, j in enumerate(near) if np.isfinite(dist[j])}
    return out


@pytest.mark.parametrize("exclude_self", [True, False])
def test_metric_index_is_exact_and_compares_few(spark, exclude_self):
    rows, df = clustered(spark)
    counter = spark.sparkContext.accumulator(0)
    got = nn.knn_join(df, df, 4, exclude_self=exclude_self, cell_rows=50, block_rows=200, counter=counter).collect()
    asked = list(range(0, 3000, 13)) + [2999]
    assert {(r.qid, r["rank"], r.vid) for r in got if r.qid in set(asked)} == exact(rows, 16, asked, 4, exclude_self)
    assert {(r.qid, r["rank"], r.vid) for r in got if r.qid >= 3000} == exact(rows, 7, range(3000, 3003), 4, exclude_self)
    compared = counter.value
    got = nn.knn_join(df.where("vec_id >= 1000"), df.where("vec_id >= 1000"), 4, cell_rows=20, block_rows=200, counter=counter).collect()
    assert len(got) == 2000 * 4 + 3 * 3 and counter.value - compared < 2000**2 / 10


def test_vectors_without_structure_are_not_written_per_block(spark):
    m = np.random.default_rng(3).normal(size=(600, 16))  # every query has to meet nearly all cells
    rows = [(i, v.tolist()) for i, v in enumerate(m)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    with scratch_run(spark) as folder:
        got = {(r.qid, r["rank"], r.vid) for r in nn.knn_join(df, df, 4, exclude_self=True, cell_rows=20, block_rows=50).collect()}
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        written = [str(f.getPath()) for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
        assert written and all(spark.read.parquet(f).count() <= 600 for f in written)
    assert got == exact(rows, 16, range(600), 4, True)


def test_a_block_is_compared_with_its_own_centre_only(monkeypatch):
    rng = np.random.default_rng(5)
    points, x = rng.normal(size=(300, 8)), rng.normal(size=(40, 8))
    centres = nn.Centres([(8, (v / np.linalg.norm(v)).tolist()) for v in points] + [(3, [1.0, 0.0, 0.0])])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cells = np.array([centres.first[8] + 7, centres.first[8] + 200])
    want, apart, pairs = nn._apart(x, centres.points[8])[:, [7, 200]], nn._apart, []
    monkeypatch.setattr(nn, "_apart", lambda a, b: pairs.append(len(a) * len(b)) or apart(a, b))
    assert np.allclose(centres.distances(x, cells), want, atol=1e-12) and sum(pairs) == 80


def test_shards_hold_a_bounded_number_of_queries():
    asked = {0: 3, 1: 4, 2: 100, 3: 1, 5: 2}
    shape, n = nn._shards(asked, 10, 1)
    load = np.zeros(n)
    for block, shard, parts in shape:
        load[shard : shard + parts] += asked[block] / parts
    assert load.sum() == 110 and load.max() <= 10 and [b for b, *_ in shape] == sorted(asked)
    assert nn._shards(asked, 1000, 11)[1] >= 11 and nn._shards({}, 10, 4) == ([], 1)


def test_queries_apart_from_the_vectors(spark):
    rows, df = clustered(spark)
    asked = spark.createDataFrame([(-1 - i, RNG.normal(size=16).tolist()) for i in range(20)], "vec_id long, embedding array<double>")
    got = {(r.qid, r["rank"], r.vid) for r in nn.knn_join(asked, df, 5, cell_rows=50, block_rows=200).collect()}
    own = [(r.vec_id, list(r.embedding)) for r in asked.collect()]
    want = set()
    for q in own:
        want |= exact(rows + [q], 16, [q[0]], 5, True)
    assert got == want


def test_knn_single(spark):
    rows, df = data(spark)
    got = ve.knn_single(df, rows[3][1], k=5).collect()
    assert [r.vec_id for r in got] == [3, 40, 41, 42, 43]
    assert ve.knn_single(df.filter("vec_id IN (5, 7, 8)"), rows[3][1], k=3).count() == 1


def test_embedding(spark):
    texts = ["Recurso especial provido", "recurso ESPECIAL, provido!", "", None, "..."]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    rows = {r.id: np.array(r.embedding) for r in ve.embed_hashed(df, "t", dim=16).collect()}
    assert np.allclose(rows[0], rows[1]) and np.isclose(np.linalg.norm(rows[0]), 1, atol=1e-6)
    assert all(not rows[i].any() for i in (2, 3, 4))
    model = lambda: lambda batch: [[float(len(t or "")), 1.0] for t in batch]
    got = {r.id: r.embedding for r in ve.embed_with(df, "t", model, dim=2).collect()}
    with pytest.raises(Exception, match="vectors of 2, not 3"):
        ve.embed_with(df, "t", model, dim=3).collect()
    assert got[0] == [24.0, 1.0] and got[3] == [0.0, 1.0]


def test_vectorize(spark):
    long = "x" * 60
    fact = spark.createDataFrame([(1, long, "a"), (2, long, "b"), (3, "", "")], "id_julgado int, ementa_limpa string, decsiao_teor_limpo string")
    empty = spark.createDataFrame([], VECTORS)
    embed = lambda df: ve.embed_hashed(df, "texto_fonte", dim=8)
    one = ve.vectorize(fact, empty, embed)
    assert sorted(r.id_julgado_fk for r in one.collect()) == [1, 2]
    assert {r.tipo_fonte for r in one.collect()} == {"ACORDAO_COMPLETO"}
    old = one.withColumn("tipo_fonte", F.lit("OLD"))
    changed = fact.withColumn("decsiao_teor_limpo", F.when(F.col("id_julgado") == 2, "new").otherwise(F.col("decsiao_teor_limpo")))
    kept = {r.id_julgado_fk: r for r in ve.vectorize(changed, old, embed).collect()}
    assert kept[2].texto_fonte.endswith("Decisão: b")
    fresh = {r.id_julgado_fk: r for r in ve.vectorize(changed, old, embed, refresh=True).collect()}
    assert fresh[2].texto_fonte.endswith("Decisão: new") and fresh[2].tipo_fonte == "OLD"
    assert fresh[1].texto_fonte == kept[1].texto_fonte and len(fresh) == 2


def test_prompts(spark):
    questions = spark.createDataFrame([(1, "por {context}?"), (2, "q2")], "qid long, question string")
    near = spark.createDataFrame([(1, 2, 11, 0.2), (1, 1, 10, 0.1)], "qid long, rank int, vid long, dist double")
    passages = spark.createDataFrame([(10, "P{question}"), (11, "R")], "vid long, passage string")
    got = {r.qid: r.prompt for r in rag_prompts(questions, near, passages).collect()}
    assert got[1] == "Use o contexto abaixo para responder:\n\nP{question}\n\nR\n\nPergunta: por {context}?\nResposta:"
    assert got[2] == "Use o contexto abaixo para responder:\n\n\n\nPergunta: q2\nResposta:"
    told = rag_prompts(questions, near, passages, LANGUAGE_TEMPLATE, language=F.lit("Português")).filter("qid = 2").first().prompt
    assert told.endswith("Contexto: \n    Pergunta: q2\n    Resposta em Português:") and told.count("Português") == 2
    system = spark.range(1).select(fill(SYSTEM_TEMPLATE, context=F.lit("C")).alias("p")).first().p
    assert system.endswith("Contexto: C") and "{context}" not in system


def test_download_plan(spark):
    parts = spark.createDataFrame(
        [(2, 0, "u3", "f", "a"), (1, 1, "u2", "f", "a"), (1, 0, "u1", "f", "b"), (1, 2, "u4", "g", "a")],
        "page_id long, pos int, url string, folder string, name string")
    control = spark.createDataFrame([("f", "b")], "folder string, name string")
    assert sorted((r.folder, r.name, r.url) for r in download_plan(parts, control).collect()) == [("f", "a", "u2"), ("g", "a", "u4")]
