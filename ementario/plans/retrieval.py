"""Queries: links and download plans, vectors, neighbours, prompts, streams."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ementario.functions.vectors import vector_literal
from ementario.operators.links import download_plan, resolve_links, url_parts
from ementario.operators.neighbours import knn_join
from ementario.operators.retrieval import rag_prompts
from ementario.operators.vectors import embed_hashed, embed_with, knn_single, pending_vectors, vectorize
from ementario.plans.bindings import sql_strip
from ementario.plans.registry import query
from ementario.plans.star import EVENT_POLICY
from ementario.schemas import VECTOR_DIM, VECTORS
from ementario.session import materialize, scratch_path
from ementario.sources.pages import page_links, resource_links
from ementario.sources.tables import read_table
from ementario.streaming.upserts import read_upserted, start_upsert

# --- links -----------------------------------------------------------------------------

_SQL_LINKS = r"""(SELECT page_id, url AS page_url, generate_subscripts(hs, 1) - 1 AS pos, unnest(hs) AS href FROM (
  SELECT page_id, url, regexp_extract_all(html, '(?is)<a\s[^>]*href="([^"]*)"', 1) AS hs FROM pages))"""
_SQL_RESOLVED = rf"""(SELECT page_id, pos, page_url, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
  WHEN href[1:1] = '/' THEN regexp_extract(page_url, '^[a-z]+://[^/?#]+') || href
  ELSE regexp_replace(regexp_extract(page_url, '^[^?#]*'), '[^/]*$', '') || href END AS url
  FROM {_SQL_LINKS} WHERE href <> '')"""
_SQL_PARTS = rf"""(SELECT page_id, pos, url, regexp_extract(page_url, '[^/]*$') AS folder,
  regexp_replace(coalesce(nullif(regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '[^/]*$'), ''),
    'downloaded_file'), '[^\p{{L}}\p{{N}}._-]', '', 'g') AS name FROM {_SQL_RESOLVED})"""


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages")


@query("page_links", f"SELECT page_id, pos, href FROM {_SQL_LINKS}")
def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_links(_pages(spark, sf_dir)).drop("page_url")


def _index_html() -> Column:
    """The page's links as an index page lists resources: preview first, file second."""
    item = F.transform(
        F.regexp_extract_all("html", F.lit(r'(?is)<a\s[^>]*href="([^"]*)"'), 1),
        lambda h: F.concat(
            F.lit('<li class="resource"><a href="/top">t</a><div><p>x<br></p><ul><li><a href="/preview">p</a></li><li><a class="d" href="'),
            h, F.lit('">file</a></li><li><a href="/api">a</a></li></ul></div></li>'),
        ),
    )
    return F.concat(F.lit('<html><body><section id="dataset-resources"><ul>'), F.array_join(item, "\n"),
                    F.lit("</ul></section></body></html>"))


@query("resource_links", f"SELECT page_id, pos, href FROM {_SQL_LINKS}")
def index_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir).select("page_id", "url", _index_html().alias("html"))
    return resource_links(pages).drop("page_url")


@query("resolve_links", f"SELECT page_id, pos, url FROM {_SQL_RESOLVED}")
def absolute_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_links(page_links(_pages(spark, sf_dir))).drop("page_url")


@query("url_parts", f"SELECT page_id, pos, url, folder, name FROM {_SQL_PARTS}")
def link_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_parts(resolve_links(page_links(_pages(spark, sf_dir))))


@query("download_plan", f"""
WITH parts AS (SELECT * FROM {_SQL_PARTS})
SELECT folder, name, arg_min(page_id, (page_id, pos)) AS page_id, arg_min(url, (page_id, pos)) AS url FROM parts
WHERE (folder, name) NOT IN (SELECT (folder, name) FROM parts JOIN pages p USING (page_id) WHERE contains(p.html, 'lang="de"'))
GROUP BY folder, name""")
def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The resource links of index pages; those of the German pages stand for what earlier runs have fetched."""
    pages = _pages(spark, sf_dir)

    def parts(some: DataFrame) -> DataFrame:
        index = some.select("page_id", "url", _index_html().alias("html"))
        return url_parts(resolve_links(resource_links(index)))

    fetched = pages.filter(F.contains("html", F.lit('lang="de"')))
    return download_plan(parts(pages), parts(fetched).select("folder", "name").distinct())


# --- vectors -----------------------------------------------------------------------------


@query("anti_join_pending", """
SELECT doc_id, text FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def pending_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    done = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id_julgado_fk"))
    return pending_vectors(docs, done, key="doc_id").select("doc_id", "text")


@query("vector_literal", "SELECT vec_id, len(embedding) AS n_elements, TRUE AS same FROM embeddings")
def literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The literal is read back and compared, since engines print floats differently."""
    text = vector_literal(F.col("embedding"))
    back = F.from_json(text, "array<float>")
    return read_table(spark, sf_dir, "embeddings").select(
        "vec_id", F.size(F.split(text, ",")).cast("bigint").alias("n_elements"),
        (back == F.col("embedding")).alias("same"),
    )


@query("embed_hashed", rf"""
SELECT doc_id, {VECTOR_DIM}::BIGINT AS dim, len(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')) AS n_tokens,
  CASE WHEN regexp_matches(text, '[\p{{L}}\p{{N}}]') THEN 1.0 ELSE 0.0 END::DOUBLE AS norm FROM documents""")
def hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = embed_hashed(read_table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    total = F.aggregate(vector_to_array("_tf"), F.lit(0.0), lambda a, x: a + x)
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return vectors.select(
        "doc_id", F.size("embedding").cast("bigint").alias("dim"),
        total.cast("bigint").alias("n_tokens"), F.round(F.sqrt(square), 4).alias("norm"),
    )


def _measured(df: DataFrame) -> DataFrame:
    """A stand-in for a model whose vectors SQL can make too: characters, spaces and commas."""

    def counts(texts: list[str]) -> list[list[float]]:
        return [[len(t), t.count(" "), t.count(",")] for t in texts]

    return embed_with(df, "texto_fonte", lambda: counts, dim=3)


_SQL_TEXT = "'Ementa: ' || coalesce(text, '') || chr(10) || chr(10) || 'Decisão: ' || CASE WHEN doc_id % 2 = 0 THEN source ELSE source || ' 2' END"


@query("vectorize", f"""
SELECT doc_id AS id_julgado_fk, sha256(t) AS texto, length(t)::DOUBLE AS n_chars, (length(t) - length(replace(t, ' ', '')))::DOUBLE AS n_spaces,
  (length(t) - length(replace(t, ',', '')))::DOUBLE AS n_commas
FROM (SELECT doc_id, {_SQL_TEXT} AS t FROM documents) WHERE length({sql_strip('t')}) >= 50""")
def embed_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The even documents are embedded first; a second run, with other texts, adds the odd ones only."""
    docs = read_table(spark, sf_dir, "documents")
    fact = docs.select(F.col("doc_id").alias("id_julgado"), F.col("text").alias("ementa_limpa"), F.col("source").alias("decsiao_teor_limpo"))
    empty = spark.createDataFrame([], VECTORS)
    first = materialize(vectorize(fact.filter("id_julgado % 2 = 0"), empty, _measured), "vectors-first")
    changed = fact.withColumn("decsiao_teor_limpo", F.concat("decsiao_teor_limpo", F.lit(" 2")))
    v = vectorize(changed, first, _measured)
    numbers = [F.col("embedding")[k].cast("double").alias(n) for k, n in enumerate(("n_chars", "n_spaces", "n_commas"))]
    return v.select("id_julgado_fk", F.sha2(F.col("texto_fonte").cast("binary"), 256).alias("texto"), *numbers)


# A fixed question vector, as one would paste it into a query.
QUESTION = [round(0.1 * (i + 1), 1) for i in range(64)]

_SQL_PAIRS = """(SELECT q.vec_id AS qid, v.vec_id AS vid,
    round(1 - list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 9) AS dist
  FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id)"""
_SQL_TOP3 = f"""(SELECT qid, rank, vid, dist FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, vid) AS rank FROM {_SQL_PAIRS}) WHERE rank <= 3)"""


@query("knn_single", f"""
SELECT vec_id, round(dist, 4) AS dist FROM (SELECT vec_id,
  round(1 - list_cosine_similarity(embedding::DOUBLE[], {QUESTION}::DOUBLE[]), 9) AS dist FROM embeddings)
ORDER BY dist, vec_id LIMIT 5""")
def nearest_to_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = knn_single(read_table(spark, sf_dir, "embeddings"), QUESTION, k=5)
    return top.withColumn("dist", F.round("dist", 4))


def _neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return knn_join(vectors, vectors, k=3, exclude_self=True)


@query("knn_join", f"SELECT qid, rank, vid, round(dist, 4) AS dist FROM {_SQL_TOP3}")
def nearest_to_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector asks for its three nearest others."""
    return _neighbours(spark, sf_dir).select(
        "qid", F.col("rank").cast("bigint").alias("rank"), "vid", F.round("dist", 4).alias("dist")
    )


@query("knn_cells", f"SELECT qid, rank, vid, round(dist, 4) AS dist FROM {_SQL_TOP3}")
def nearest_through_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through many small cells, where each vector meets few of them."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return knn_join(vectors, vectors, k=3, exclude_self=True, cell_rows=50).select(
        "qid", F.col("rank").cast("bigint").alias("rank"), "vid", F.round("dist", 4).alias("dist")
    )


@query("rag_prompt", f"""
WITH top AS (SELECT * FROM {_SQL_TOP3}),
  ctx AS (SELECT qid, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS context FROM top JOIN documents ON doc_id = vid GROUP BY qid)
SELECT doc_id AS qid, 'Use o contexto abaixo para responder:' || chr(10) || chr(10) || coalesce(context, '') || chr(10) || chr(10)
  || 'Pergunta: ' || coalesce(text, '') || chr(10) || 'Resposta:' AS prompt
FROM documents LEFT JOIN ctx ON ctx.qid = doc_id""")
def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    questions = docs.select(F.col("doc_id").alias("qid"), F.col("text").alias("question"))
    passages = docs.select(F.col("doc_id").alias("vid"), F.col("text").alias("passage"))
    return rag_prompts(questions, _neighbours(spark, sf_dir), passages)


# --- streams -----------------------------------------------------------------------------


@query("stream_upsert", """
SELECT user_id, arg_min(props, (ts, event_id)) AS props, arg_max(event_type, (ts, event_id)) AS event_type,
  arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id""")
def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arrive as eight files, two in each micro-batch."""
    root = scratch_path(spark, "stream-upsert")
    events = read_table(spark, sf_dir, "events")
    events.repartition(8).write.parquet(f"{root}/arrived")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/arrived")
    running = start_upsert(
        stream, f"{root}/states", f"{root}/checkpoint", ["user_id"], EVENT_POLICY, ["ts", "event_id"]
    )
    running.awaitTermination()
    return read_upserted(spark, f"{root}/states", ["user_id"], EVENT_POLICY)
