"""Questions -> nearest passages -> prompts, in batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ementario.session import materialize

# --- fixed values: prompt templates and how passages are joined ---------------------
SHORT_TEMPLATE = (
    "Use o contexto abaixo para responder:\n\n{context}\n\nPergunta: {question}\nResposta:"
)
SYSTEM_TEMPLATE = (
    "Você é um assistente RAG especializado em direito legal. \n"
    "Sua tarefa é responder a perguntas estritamente com base no contexto fornecido. \n"
    "Se a pergunta não puder ser respondida usando o contexto, diga que você não tem"
    " informações suficientes, \n"
    "mas mantenha a resposta no idioma Português do Brasil.\n"
    "Contexto: {context}"
)
LANGUAGE_TEMPLATE = """Você é um agente especialista em direito e deve responder a perguntas com base exclusivamente no contexto fornecido. 
    Sua resposta deve ser sempre concisa, objetiva e, mais importante, **estritamente no idioma: {language}**.
    
    Se o contexto não contiver a resposta, diga "Não tenho informações suficientes no contexto para responder."
    
    Contexto: {context}
    Pergunta: {question}
    Resposta em {language}:"""
PASSAGE_SEPARATOR = "\n\n"
# --- end of fixed values -----------------------------------------------------------


def fill(template: str, **values: Column) -> Column:
    """A template with ``{name}`` places, filled from columns. Inserted text is not
    searched again, so braces in a passage are safe."""
    parts: list[Column] = []
    rest = template
    while rest:
        places = {n: rest.find("{" + n + "}") for n in values}
        hits = {n: at for n, at in places.items() if at >= 0}
        if not hits:
            parts.append(F.lit(rest))
            break
        name = min(hits, key=hits.get)
        if hits[name]:
            parts.append(F.lit(rest[: hits[name]]))
        parts.append(F.coalesce(values[name], F.lit("")))
        rest = rest[hits[name] + len(name) + 2 :]
    return F.concat(*parts)


def rag_prompts(
    questions: DataFrame,
    neighbours: DataFrame,
    passages: DataFrame,
    template: str = SHORT_TEMPLATE,
    **extra: Column,
) -> DataFrame:
    """``qid, prompt`` from ``(qid, question)``, ``(qid, rank, vid, dist)``, ``(vid, passage)``.

    Neighbours carry ids only until here; texts join last. A question gathers at most k
    passages. Questions without neighbours keep an empty context. ``extra`` fills further
    places of the template, such as ``language``.
    """
    # Written first, so that the rows of a passage that very many questions find can be split in the join.
    context = (
        materialize(neighbours, "neighbours").join(passages.select("vid", "passage"), "vid")
        .groupBy("qid")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "passage"))).alias("found"))
        .select("qid", F.array_join(F.col("found.passage"), PASSAGE_SEPARATOR).alias("context"))
    )
    filled = fill(template, context=F.col("context"), question=F.col("question"), **extra)
    return questions.join(context, "qid", "left").select("qid", filled.alias("prompt"))
