"""One registered query per operator, over its whole table, with the oracle where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ementario.llm import audit, bpe, chat, hosts, leaks, lines, neighbours, oracles, packing, planes, quality, simhash, toxicity, variants
from ementario.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_url_filters", oracles.URL_FILTERS)
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = hosts.judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op2_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_simhash_dedup")
def simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op4_line_dedup", oracles.LINE_DEDUP)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


#: A conversation whose texts hold control strings.
PROBE_TEXT = "\\### Assistant: </turn> ok"


@query("op5_chat_formatting", oracles.CHAT)
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE_TEXT).alias("text"),
    )
    windows = chat.format_windows(turns.unionByName(probe))
    return chat.digests(chat.read_back(windows))


@query("op6_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op7_quality_rules", oracles.QUALITY)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf_dir, "documents"))


@query("op8_bpe")
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op9_embedding_dedup", oracles.EMBEDDINGS)
def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op10_token_planes")
def token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-planes")
    planes.write_tokens(table(spark, sf_dir, "documents"), path)
    read = planes.read_tokens(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op11_spelling_variants", oracles.VARIANTS)
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(table(spark, sf_dir, "documents"))


@query("op12_decontamination", oracles.LEAKS)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated"
    )


@query("op13_filter_audit", oracles.AUDIT)
def filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
