"""A corpus from raw documents to packed sequences: quality, toxicity, shared lines, near copies, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again for the next one.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ementario.llm import lines, packing, quality, simhash, toxicity
from ementario.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keyed(docs: DataFrame, kept: DataFrame, *keys: str) -> DataFrame:
    """The rows of ``docs``, with the hash t of their text, whose keys are in ``kept``; null keys are equal to each other."""
    kept = kept.select(*(F.col(k).alias(f"{k}_k") for k in keys))
    same = [F.col(k).eqNullSafe(F.col(f"{k}_k")) for k in keys]
    return docs.withColumn("t", F.xxhash64("text")).join(kept, same, "left_semi")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rule and the adaptive cutoffs keep.

    A row's verdict is that of its own text, language and source: rows without doc_id are judged like any other, of rows that
    share a doc_id each is judged on its own, and exactly repeated rows stay or go together.
    """
    kept = quality.row_verdicts(docs).where("kept").select("doc_id", "t", "lang", "source").distinct()
    return keyed(docs, kept, "doc_id", "t", "lang", "source").select(*COLUMNS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores below one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score_documents(docs.select(*COLUMNS), toxicity.fit(docs.select("doc_id", "text"), labels))
    return scored.where("score < 0.5").select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share. One that consists of such lines stays, with an empty text; the
    next stage takes texts without words for copies of each other."""
    kept = lines.dedup_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the one with the smallest doc_id, of each group of similar texts.

    A row without doc_id stands for its group only where none of its rows has one. Of rows that share the smallest doc_id
    one stays if their texts are similar; texts that are not similar are groups of their own, so each keeps its row.
    """
    rows = materialize(simhash.similar_rows(docs), "similar-rows")
    keys = rows.groupBy("component", "doc_id", "t").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t", "n"))  # false comes first
    kept = materialize(keys.groupBy("component").agg(first.alias("k")).select("k.doc_id", "k.t", "k.n"), "similar-kept")
    once = keyed(docs, kept.where("n = 1"), "doc_id", "t").select(*COLUMNS)
    repeated = materialize(kept.where("n > 1"), "similar-repeated")
    one = keyed(docs, repeated, "doc_id", "t").groupBy("doc_id", "t").agg(F.min(F.struct(*COLUMNS)).alias("r"))
    return once.union(one.select("r.*"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_copy_stage),
    ("best-fit packing", packing_stage),
]

#: SQL has no tokenizer, no learnt score and no SimHash search; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
