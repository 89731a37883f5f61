"""Embedding text, and the nearest neighbours of one vector by cosine distance."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ementario.functions.text import embed_text, long_enough
from ementario.functions.vectors import cosine_distance_to
from ementario.operators.neighbours import DISTANCE_DECIMALS
from ementario.operators.upsert import VECTOR_POLICY, merge
from ementario.schemas import SOURCE_TAG, VECTOR_DIM
from ementario.session import materialize

Embedder = Callable[[list[str]], Sequence[Sequence[float]]]

# --- embedding ---------------------------------------------------------------------


def embed_hashed(df: DataFrame, text_col: str, dim: int = VECTOR_DIM, out: str = "embedding") -> DataFrame:
    """Unit-length hashed term frequencies: the same text always gives the same vector.

    Runs in the JVM with Spark's own tokenizer and hashing. Text without words gives the
    zero vector. The raw counts are kept as ``_tf``.
    """
    words = RegexTokenizer(
        inputCol=text_col, outputCol="_words", pattern=r"[^\p{L}\p{N}]+", gaps=True, toLowercase=True
    )
    counts = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dim)
    unit = Normalizer(inputCol="_tf", outputCol="_unit", p=2.0)
    stages = unit.transform(counts.transform(words.transform(df.fillna({text_col: ""}))))
    return stages.withColumn(out, vector_to_array("_unit", "float32")).drop("_words", "_unit")


def embed_with(
    df: DataFrame, text_col: str, factory: Callable[[], Embedder], out: str = "embedding", dim: int | None = None
) -> DataFrame:
    """Embed with a model: ``factory`` runs once per task, then gets texts in batches. Vectors of another length than
    ``dim``, where that is given, end the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = factory()
        for batch in batches:
            found = np.asarray(model(batch.column(text_col).to_pylist()), dtype=np.float32)
            found = found.reshape(batch.num_rows, -1 if batch.num_rows else (dim or 0))
            if dim is not None and batch.num_rows and found.shape[1] != dim:
                raise ValueError(f"the model gave vectors of {found.shape[1]}, not {dim}")
            starts = np.arange(batch.num_rows + 1, dtype=np.int32) * found.shape[1]
            # The other columns pass through as they came.
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(pa.array(starts), pa.array(found.ravel()))],
                names=[*batch.schema.names, out],
            )

    return df.mapInArrow(run, f"{df.schema.toDDL()}, {out} array<float>")


def pending_vectors(
    fact: DataFrame, vectors: DataFrame, key: str = "id_julgado", refresh: bool = False
) -> DataFrame:
    """Facts still to embed: those without a vector and, with ``refresh``, those whose
    text has changed since. ``fact`` brings its text as ``texto_fonte``.

    The pending ids are found first, from ids and 8-byte text hashes only. The wide rows
    are then semi-joined to them: after a first load few are pending, so that side is
    broadcast by its size and the texts are not shuffled.
    """
    text_hash = [F.xxhash64("texto_fonte").alias("_hash")] if refresh else []
    wanted = fact.select(F.col(key).alias("_id"), *text_hash)
    done = vectors.select(F.col("id_julgado_fk").alias("_id"), *text_hash)
    todo = wanted.join(done, wanted.columns, "left_anti").select(F.col("_id").alias(key))
    return fact.join(todo, key, "left_semi")


def vector_rows(fact: DataFrame) -> DataFrame:
    """``id_julgado_fk, texto_fonte, tipo_fonte`` of the facts with enough text."""
    return (
        fact.select(
            F.col("id_julgado").alias("id_julgado_fk"),
            embed_text(F.col("ementa_limpa"), F.col("decsiao_teor_limpo")).alias("texto_fonte"),
            F.lit(SOURCE_TAG).alias("tipo_fonte"),
        )
        .filter(long_enough(F.col("texto_fonte")))
    )


def vectorize(
    fact: DataFrame,
    vectors: DataFrame,
    embed: Callable[[DataFrame], DataFrame],
    refresh: bool = False,
) -> DataFrame:
    """The vector table after embedding what is pending.

    Ids are compared first, so only the texts of pending facts are built; ``refresh`` has to build all to compare them.
    """
    if refresh:
        rows = vector_rows(fact)
    else:
        done = vectors.select(F.col("id_julgado_fk").alias("id_julgado"))
        rows = vector_rows(fact.join(done, "id_julgado", "left_anti"))
    todo = pending_vectors(rows, vectors, key="id_julgado_fk", refresh=True) if refresh else rows
    # Read several times by the merge, and the dearest step of all: computed once.
    fresh = materialize(embed(todo).select("id_julgado_fk", *VECTOR_POLICY), "vectors")
    return merge(vectors, fresh, ["id_julgado_fk"], VECTOR_POLICY)


# --- nearest neighbours of one vector; of many: operators/neighbours.py ------------------


def knn_single(vectors: DataFrame, query: Sequence[float], k: int = 5, key: str = "vec_id") -> DataFrame:
    """The ``k`` nearest to one vector: one scan, a top-k per task, one small merge."""
    dist = F.round(cosine_distance_to(F.col("embedding"), query), DISTANCE_DECIMALS)
    # Vectors without a distance sort last and go after the limit; filtering them first
    # would compute every distance twice.
    nearest = vectors.select(key, dist.alias("dist")).orderBy(F.asc_nulls_last("dist"), key).limit(k)
    return nearest.filter(F.col("dist").isNotNull())
