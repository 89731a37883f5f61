"""Incremental file loading as a stream: the checkpoint is the manifest."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ementario.functions.urls import relative_path
from ementario.operators.staging import bad_rows, good_rows, stage_texts, to_staging
from ementario.session import materialize


def record_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """``rel_path, text`` of new ``*.json`` files."""
    return (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select(relative_path(F.col("_metadata.file_path"), folder).alias("rel_path"), F.col("value").alias("text"))
    )


def stream_load_id(checkpoint: str, batch_id: int) -> int:
    """A load number of its own for each stream and micro-batch, beyond those that batch loads count up."""
    return (1 + zlib.crc32(checkpoint.encode())) * (1 << 30) + batch_id


def start_staging(
    stream: DataFrame, staging_path: str, quarantine_path: str, checkpoint: str
) -> StreamingQuery:
    """Parse each micro-batch once and store it under its own ``load_id``; replays overwrite it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        number = stream_load_id(checkpoint, batch_id)
        staged = materialize(stage_texts(batch), "staged-batch")
        to_staging(good_rows(staged), number).drop("load_id").write.mode("overwrite").parquet(
            f"{staging_path}/load_id={number}"
        )
        bad_rows(staged).write.mode("overwrite").parquet(f"{quarantine_path}/load_id={number}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
