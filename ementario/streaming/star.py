"""The star load as a stream: each micro-batch of staging rows goes to all tables under its own number."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ementario.operators.star import load_star

Loader = Callable[[SparkSession, DataFrame, str, str], None]


def start_star(stream: DataFrame, root: str, checkpoint: str, prefix: str = "", loader: Loader | None = None) -> StreamingQuery:
    """Load everything available now in micro-batches, then stop.

    A batch's number is its load, so a batch that died between two tables is loaded again under the same number when the
    stream is started anew, and ends in the same rows and the same ids; earlier batches stay. Numbers begin with ``s``, apart
    from those of batch loads.
    """

    def load(spark: SparkSession, batch: DataFrame, into: str, number: str) -> None:
        load_star(spark, batch, into, number, prefix=prefix)

    def apply(batch: DataFrame, batch_id: int) -> None:
        (loader or load)(batch.sparkSession, batch, root, f"s{batch_id}")

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
