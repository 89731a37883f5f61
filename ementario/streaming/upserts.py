"""Keyed upserts from a stream.

Each micro-batch is reduced to one state row per key and written as its own
``batch_id=N`` folder, which a replay of the batch overwrites. The cost of a batch is its
own size, not the table's. Reading combines the states; :func:`compact_in_place` does so once and
for all, also while the stream runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ementario.operators.upsert import combine_states, partial_state, state_rows


def state_writer(
    path: str, keys: list[str], policy: dict[str, str], order: list[str]
) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        partial_state(batch, keys, policy, order).write.mode("overwrite").parquet(
            f"{path}/batch_id={batch_id}"
        )

    return write


def start_upsert(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: list[str],
    policy: dict[str, str],
    order: list[str],
) -> StreamingQuery:
    """Take everything available now in micro-batches, then stop."""
    return (
        stream.writeStream.foreachBatch(state_writer(path, keys, policy, order))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_upserted(spark: SparkSession, path: str, keys: list[str], policy: dict[str, str]) -> DataFrame:
    states = spark.read.parquet(path).drop("batch_id")
    return state_rows(combine_states(states, keys), keys, policy)


def compact(spark: SparkSession, path: str, to: str, keys: list[str]) -> None:
    """Combine all batches into one at a new path; the old one stays for its readers."""
    states = spark.read.parquet(path).drop("batch_id")
    combine_states(states, keys).write.mode("overwrite").parquet(f"{to}/batch_id=-1")


def compact_in_place(spark: SparkSession, path: str, keys: list[str]) -> None:
    """Combine the batches stored so far where they are; a running stream goes on writing beside them.

    The combined batch is complete before the old ones are emptied, and states combine to the same whatever is counted
    twice, so readers that start at any time see every write. Combined batches have negative numbers.
    """
    stored = spark.read.parquet(path)
    old = sorted(r.batch_id for r in stored.select("batch_id").distinct().collect())  # one row per batch
    if len(old) < 2:
        return
    states = stored.filter(F.col("batch_id").isin(old)).drop("batch_id")
    combine_states(states, keys).write.mode("overwrite").parquet(f"{path}/batch_id={min(old[0], 0) - 1}")
    nothing = spark.createDataFrame([], states.schema)
    for batch_id in old:
        nothing.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
