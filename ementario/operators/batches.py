"""Batches of records that share one key set: runs of equal neighbours, cut at a largest size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ementario.session import materialize

#: Records of a batch at most.
BATCH = 1000
#: Positions of a file that are ordered in one task.
BLOCK = 50_000


def key_signature(keys: Column) -> Column:
    """A record's key set as text, whatever the order of its keys."""
    return F.array_join(F.array_sort(F.array_distinct(keys)), ",")


def _starts(before: Column, n: Column, size: int) -> Column:
    """How many batches start among ``n`` records of a run that has ``before`` records before them."""
    return (F.ceil((before + n) / size) - F.ceil(before / size)).cast("long")


def keyset_batches(rows: DataFrame, size: int = BATCH, block: int = BLOCK) -> DataFrame:
    """``batch, rows, first_file, first_pos, last_file, last_pos`` of records ``rel_path, pos, signature``.

    Records are taken in the order of (file, position). A batch goes on, also into the next file, as long as records have the
    same key set, and holds at most ``size`` of them. Runs are found within blocks of positions; how a run goes on over
    the borders of blocks, and which number a block's first batch has, comes from one row per block, so nothing but
    these is ever ordered as a whole.
    """
    place = ["rel_path", "block"]
    inside = Window.partitionBy(*place).orderBy("pos")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    cut = rows.select("rel_path", "pos", "signature", F.floor(F.col("pos") / block).alias("block"))
    cut = cut.withColumns({"row": F.row_number().over(inside), "changes": ~F.col("signature").eqNullSafe(F.lag("signature").over(inside))})
    cut = cut.withColumn("changes", F.col("changes") | (F.col("row") == 1))
    # The place of each record in its run, and whether that is the block's first, which may have begun before it.
    cut = cut.withColumn("k", F.col("row") - F.max(F.when(F.col("changes"), F.col("row"))).over(upto))
    cut = cut.withColumn("first", F.sum(F.col("changes").cast("int")).over(upto) == 1)
    later = F.when(~F.col("first") & (F.col("k") % size == 0), 1).otherwise(0)
    cut = materialize(cut.select("rel_path", "pos", "signature", "block", "row", "k", "first", F.sum(later).over(upto).alias("later")), "keyset-rows")

    ends = cut.groupBy(*place).agg(
        F.count("*").alias("n"), F.count_if("first").alias("n_first"), F.max("later").alias("later"),
        F.min_by("signature", "row").alias("opens"), F.max_by(F.struct("signature", (F.col("k") + 1).alias("n")), "row").alias("last"),
    )
    order = Window.orderBy(*place)  # one row per block
    previous = F.lag(F.struct("last", "n", "n_first")).over(order)
    ends = ends.withColumn("previous", previous)
    goes_on = F.col("previous").isNotNull() & F.col("previous.last.signature").eqNullSafe(F.col("opens"))
    whole = F.coalesce(F.col("previous.n") == F.col("previous.n_first"), F.lit(False))  # the block before is one run
    # A stretch of blocks that one run fills begins where the run does, or after a block in which it began.
    ends = ends.withColumn("stretch", F.sum(F.when(goes_on & whole, 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ends = ends.withColumn("added", F.when(goes_on, F.when(whole, F.col("previous.n")).otherwise(F.col("previous.last.n"))).otherwise(0))
    stretch = Window.partitionBy("stretch").orderBy(*place).rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.withColumn("before", F.sum("added").over(stretch))
    ends = ends.withColumn("opened", _starts(F.col("before"), F.col("n_first"), size))
    base = F.coalesce(F.sum(F.col("opened") + F.col("later")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = ends.select(F.col("rel_path").alias("_path"), F.col("block").alias("_block"), "before", "opened", base.alias("base"))

    numbered = cut.join(ends, (F.col("rel_path") == F.col("_path")) & (F.col("block") == F.col("_block")))
    mine = F.when(F.col("first"), _starts(F.col("before"), F.col("k") + 1, size)).otherwise(F.col("opened") + F.col("later"))
    at = F.struct("rel_path", "pos")
    return numbered.groupBy((F.col("base") + mine).alias("batch")).agg(
        F.count("*").alias("rows"), F.min(at).alias("low"), F.max(at).alias("high")
    ).select(
        "batch", "rows", F.col("low.rel_path").alias("first_file"), F.col("low.pos").alias("first_pos"),
        F.col("high.rel_path").alias("last_file"), F.col("high.pos").alias("last_pos"),
    )
