"""Expansion of inclusive integer ranges into one row per integer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 100_000
ROWS_PER_TASK = 20_000_000


def expand_ranges(
    ranges: DataFrame,
    start: str = "start",
    end: str = "end",
    output: str = "id",
    block_rows: int = BLOCK_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """Replace each row by one row for each integer of ``start``..``end``.

    A range is cut into blocks first, and the blocks, not the ranges, are dealt out to
    the tasks in turn: one range holding most of the integers, or many copies of one
    range, still run on every core, and no array grows beyond a block or the number of
    blocks. The partition count follows the number of rows and is stated, because the block rows are so small that
    adaptive execution would otherwise merge them into one task before they are
    expanded. A range that ends before it starts is empty.
    """
    spark = ranges.sparkSession
    first, last = F.col(start).cast("long"), F.col(end).cast("long")
    tasks = partitions
    if tasks is None:
        length = F.sum(F.greatest(last - first + 1, F.lit(0)).cast("decimal(38,0)"))
        rows = int(ranges.agg(length).first()[0] or 0)
        tasks = max(
            spark.sparkContext.defaultParallelism,
            int(spark.conf.get("spark.sql.shuffle.partitions")),
            -(-rows // ROWS_PER_TASK),
        )
    # At least block_rows, and never more blocks in a range than rows in a block.
    block = F.greatest(F.lit(block_rows).cast("long"), F.ceil(F.sqrt(last - first + 1)))
    blocks = (
        ranges.where(first <= last)
        .withColumn("__block", block)
        .withColumn("__from", F.explode(F.sequence(first, last, F.col("__block"))))
        .withColumn("__to", F.least(F.col("__from") + F.col("__block") - 1, last))
    )
    return blocks.repartition(tasks).select(*ranges.columns, F.explode(F.sequence("__from", "__to")).alias(output))
