"""Row spines: the numbered rows that generated columns hang on.

A spine has a unique bigint ``row_id``, the key of every draw, and a ``record_num``
that restarts in each chunk, batch or slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.operators.ranges import expand_ranges

BATCH_PARTITIONS = 128
ROWS_PER_TASK = 20_000_000


def _tasks(spark: SparkSession, rows: int) -> int:
    """Enough partitions to keep a task's share small, and at least one per core."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))


def _numbered(row_id: Column, size: int, group: str, first: int = 0) -> list[Column]:
    """``row_id``, the group it falls in and its number within the group."""
    per_group = F.lit(size).cast("long")
    record_num = F.pmod(row_id, per_group)
    number = F.call_function("div", row_id - record_num, per_group) + F.lit(first).cast("long")
    return [row_id.alias("row_id"), number.alias(group), record_num.alias("record_num")]


def chunk_spine(
    spark: SparkSession,
    chunks: int = 100,
    records_per_chunk: int = 1000,
    group: str = "chunk",
    partitions: int | None = None,
) -> DataFrame:
    """``chunks`` runs of ``records_per_chunk`` rows, as one distributed range."""
    rows = chunks * records_per_chunk
    ids = spark.range(0, rows, 1, partitions or _tasks(spark, rows))
    return ids.select(*_numbered(F.col("id"), records_per_chunk, group))


def batch_spine(spark: SparkSession, batch_size: int, partitions: int | None = None) -> DataFrame:
    """One batch of rows over 128 partitions, or more where a task's share would be large."""
    tasks = partitions or max(BATCH_PARTITIONS, _tasks(spark, batch_size))
    return chunk_spine(spark, 1, batch_size, "batch", tasks)


def slice_spine(
    spark: SparkSession, first: int, last: int, rows_per_slice: int, partitions: int | None = None
) -> DataFrame:
    """Slices ``first`` to ``last``, both included, of ``rows_per_slice`` rows each.

    Slices follow each other in the range, so a task touches few of them and a
    write partitioned by slice needs no shuffle.
    """
    rows = max(last - first + 1, 0) * rows_per_slice
    ids = spark.range(0, rows, 1, partitions or _tasks(spark, rows))
    return ids.select(*_numbered(F.col("id"), rows_per_slice, "slice_num", first))


def group_size(df: DataFrame, key: str, groups: int) -> int:
    """The run length that divides the keys ``0..max`` of a table into at most ``groups`` runs."""
    highest = df.agg(F.max(key)).first()[0]
    return 1 if highest is None else max(1, (highest + groups) // groups)


def key_spine(df: DataFrame, key: str, records_per_group: int, group: str = "chunk") -> DataFrame:
    """Number existing rows by a unique integer key, grouped in runs of the key."""
    return df.select(*_numbered(F.col(key).cast("long"), records_per_group, group))


def slice_table_spine(slices: DataFrame, slice_num: str, rows_per_slice: int, first: int = 0) -> DataFrame:
    """``rows_per_slice`` rows for each slice number of a table, the ids counted from slice ``first``."""
    bounds = slices.select(
        F.col(slice_num).cast("long").alias("slice_num"),
        F.lit(0).cast("long").alias("start"),
        F.lit(rows_per_slice - 1).cast("long").alias("end"),
    )
    rows = expand_ranges(bounds, "start", "end", "record_num").select("slice_num", "record_num")
    since_first = F.col("slice_num") - F.lit(first).cast("long")
    row_id = since_first * F.lit(rows_per_slice).cast("long") + F.col("record_num")
    return rows.select(row_id.alias("row_id"), "slice_num", "record_num")
