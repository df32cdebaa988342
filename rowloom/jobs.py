"""Whole jobs: generate rows from column specs and write them, in one distributed write each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.operators.bind import bind_positional, positional_schema
from rowloom.operators.dictionary import BROADCAST_BYTES, Dictionary
from rowloom.operators.generate import generate
from rowloom.operators.rules import PROFILE_A, PROFILE_B
from rowloom.operators.spines import chunk_spine, slice_spine, slice_table_spine
from rowloom.sources.files import read_parquet, replace_partitions, write_parquet
from rowloom.sources.slices import slice_name
from rowloom.sources.specs import ColumnSpec
from rowloom.storage import scratch_path

# The default amounts of rows.
CHUNKS, RECORDS_PER_CHUNK = 100, 1000
BATCHES, BATCH_SIZE = 10, 1000
ROWS_PER_SLICE = 100_000_001


def write_chunks(
    spark: SparkSession,
    specs: Sequence[ColumnSpec],
    path: str,
    dictionary: Dictionary | None = None,
    chunks: int = CHUNKS,
    records_per_chunk: int = RECORDS_PER_CHUNK,
    partition_by: str | None = "Col1",
    partitions: int | None = None,
    **options,
) -> None:
    """Append profile A rows under positional names, partitioned by one of them.

    The default partition column is nearly unique in the sample table, which makes a
    directory per value. Choose a column of few values for large amounts.
    """
    spine = chunk_spine(spark, chunks, records_per_chunk, partitions=partitions)
    rows = generate(spine, specs, PROFILE_A, dictionary, **options)
    write_parquet(bind_positional(rows, positional_schema(specs, PROFILE_A)), path, partition_by=partition_by)


def write_batches(
    spark: SparkSession,
    specs: Sequence[ColumnSpec],
    path: str,
    dictionary: Dictionary | None = None,
    batches: int = BATCHES,
    batch_size: int = BATCH_SIZE,
    partition_by: str | None = "sob",
    partitions: int | None = None,
    **options,
) -> None:
    """Append batches of profile B rows, whose record numbers restart in each batch."""
    spine = chunk_spine(spark, batches, batch_size, "batch", partitions)
    write_parquet(generate(spine, specs, PROFILE_B, dictionary, **options), path, partition_by=partition_by)


def write_slices(
    spark: SparkSession,
    specs: Sequence[ColumnSpec],
    path: str,
    first: int,
    last: int,
    dictionary: Dictionary | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    partitions: int | None = None,
    **options,
) -> None:
    """Append slices ``first`` to ``last`` of profile A rows, each in its own folder."""
    spine = slice_spine(spark, first, last, rows_per_slice, partitions)
    named = spine.withColumn("slice", slice_name(F.col("slice_num")))
    rows = generate(named, specs, PROFILE_A, dictionary, carry=["slice"], **options)
    # Slices lie one after the other in the range, so a task already writes few folders,
    # unless a large dictionary had the rows shuffled.
    limit = options.get("broadcast_bytes", BROADCAST_BYTES)
    shuffled = dictionary is not None and dictionary.in_memory_bytes > limit
    write_parquet(rows, path, partition_by="slice", regroup=shuffled)


def unfinished_slices(spark: SparkSession, path: str, first: int, last: int, rows_per_slice: int) -> DataFrame:
    """The numbers of the slices ``first`` to ``last`` that a folder lacks or doesn't hold in full.

    A slice is finished if its folder has as many rows as it should: fewer were cut short, more
    were appended twice. Rows are counted from the footers of the files, without reading a column.
    """
    planned = spark.range(first, last + 1).select(F.col("id").alias("slice_num"), slice_name(F.col("id")).alias("slice"))
    try:
        found = read_parquet(spark, path, "slice string")
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return planned.select("slice_num")
    finished = found.groupBy("slice").count().where(F.col("count") == F.lit(rows_per_slice)).select("slice")
    return planned.join(finished, "slice", "left_anti").select("slice_num")


def resume_slices(
    spark: SparkSession,
    specs: Sequence[ColumnSpec],
    path: str,
    first: int,
    last: int,
    dictionary: Dictionary | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    **options,
) -> None:
    """Write what a stopped ``write_slices`` with the same arguments has left undone.

    Only unfinished slices are generated, each in place of what lies in its folder. Draws
    depend on a row's number alone, so the folder ends up with the rows of a run that was
    never stopped, and a second call finds nothing to do. Two runs must not share a folder
    at the same time. The list of unfinished slices is written first: it would change while
    they are replaced.
    """
    listed = scratch_path(spark, "unfinished")
    unfinished_slices(spark, path, first, last, rows_per_slice).write.parquet(listed)
    spine = slice_table_spine(spark.read.schema("slice_num long").parquet(listed), "slice_num", rows_per_slice, first)
    named = spine.withColumn("slice", slice_name(F.col("slice_num")))
    rows = generate(named, specs, PROFILE_A, dictionary, carry=["slice"], **options)
    replace_partitions(rows, path, "slice")
