"""Helpers that several operators share: tables between steps, partition offsets, sizes."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowloom.storage import scratch_path

# White space that separates words in every operator: space, tab and the four line controls.
SPACES = " \t\n\x0b\x0c\r"
# Bits of a filter for each of its hashes, and in all: 8 MB at most.
FILTER_BITS = 16
FILTER_MOST = 1 << 26


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the test tables by Spark, from any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder and read them back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> str:
    """A column's name as an expression, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def unused(df: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as keep it apart from the columns of a table."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def partition_bases(totals: DataFrame, part: str, total: str, base: str) -> DataFrame:
    """Second pass of a prefix sum: the total of all partitions before each one.

    ``totals`` holds one row per partition, so the ordered window and the broadcast of
    its result are bounded by the number of partitions, whatever the number of rows.
    """
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(
        totals.select(part, F.coalesce(F.sum(total).over(before), F.lit(0)).cast("long").alias(base))
    )


def order_key(doc_id: Column, text: Column) -> Column:
    """A number that orders documents: the id, or for a null id a large number by its text."""
    return F.coalesce(
        doc_id.cast("long"),
        F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(text), 2),
    )


def word_count(text: Column) -> Column:
    """Runs of characters that are not white space; null has none."""
    trimmed = F.btrim(text, F.lit(SPACES))
    runs = F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, F.lit(0)).otherwise(runs).cast("long")


def possible(hashes: DataFrame) -> Callable[[Column], Column]:
    """A test of hashes that all of ``hashes``, rows of one long, pass and few others do.

    It looks hashes up in a bitmap of bounded size, so rows that can't meet any of these
    hashes need not be shuffled for a join with them; more hashes than the bitmap is made for
    let more others pass, never fewer of their own.
    """
    spark, (name,) = hashes.sparkSession, hashes.columns
    bits = min(FILTER_MOST, 1 << max(10, (FILTER_BITS * hashes.count()).bit_length()))
    at = hashes.select(F.col(quoted(name)).bitwiseAND(F.lit(bits - 1)).alias("at"))
    words = (
        at.groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(at & 63 AS INT)))").alias("marks"))
        .toArrow()
    )
    bitmap = np.zeros(bits >> 6, np.int64)
    bitmap[words.column("word").to_numpy()] = words.column("marks").to_numpy()
    shared = spark.sparkContext.broadcast(bitmap)

    def held(values: pa.Array) -> pa.Array:
        place = values.to_numpy(zero_copy_only=False) & (bits - 1)
        return pa.array((shared.value[place >> 6] >> (place & 63)) & 1 == 1)

    return F.arrow_udf(held, "boolean")
