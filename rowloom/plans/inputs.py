"""What the queries read."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from rowloom.operators.dictionary import Dictionary, words_of
from rowloom.sources.files import spread_scan

# Generated dates end here, so that results do not depend on the day of the run.
AS_OF = datetime(2024, 1, 1)
SEED = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table, over all cores where it is small: for costly work on each row."""
    return spread_scan(table(spark, sf_dir, name).select(*columns))


def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the documents."""
    return words_of(spread_table(spark, sf_dir, "documents", "text"), "text")


def document_dictionary(spark: SparkSession, sf_dir: str) -> Dictionary:
    """A dictionary of all words of the documents."""
    return Dictionary.build(document_words(spark, sf_dir))
