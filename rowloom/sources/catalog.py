"""Catalog tables: create empty, load from files, read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The separator and the null text of the customary table text format.
FIELD_SEPARATOR = "\u0001"
NULL_TEXT = r"\N"


def no_rows(df: DataFrame) -> DataFrame:
    """A table's columns without its rows; the optimizer drops the scan."""
    return df.where("1 = 0")


def create_table(
    spark: SparkSession,
    name: str,
    schema: StructType | None = None,
    like: str | None = None,
    path: str | None = None,
) -> None:
    """Create an empty table if it does not exist, from a schema or with another table's columns."""
    if (schema is None) == (like is None):
        raise ValueError("give either a schema or the name of a table to clone")
    empty = no_rows(spark.table(like)) if like else spark.createDataFrame([], schema)
    writer = empty.write.format("parquet").mode("ignore")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def load_data(spark: SparkSession, name: str, path: str, separator: str = FIELD_SEPARATOR) -> None:
    """Append delimited text files to a table, field by field.

    A line is a row and quotes are plain characters. Missing fields, null texts and values
    that do not fit a column's type are null; fields beyond the last column are dropped.
    """
    fields = F.split(F.col("value"), rf"\Q{separator}\E")
    columns = []
    for position, column in enumerate(spark.table(name).schema):
        text = F.get(fields, position)
        columns.append(F.when(text != NULL_TEXT, text).try_cast(column.dataType).alias(column.name))
    spark.read.text(path).select(*columns).write.insertInto(name)


def query_table(spark: SparkSession, name: str) -> DataFrame:
    """All rows and columns of a table."""
    return spark.table(name)
