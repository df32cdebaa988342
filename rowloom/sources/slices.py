"""Slices: inclusive integer ranges that divide a data set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_slices(lines: DataFrame, column: str = "value") -> DataFrame:
    """Start and end from the second and third of a line's ``|``-separated fields.

    A line without two integers there fails the job, whatever the session's ANSI
    setting, and also where the caller reads only one of the fields.
    """
    fields = F.split(F.col(column), r"\|")
    start, end = (F.get(fields, n).try_cast("long") for n in (1, 2))
    message = F.concat(F.lit("not a slice: "), F.col(column))
    good = F.when(start.isNotNull() & end.isNotNull(), True).otherwise(F.raise_error(message))
    return lines.where(good).select(start.alias("start"), end.alias("end"))


def read_slices(spark: SparkSession, path: str) -> DataFrame:
    """Read a slice file, one slice per line."""
    return parse_slices(spark.read.text(path))


def slice_label(start: Column, end: Column) -> Column:
    """How a slice is shown."""
    return F.concat_ws(" | ", start.cast("string"), end.cast("string"))


def slice_name(number: Column) -> Column:
    """The folder name of a numbered slice."""
    return F.format_string("slice-%03d", number)
