"""A first look at a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREVIEW_ROWS = 20


def preview(df: DataFrame, *order: Column | str, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows, in a given order if any."""
    return (df.orderBy(*order) if order else df).limit(rows)


def describe_schema(df: DataFrame) -> DataFrame:
    """Position, name, type and nullability of each column."""
    fields = [
        (number, field.name, field.dataType.simpleString(), field.nullable)
        for number, field in enumerate(df.schema, start=1)
    ]
    schema = "pos int, name string, type string, nullable boolean"
    return df.sparkSession.createDataFrame(fields, schema)
