"""Schemas from column specs, and binding of rows to them."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.operators.rules import Profile, spark_type
from rowloom.sources.specs import ColumnSpec

# Fixed value: the one positional column that may not be null.
REQUIRED_POSITION = 7

# A literal of each type: its presence makes a column non-nullable, its value is never reached.
_NEVER_USED = {
    T.StringType: "",
    T.IntegerType: 0,
    T.LongType: 0,
    T.BooleanType: False,
    T.DateType: date(1970, 1, 1),
    T.TimestampType: datetime(1970, 1, 1),
}


def named_schema(specs: Sequence[ColumnSpec], profile: Profile) -> T.StructType:
    """The schema of generated rows under the names of the specs."""
    return T.StructType([T.StructField(spec.name, spark_type(spec.data_type, profile)) for spec in specs])


def positional_schema(
    specs: Sequence[ColumnSpec], profile: Profile, required: Collection[int] = (REQUIRED_POSITION,)
) -> T.StructType:
    """The schema Col1, Col2, ... of generated rows; required positions are not nullable."""
    return T.StructType(
        [
            T.StructField(f"Col{n}", spark_type(spec.data_type, profile), n not in required)
            for n, spec in enumerate(specs, start=1)
        ]
    )


def _required(column: Column, field: T.StructField) -> Column:
    """Fail on a null, and tell Spark that none is left."""
    message = F.lit(f"null in required column {field.name}")
    present = F.when(column.isNotNull(), column).otherwise(F.raise_error(message))
    return F.coalesce(present, F.lit(_NEVER_USED[type(field.dataType)]).cast(field.dataType))


def bind_positional(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give the columns of a table the names, types and nullability of a schema, by position."""
    if len(df.columns) != len(schema):
        raise ValueError(f"{len(df.columns)} columns cannot bind to {len(schema)} fields")
    bound = []
    for name, field in zip(df.columns, schema):
        column = F.col(f"`{name}`").cast(field.dataType)
        bound.append((column if field.nullable else _required(column, field)).alias(field.name))
    # A filter stays in the plan whichever columns are read; a check in a projection may not.
    for name, field in zip(df.columns, schema):
        if not field.nullable:
            message = F.lit(f"null in required column {field.name}")
            df = df.where(F.when(F.col(f"`{name}`").isNotNull(), True).otherwise(F.raise_error(message).cast("boolean")))
    return df.select(*bound)
