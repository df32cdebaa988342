"""Which generator a column gets: first by its type, then by its name."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The type names, compared exactly, and the generators they select.
TYPE_RULES = {"BIGINT": "integer", "BOOLEAN": "boolean", "DATE": "date", "DATETIME": "datetime"}


class Profile(NamedTuple):
    """A set of generation rules."""

    integer_low: int
    integer_high: int
    integer_type: T.DataType
    fold_case: bool
    name_rules: tuple[tuple[str, str], ...]
    otherwise: str


# Ranges, name patterns and fallbacks of the two profiles.
PROFILE_A = Profile(
    integer_low=1,
    integer_high=100,
    integer_type=T.IntegerType(),
    fold_case=True,
    name_rules=(("hash_id", "id"), ("sequence", "sob"), ("person", "name|family")),
    otherwise="word",
)
PROFILE_B = Profile(
    integer_low=100,
    integer_high=1000,
    integer_type=T.LongType(),
    fold_case=False,
    name_rules=(("hash_id", "id|ID"), ("sequence", "sob"), ("person", "name|family")),
    otherwise="sentence",
)


def generator_of(name: str, data_type: str, profile: Profile) -> str:
    """The generator of one column, settled while the plan is built."""
    if data_type in TYPE_RULES:
        return TYPE_RULES[data_type]
    searched = name.lower() if profile.fold_case else name
    return next((kind for kind, rule in profile.name_rules if re.search(rule, searched)), profile.otherwise)


def generator_column(name: Column, data_type: Column, profile: Profile) -> Column:
    """The generator of each row of a column-spec table."""
    chosen = F.lit(profile.otherwise)
    searched = F.lower(name) if profile.fold_case else name
    for kind, rule in reversed(profile.name_rules):
        chosen = F.when(searched.rlike(rule), kind).otherwise(chosen)
    for type_name, kind in TYPE_RULES.items():
        chosen = F.when(data_type == type_name, kind).otherwise(chosen)
    return chosen


def spark_type(data_type: str, profile: Profile) -> T.DataType:
    """The Spark type that a spec's type name generates."""
    types = {
        "integer": profile.integer_type,
        "boolean": T.BooleanType(),
        "date": T.DateType(),
        "datetime": T.TimestampType(),
    }
    return types.get(TYPE_RULES.get(data_type), T.StringType())


def type_column(data_type: Column, profile: Profile) -> Column:
    """The Spark type name of each row of a column-spec table."""
    chosen = F.lit(T.StringType().simpleString())
    for type_name in TYPE_RULES:
        chosen = F.when(data_type == type_name, spark_type(type_name, profile).simpleString()).otherwise(chosen)
    return chosen
