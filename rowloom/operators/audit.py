"""Audit of a table against its column specs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.values import constant_array
from rowloom.sources.specs import ColumnSpec
from rowloom.storage import scratch_path

# Longer texts are grouped by their SHA-256 instead of themselves.
LONG_KEY = 64
# Up to so many repeated hashes of a key, of eight bytes each, are sent to every task.
BROADCAST_ROWS = 1_000_000


def _key(df: DataFrame, spec: ColumnSpec) -> Column:
    is_text = isinstance(df.schema[spec.name].dataType, T.StringType)
    column = F.col(f"`{spec.name}`")
    if is_text and (spec.length is None or spec.length > LONG_KEY):
        return F.unhex(F.sha2(column, 256))
    return column


def _present(covered: list[tuple[int, ColumnSpec]]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{spec.name}`").isNotNull() for _, spec in covered])


def _repeats(df: DataFrame, covered: list[tuple[int, ColumnSpec]]) -> DataFrame:
    """Rows beyond the first of each key, reported for each column of the key."""
    keys = [_key(df, spec).alias(f"key_{position}") for position, spec in covered]
    groups = df.where(_present(covered)).groupBy(*keys).count()
    surplus = groups.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicate_count"))
    return surplus.select(
        F.explode(constant_array([position for position, _ in covered], "int")).alias("pos"),
        F.lit(0).cast("long").alias("null_count"),
        F.lit(0).cast("long").alias("overlength_count"),
        "duplicate_count",
    )


def _covered_keys(specs: Sequence[ColumnSpec]) -> list[list[tuple[int, ColumnSpec]]]:
    """The keys to be checked, each as its columns with their positions."""
    numbered = list(enumerate(specs, start=1))
    primary = [(position, spec) for position, spec in numbered if spec.primary_key]
    return ([primary] if primary else []) + [[(position, spec)] for position, spec in numbered if spec.unique]


def _broken(df: DataFrame, specs: Sequence[ColumnSpec]) -> DataFrame:
    """Nulls and lengths of all columns by one partial aggregate."""
    counts = []
    for position, spec in enumerate(specs, start=1):
        column = F.col(f"`{spec.name}`")
        broken_null = F.count_if(column.isNull()) if spec.not_null else F.lit(0)
        too_long = F.lit(0)
        if spec.length is not None and isinstance(df.schema[spec.name].dataType, T.StringType):
            too_long = F.count_if(F.char_length(column) > spec.length)
        counts.append(
            F.struct(
                F.lit(position).alias("pos"),
                broken_null.cast("long").alias("null_count"),
                too_long.cast("long").alias("overlength_count"),
                F.lit(0).cast("long").alias("duplicate_count"),
            )
        )
    return df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def _summed(found: DataFrame, specs: Sequence[ColumnSpec]) -> DataFrame:
    names = constant_array([spec.name for spec in specs])
    return (
        found.groupBy("pos")
        .agg(*[F.sum(name).alias(name) for name in ("null_count", "overlength_count", "duplicate_count")])
        .select("pos", F.get(names, F.col("pos") - 1).alias("name"),
                "null_count", "overlength_count", "duplicate_count")
    )


def audit(df: DataFrame, specs: Sequence[ColumnSpec]) -> DataFrame:
    """Count, per column, the rows that break its not-null, length and key constraints.

    Nulls and lengths take one pass with a partial aggregate. Each key is a pass of its
    own that reads only the key's columns: counting several distinct keys in one
    aggregate would multiply every row by their number. A duplicate is a row beyond the
    first with its key; the columns of a primary key form one key. Where several keys are
    nearly unique, ``audit_by_hash`` gives the same rows with less shuffle.
    """
    found = _broken(df, specs)
    for covered in _covered_keys(specs):
        found = found.unionByName(_repeats(df, covered))
    return _summed(found, specs)


def _hash(df: DataFrame, covered: list[tuple[int, ColumnSpec]]) -> Column:
    """A key's hash: equal for keys that group together, and now and then for others."""
    return F.xxhash64(*(F.col(f"`{spec.name}`") for _, spec in covered))


def audit_by_hash(df: DataFrame, specs: Sequence[ColumnSpec], broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``audit``, for tables whose keys are several, wide and nearly unique.

    A first pass reads the table once for all keys and shuffles a number and a 64-bit hash for
    each, whatever the width of a key, summed in each task first. Hashes that are on one row
    only are no repeats, so only rows whose hash is on several are grouped by the key itself,
    in a pass of that key; a key without such hashes needs none. So the count is exact
    although hashes may meet. Repeated hashes are written to the scratch folder and counted: up
    to ``broadcast_rows`` of a key are sent to every task, more are joined by a shuffle. Where
    most keys repeat, ``audit`` does less.

    Nulls in a key, repeated rows and an empty table count as in ``audit``.
    """
    keys = _covered_keys(specs)
    found = _broken(df, specs)
    if not keys:
        return _summed(found, specs)
    hashes = F.array(
        *(
            F.when(_present(covered), F.struct(F.lit(number).alias("key"), _hash(df, covered).alias("hash")))
            for number, covered in enumerate(keys)
        )
    )
    repeated = (
        df.select(F.explode(F.array_compact(hashes)).alias("one"))
        .groupBy("one.key", "one.hash")
        .count()
        .where(F.col("count") > 1)
        .select("key", "hash")
    )
    path = scratch_path(df.sparkSession, "repeated-keys")
    repeated.write.parquet(path)
    stored = df.sparkSession.read.schema(repeated.schema).parquet(path)
    sizes = {row["key"]: row["count"] for row in stored.groupBy("key").count().collect()}  # a row for each key
    name = "repeated" + "_" * max(len(c) for c in df.columns)  # longer than any name of the table
    for number, covered in enumerate(keys):
        if number not in sizes:
            continue
        mine = stored.where(F.col("key") == number).select(F.col("hash").alias(name))
        if sizes[number] <= broadcast_rows:
            mine = F.broadcast(mine)
        rows = df.where(_present(covered)).join(mine, _hash(df, covered) == F.col(name), "left_semi")
        found = found.unionByName(_repeats(rows, covered))
    return _summed(found, specs)
