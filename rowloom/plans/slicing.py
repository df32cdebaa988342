"""Slices read from text, expanded, filled and written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions import values
from rowloom.functions.draws import with_draws
from rowloom.operators.ranges import expand_ranges
from rowloom.operators.spines import group_size, key_spine, slice_table_spine
from rowloom.plans import duck
from rowloom.plans.inputs import SEED, table
from rowloom.sources.files import read_parquet, write_parquet
from rowloom.sources.slices import read_slices, slice_label, slice_name
from rowloom.storage import scratch_path

SLICE_ROWS = 301
SLICES = 16


def slice_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of the customers' keys, written as text and read back."""
    start = F.col("c_custkey") * 100
    line = F.concat_ws(
        "|", F.col("c_custkey").cast("string"), start.cast("string"),
        (start + F.col("c_nationkey")).cast("string"), F.col("c_mktsegment"),
    )
    path = scratch_path(spark, "slices")
    table(spark, sf_dir, "customer").select(line).write.text(path)
    return read_slices(spark, path)


def slice_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slice_scan(spark, sf_dir).select(slice_label(F.col("start"), F.col("end")).alias("label"))


def slice_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expand_ranges(slice_scan(spark, sf_dir)).select("start", "id")


def slice_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slice of generated rows for each supplier."""
    spine = slice_table_spine(table(spark, sf_dir, "supplier"), "s_suppkey", SLICE_ROWS)
    return with_draws(spine, seed=SEED).select(
        "slice_num",
        values.sequence_text(F.col("record_num")).alias("sob"),
        values.uniform_int("page_views", 1, 100).alias("page_views"),
    )


def slice_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated rows for the orders, each slice in its folder, read back and summed up."""
    orders = table(spark, sf_dir, "orders")
    spine = key_spine(orders, "o_orderkey", group_size(orders, "o_orderkey", SLICES), "slice_num")
    rows = with_draws(spine, seed=SEED).select(
        slice_name(F.col("slice_num")).alias("slice"),
        values.sequence_text(F.col("record_num")).alias("sob"),
        values.uniform_int("page_views", 1, 100).alias("page_views"),
    )
    path = scratch_path(spark, "sliced")
    write_parquet(rows, path, partition_by="slice")
    return read_parquet(spark, path, rows.schema).groupBy("slice").agg(
        F.count("*").alias("records"),
        F.sum("page_views").alias("page_views"),
        F.max(F.col("sob").cast("long")).alias("last_sob"),
    )


QUERIES = {
    "slice_scan": slice_scan,
    "slice_label": slice_labels,
    "slice_expand": slice_expand,
    "slice_fanout": slice_fanout,
    "slice_output": slice_output,
}

_SLICES = 'SELECT c_custkey * 100 AS "start", c_custkey * 100 + c_nationkey AS "end" FROM customer'
_FANOUT = duck.with_draws(
    f"""SELECT s_suppkey AS slice_num, record_num, s_suppkey * {SLICE_ROWS} + record_num AS row_id
        FROM supplier, range({SLICE_ROWS}) AS numbers(record_num)""",
    "row_id", SEED,
)
_ORDER_ROWS = duck.with_draws(
    f"""SELECT o_orderkey AS row_id, o_orderkey // size AS slice_num, o_orderkey % size AS record_num
        FROM orders, (SELECT (max(o_orderkey) + {SLICES}) // {SLICES} AS size FROM orders)""",
    "row_id", SEED,
)
ORACLES = {
    "slice_scan": _SLICES,
    "slice_label": f"""SELECT "start" || ' | ' || "end" AS label FROM ({_SLICES})""",
    "slice_expand": f'SELECT "start", unnest(generate_series("start", "end")) AS id FROM ({_SLICES})',
    "slice_fanout": f"""
        SELECT slice_num, CAST(record_num AS VARCHAR) AS sob, 1 + {duck.below(100, "page_views")} AS page_views
        FROM ({_FANOUT})
    """,
    "slice_output": f"""
        SELECT printf('slice-%03d', slice_num) AS slice, count(*) AS records,
               CAST(sum(1 + {duck.below(100, "page_views")}) AS BIGINT) AS page_views,
               max(record_num) AS last_sob
        FROM ({_ORDER_ROWS}) GROUP BY 1
    """,
}
