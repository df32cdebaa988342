"""Sums of distinct sizes per path, with line items as the files of revisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.operators import rollup
from rowloom.plans.inputs import spread_table, table
from rowloom.storage import scratch_path


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return items.select(F.col("l_quantity").cast("long").alias("size"), F.col("l_partkey").alias("path"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as long tree listings; returned items have no size."""
    size = F.when(F.col("l_returnflag") == "R", "-").otherwise(F.col("l_quantity").cast("long").cast("string"))
    path = F.concat(F.lit("parts/"), F.col("l_partkey").cast("string"))
    object_id = F.sha1(F.col("l_orderkey").cast("string"))
    line = F.concat(F.lit("100644 blob "), object_id, F.lit(" "), F.lpad(size, 7, " "), F.lit("\t"), path)
    items = spread_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    return items.select(line.alias("value"))


def flatten_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.flatten_lines(_lines(spark, sf_dir))


def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.distinct_sizes(rollup.flatten_lines(_lines(spark, sf_dir)))


def sum_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.sum_by_path(rollup.flatten_lines(_lines(spark, sf_dir)))


def totals_largest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.largest_first(rollup.sum_by_path(rollup.distinct_sizes(_files(spark, sf_dir))))


def listing_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.top_paths(rollup.flatten_lines(_lines(spark, sf_dir)))


def rollup_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.top_paths(_files(spark, sf_dir))


def _grown(spark: SparkSession, sf_dir: str) -> rollup.RollupState:
    """The files of three batches of revisions, added one after another, the second once more."""
    items = table(spark, sf_dir, "lineitem")
    files = items.select(
        F.col("l_quantity").cast("long").alias("size"), F.col("l_partkey").alias("path"), (F.col("l_orderkey") % 3).alias("turn")
    )
    state = rollup.RollupState.create(spark, scratch_path(spark, "rollup"), files)
    for batch in (1, 2, 3, 2):
        state.add(files.where(F.col("turn") == batch - 1), batch)
    return state


def grown_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grown(spark, sf_dir).totals()


def grown_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grown(spark, sf_dir).top_paths()


QUERIES = {
    "flatten_listing": flatten_listing,
    "distinct_pairs": distinct_pairs,
    "sum_by_path": sum_by_path,
    "totals_largest_first": totals_largest_first,
    "listing_top20": listing_top20,
    "rollup_top20": rollup_top20,
    "grown_totals": grown_totals,
    "grown_top20": grown_top20,
}

_LISTING = """
    SELECT CASE WHEN l_returnflag = 'R' THEN '-' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS size,
           'parts/' || l_partkey AS path
    FROM lineitem
"""
_TOTALS = """
    SELECT l_partkey AS path, CAST(sum(DISTINCT CAST(l_quantity AS BIGINT)) AS BIGINT) AS total
    FROM lineitem GROUP BY l_partkey
"""
ORACLES = {
    "flatten_listing": _LISTING,
    "distinct_pairs": f"SELECT DISTINCT size, path FROM ({_LISTING})",
    "sum_by_path": f"""
        SELECT path, CAST(sum(CASE WHEN size = '-' THEN 0 ELSE CAST(size AS BIGINT) END) AS BIGINT) AS total
        FROM ({_LISTING}) GROUP BY path
    """,
    "totals_largest_first": f"{_TOTALS} ORDER BY total DESC, path DESC",
    "listing_top20": """
        SELECT 'parts/' || l_partkey AS path,
               CAST(coalesce(sum(DISTINCT CAST(l_quantity AS BIGINT)) FILTER (l_returnflag <> 'R'), 0) AS BIGINT)
                   AS total
        FROM lineitem GROUP BY l_partkey ORDER BY total DESC, path DESC LIMIT 20
    """,
    "rollup_top20": f"{_TOTALS} ORDER BY total DESC, path DESC LIMIT 20",
    "grown_totals": _TOTALS,
    "grown_top20": f"{_TOTALS} ORDER BY total DESC, path DESC LIMIT 20",
}
