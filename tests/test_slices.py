"""Slices: strict parsing, display, and expansion that spreads a large slice."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowloom import jobs
from rowloom.operators.ranges import expand_ranges
from rowloom.sources.files import write_parquet
from rowloom.sources.slices import parse_slices, read_slices, slice_label, slice_name
from rowloom.sources.specs import ColumnSpec


def test_read_and_label(spark, tmp_path):
    (tmp_path / "slices.txt").write_text("0|1|300\n1|301| 600 |more\nx|-5|5\n")
    slices = read_slices(spark, str(tmp_path / "slices.txt"))
    assert [tuple(row) for row in slices.collect()] == [(1, 300), (301, 600), (-5, 5)]
    label = slices.select(slice_label(F.col("start"), F.col("end")).alias("label")).first().label
    assert label == "1 | 300"


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("line", ["", "1|2", "1|a|3", "1|2|b", "1|2|", "1|2.5|3"])
def test_bad_line_fails_the_load(spark, ansi, line):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        slices = parse_slices(spark.createDataFrame([("0|1|2",), (line,)], "value string"))
        for read in (slices, slices.select("start"), slices.select("end")):
            with pytest.raises(Exception, match="not a slice"):
                read.collect()
        with pytest.raises(Exception, match="not a slice"):
            slices.count()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_slice_names(spark):
    names = spark.createDataFrame([(1,), (42,), (1234,)], "n long").select(slice_name(F.col("n")).alias("name"))
    assert [row.name for row in names.collect()] == ["slice-001", "slice-042", "slice-1234"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-50, 50), st.integers(-60, 80)), max_size=6), st.integers(1, 9))
def test_expansion_is_complete(spark, ranges, block_rows):
    df = spark.createDataFrame(ranges, "start long, end long")
    found = expand_ranges(df, block_rows=block_rows, partitions=3).collect()
    expected = [(start, end, n) for start, end in ranges for n in range(start, end + 1)]
    assert sorted(map(tuple, found)) == sorted(expected)


def test_one_large_slice_runs_on_many_tasks(spark):
    df = spark.createDataFrame([(0, 799_999), (5, 6)], "start long, end long")
    rows = expand_ranges(df, block_rows=10_000, partitions=8)
    per_task = rows.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(row["count"] for row in per_task) == 800_002
    assert len(per_task) == 8 and max(row["count"] for row in per_task) < 200_000


def test_copies_of_a_slice_run_on_many_tasks(spark):
    df = spark.createDataFrame([(0, 99)] * 80, "start long, end long")
    per_task = expand_ranges(df, partitions=8).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(row["count"] for row in per_task) == 8000
    assert len(per_task) == 8 and max(row["count"] for row in per_task) < 3000


SPECS = [ColumnSpec("sob", "TEXT"), ColumnSpec("page_views", "BIGINT"), ColumnSpec("core_action", "TEXT")]


def _fresh_and_resumed(spark, tmp_path, dictionary, keep, first=3, last=7, rows=50, again=None):
    """A whole folder, and one that held what ``keep`` kept of it (``again`` twice) before it was resumed."""
    whole, path = str(tmp_path / "whole"), str(tmp_path / "part")
    jobs.write_slices(spark, SPECS, whole, first, last, dictionary, rows, seed=4)
    fresh = spark.read.parquet(whole)
    if keep is not None:
        write_parquet(fresh.where(keep), path, partition_by="slice")
    if again is not None:
        write_parquet(fresh.where(again), path, partition_by="slice")
    jobs.resume_slices(spark, SPECS, path, first, last, dictionary, rows, seed=4)
    return fresh, path


@pytest.mark.parametrize(
    "keep, again",
    [
        (None, None),
        ("false", None),
        ("true", None),
        ("slice <> 'slice-004' and (slice <> 'slice-006' or sob < '3')", "slice = 'slice-007'"),
    ],
)
def test_resumed_slices_equal_a_fresh_run(spark, tmp_path, dictionary, keep, again):
    fresh, path = _fresh_and_resumed(spark, tmp_path, dictionary, keep, again=again)
    assert sorted(fresh.collect()) == sorted(spark.read.parquet(path).select(fresh.columns).collect())
    assert jobs.unfinished_slices(spark, path, 3, 7, 50).count() == 0


def test_only_unfinished_slices_are_written(spark, tmp_path, dictionary):
    _, path = _fresh_and_resumed(spark, tmp_path, dictionary, "slice <> 'slice-004'")
    files = {file: file.stat().st_mtime_ns for file in (tmp_path / "part").rglob("*.parquet")}
    jobs.resume_slices(spark, SPECS, path, 3, 8, dictionary, 50, seed=4)
    after = {file: file.stat().st_mtime_ns for file in (tmp_path / "part").rglob("*.parquet")}
    assert files.items() <= after.items()
    assert {file.parent.name for file in set(after) - set(files)} == {"slice=slice-008"}
    found = [row.slice_num for row in jobs.unfinished_slices(spark, path, 2, 8, 51).collect()]
    assert sorted(found) == [2, 3, 4, 5, 6, 7, 8]
