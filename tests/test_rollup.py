"""The rollup of sizes by path, against a plain computation."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rowloom.operators import rollup
from tests.conftest import plan_of


def listing(spark, rows):
    return spark.createDataFrame(rows, "size string, path string")


def test_lines(spark):
    lines = [
        "100644 blob " + "a" * 40 + "    1234\tsrc/main file.c",
        "160000 commit " + "b" * 38 + "       -\tvendor",
        "100644 blob " + "c" * 40 + " 12345678\tbig",
    ]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    assert [tuple(row) for row in rollup.flatten_lines(df).collect()] == [
        ("1234", "src/main file.c"), ("-", "vendor"), ("12345678", "big")]


def test_nested_revisions(spark):
    df = spark.createDataFrame(
        [("r1", [("1", "a"), ("2", "b")]), ("r2", [])], "rev string, files array<struct<size: string, path: string>>")
    assert sorted(map(tuple, rollup.flatten_revisions(df).collect())) == [("1", "a"), ("2", "b")]


@pytest.mark.parametrize(
    "text, number", [("12", 12), ("-", 0), ("", 0), ("abc", 0), ("12abc", 12), (" 7", 7), ("-3", -3), (None, 0)])
def test_size_number(spark, text, number):
    df = listing(spark, [(text, "p")])
    assert df.select(rollup.size_number(F.col("size")).alias("n")).first().n == number


def test_against_plain_computation(spark):
    chance = random.Random(5)
    rows = [(chance.choice(["-", *map(str, range(1, 40))]), f"p{chance.randrange(60)}") for _ in range(5000)]
    rows += [(str(n % 50), "hot") for n in range(4000)]
    totals = {}
    for size, path in set(rows):
        totals[path] = totals.get(path, 0) + (0 if size == "-" else int(size))
    expected = sorted(((total, path) for path, total in totals.items()), reverse=True)[:20]
    found = rollup.top_paths(listing(spark, rows)).collect()
    assert [(row.total, row.path) for row in found] == expected


def test_ties_go_by_path_descending(spark):
    rows = [("5", "a"), ("5", "c"), ("5", "b"), ("9", "z")]
    assert [row.path for row in rollup.top_paths(listing(spark, rows), 3).collect()] == ["z", "c", "b"]


def test_plan_is_a_top_k_without_full_sort(spark):
    plan = plan_of(rollup.top_paths(listing(spark, [("1", "a")])))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
    # The distinct spreads a hot path over its sizes; the sum is partial before its shuffle.
    assert "hashpartitioning(size" in plan and "partial_sum" in plan


def test_batches_add_up_to_one_run(spark, tmp_path):
    draw = random.Random(4)
    rows = [(draw.choice(["1", "20", "300", "-", None, ""]), draw.choice(["a", "b", "c d", None])) for _ in range(400)]
    parts = [rows[:150], rows[100:300], [], rows[300:], [("7", "late")]]
    state = rollup.RollupState.create(spark, str(tmp_path / "state"), listing(spark, rows))
    assert state.top_paths().collect() == []
    for batch, part in enumerate(parts, start=1):
        state.add(listing(spark, part), batch)
        state.add(listing(spark, part), batch)  # a batch that is added again replaces itself
    whole = listing(spark, [row for part in parts for row in part])
    assert state.pairs().count() == rollup.distinct_sizes(whole).count()
    again = rollup.RollupState(spark, str(tmp_path / "state"))
    assert again.top_paths(3).collect() == rollup.top_paths(whole, 3).collect()
    assert sorted(again.totals().collect(), key=repr) == sorted(rollup.sum_by_path(rollup.distinct_sizes(whole)).collect(), key=repr)
    # One of an earlier batch, added again, keeps what the others hold.
    state.add(listing(spark, parts[0]), 1)
    assert again.top_paths(9).collect() == rollup.top_paths(whole, 9).collect()
    with pytest.raises(ValueError):
        state.add(whole, 0)
