"""Draws: deterministic, independent of the layout, even, and free of visible patterns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rowloom.functions.draws import NARROW_RANGE, WIDE_RANGE, below, with_draws
from tests.conftest import plan_of

ROWS = 200_000


def keyed(spark, seed=1, partitions=4, first=0, rows=ROWS):
    return with_draws(spark.range(first, first + rows, 1, partitions), "id", seed)


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def chi_square(counts, cells, total):
    expected = total / cells
    return sum((counts.get(cell, 0) - expected) ** 2 / expected for cell in range(cells))


def test_same_for_any_partitioning(spark):
    draws = [below(1000, "x").alias("x"), below(1 << 40, "y").alias("y")]
    one, many = (keyed(spark, partitions=n, rows=2000).select("id", *draws) for n in (1, 13))
    assert sorted(one.collect()) == sorted(many.collect())
    shuffled = with_draws(spark.range(2000).repartition(7), "id", 1).select("id", *draws)
    assert sorted(shuffled.collect()) == sorted(one.collect())


def test_seed_label_and_index_change_values(spark):
    base = values(keyed(spark, rows=1000), below(1000, "x"))
    assert values(keyed(spark, seed=2, rows=1000), below(1000, "x")) != base
    assert values(keyed(spark, rows=1000), below(1000, "y")) != base
    assert values(keyed(spark, rows=1000), below(1000, "x", 1)) != base


@pytest.mark.parametrize("first", [0, 1 << 33, -ROWS])
def test_even(spark, first):
    # 99 degrees of freedom: 160 is passed by chance about once in ten thousand runs.
    counted = keyed(spark, first=first).groupBy(below(100, "x").alias("x")).count().collect()
    assert chi_square({row[0]: row[1] for row in counted}, 100, ROWS) < 160


def test_neighbours_and_columns_are_independent(spark):
    x, y = below(10, "x"), below(10, "y")
    across = keyed(spark).groupBy((x * 10 + y).alias("pair")).count().collect()
    assert chi_square({row[0]: row[1] for row in across}, 100, ROWS) < 160
    drawn = sorted(keyed(spark).select("id", x.alias("x")).collect())
    pairs = {}
    for left, right in zip(drawn, drawn[1:]):
        cell = left.x * 10 + right.x
        pairs[cell] = pairs.get(cell, 0) + 1
    assert chi_square(pairs, 100, ROWS - 1) < 160


def test_keys_that_differ_in_high_bits_differ(spark):
    low = values(keyed(spark, rows=1000), below(1 << 30, "x"))
    high = values(keyed(spark, first=1 << 40, rows=1000), below(1 << 30, "x"))
    assert len(set(low) & set(high)) < 5


def test_wide_range_is_filled(spark):
    size = 315_532_801
    assert size > NARROW_RANGE
    drawn = values(keyed(spark), below(size, "t"))
    assert 0 <= min(drawn) < size * 0.001 and size * 0.999 < max(drawn) < size
    counts = {}
    for value in drawn:
        counts[value * 100 // size] = counts.get(value * 100 // size, 0) + 1
    assert chi_square(counts, 100, ROWS) < 160


@pytest.mark.parametrize("size", [0, -1, WIDE_RANGE + 1])
def test_other_ranges_are_refused(size):
    with pytest.raises(ValueError):
        below(size, "x")


def test_stays_in_generated_code(spark):
    plan = plan_of(keyed(spark).select(below(100, "x").alias("x"), F.col("id")))
    assert "Python" not in plan and "Exchange" not in plan
