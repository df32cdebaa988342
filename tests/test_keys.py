"""Unique keys, named generators, and rows that keep their specs."""

from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowloom.functions.draws import with_draws
from rowloom.functions.keys import bits_within, key_number, key_text, with_keys
from rowloom.operators.audit import audit
from rowloom.operators.generate import generate
from rowloom.operators.named import alias_table, named_generator
from rowloom.operators.rules import PROFILE_A, PROFILE_B
from rowloom.operators.spines import chunk_spine
from rowloom.sources import specs as spec_tables
from rowloom.sources.specs import ColumnSpec
from tests.conftest import plan_of

AS_OF = datetime(2024, 1, 1)


@pytest.mark.parametrize("bits", [1, 2, 3, 7, 10, 13])
def test_every_number_of_a_domain_is_met_once(spark, bits):
    rows = with_keys(spark.range(1 << bits).withColumnRenamed("id", "row_id"), [("a", bits), ("b", bits)], seed=3)
    found = [tuple(row) for row in rows.select("row_id", key_number(0), key_number(1)).collect()]
    for column in (1, 2):
        assert sorted(row[column] for row in found) == list(range(1 << bits))
    if bits >= 7:
        assert sum(row[0] == row[1] for row in found) < 10
        assert sum(row[1] == row[2] for row in found) < 10


def test_wide_keys_spread_and_fit_their_length(spark):
    far = spark.range(0, 1 << 60, (1 << 60) // 5000).withColumnRenamed("id", "row_id")
    near = spark.range(5000).withColumnRenamed("id", "row_id")
    rows = with_keys(near.unionAll(far.where("row_id >= 5000")), [("k", 60)])
    found = rows.select(key_number(0).alias("n"), key_text(0, 12).alias("t"))
    assert found.distinct().count() == rows.count() == found.select("t").distinct().count()
    assert found.where("length(t) <> 12 OR n < 0").count() == 0
    # A tenth of the range holds about a tenth of the keys of consecutive rows.
    tenths = with_keys(near, [("k", 60)]).groupBy(F.floor(key_number(0) * 10.0 / (1 << 60))).count().collect()
    assert len(tenths) == 10 and all(400 < row["count"] < 600 for row in tenths)


def test_rows_beyond_a_domain_fail(spark):
    rows = with_keys(spark.range(9).withColumnRenamed("id", "row_id"), [("k", 3)])
    with pytest.raises(Exception, match="outside the 3 bits"):
        rows.select(key_number(0)).collect()
    with pytest.raises(ValueError, match="two values or more"):
        bits_within(1)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=12).filter(any))
def test_alias_tables_hold_the_weights_exactly(weights):
    cutoffs, others = alias_table(weights)
    total, drawn = sum(weights), [0] * len(weights)
    for place in range(len(weights)):
        drawn[place] += cutoffs[place]
        drawn[others[place]] += total - cutoffs[place]
    assert drawn == [weight * len(weights) for weight in weights]


def test_weighted_draws(spark):
    rows = with_draws(spark.range(60_000).withColumnRenamed("id", "row_id"), seed=5)
    column = named_generator('weighted {"a,\\n": 1, "b": 0, "c": 3, "é": 8}', "x")
    found = {row.x: row["count"] for row in rows.groupBy(column.alias("x")).count().collect()}
    assert set(found) == {"a,\n", "c", "é"}
    for text, weight in {"a,\n": 1, "c": 3, "é": 8}.items():
        assert abs(found[text] - 5000 * weight) < 400


@pytest.mark.parametrize(
    "text", ["unheard", "weighted", "weighted {}", 'weighted {"a": 0}', 'weighted {"a": 1.5}', 'weighted {"a": -1}',
             "between [2, 1]", "between [1]", "fixed [1]"]
)
def test_bad_generators_are_refused(text):
    with pytest.raises(ValueError):
        named_generator(text, "x")


KEPT = [
    ColumnSpec("code", "CHARACTER VARYING", 4, 4, not_null=True, unique=True),
    ColumnSpec("n", "BIGINT", unique=True),
    ColumnSpec("at", "DATETIME", unique=True),
    ColumnSpec("sob", "CHARACTER VARYING", 3, 3, not_null=True, primary_key=True),
    ColumnSpec("flag", "BOOLEAN", not_null=True, primary_key=True),
    ColumnSpec("name", "CHARACTER VARYING", 6, 6, not_null=True),
    ColumnSpec("kind", "CHARACTER VARYING", 3, 3, generator='weighted {"short": 1, "longer": 2}'),
    ColumnSpec("score", "BIGINT", generator="between [-5, 5]"),
]


@pytest.mark.parametrize("profile", [PROFILE_A, PROFILE_B])
def test_rows_keep_their_specs(spark, dictionary, profile, tmp_path):
    spine = chunk_spine(spark, 40, 500)
    rows = generate(spine, KEPT, profile, None, 2, AS_OF, keep_specs=True)
    plan = plan_of(rows)
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan
    rows.write.parquet(str(tmp_path / "rows"))
    written = spark.read.parquet(str(tmp_path / "rows"))
    assert [tuple(row)[2:] for row in audit(written, KEPT).collect()] == [(0, 0, 0)] * len(KEPT)
    assert {row.kind for row in written.select("kind").distinct().collect()} == {"sho", "lon"}
    assert written.agg(F.min("score"), F.max("score")).first() == (-5, 5)
    # Without the mode the same specs are broken: record numbers restart and integers repeat.
    free = generate(spine, KEPT, profile, dictionary, 2, AS_OF)
    loose = {row.name: row.duplicate_count for row in audit(free, KEPT).collect()}
    assert loose["n"] > 0 and loose["sob"] > 0


def test_keys_do_not_depend_on_partitions(spark):
    specs = KEPT[:2]
    few, many = (
        generate(chunk_spine(spark, 10, 30, partitions=parts), specs, PROFILE_B, None, 2, AS_OF, keep_specs=True)
        for parts in (1, 7)
    )
    assert sorted(few.collect()) == sorted(many.collect())


def test_what_cannot_be_kept_is_refused(spark):
    spine = chunk_spine(spark, 1, 3)
    with pytest.raises(Exception, match="outside the 1 bits"):
        generate(spine, [ColumnSpec("b", "BOOLEAN", unique=True)], PROFILE_A, keep_specs=True).collect()
    with pytest.raises(ValueError, match="does not promise"):
        generate(spine, [ColumnSpec("b", "TEXT", unique=True, generator='fixed "x"')], PROFILE_A, keep_specs=True)
    with pytest.raises(ValueError, match="two values or more"):
        generate(spine, [ColumnSpec("b", "TEXT", 0, unique=True)], PROFILE_A, keep_specs=True)


def test_generators_of_ones_own_and_in_documents(spark, tmp_path):
    columns = [ColumnSpec("a", "TEXT", generator='twice {"it\'s": 1}'), ColumnSpec("b", "BIGINT", generator="between [3, 3]")]
    path = str(tmp_path / "spec")
    spec_tables.write_spec_document(spec_tables.specs_table(spark, columns), path)
    read = spec_tables.collect_specs(spec_tables.read_spec_documents(spark, path))
    assert read == columns
    own = {"twice": lambda label, given: F.lit(2 * next(iter(given))), "between": lambda label, ends: F.lit(ends[0])}
    rows = generate(chunk_spine(spark, 1, 2), read, PROFILE_B, generators=own)
    assert [tuple(row) for row in rows.collect()] == [("it'sit's", 3)] * 2
    assert rows.schema["b"].dataType.simpleString() == "bigint"
