"""Dictionaries: a dense index, and the same picks on both paths."""

from __future__ import annotations

import hashlib

import pytest

from rowloom.functions.draws import with_draws
from rowloom.operators.dictionary import Dictionary, Pick, index_words, read_words, words_of
from tests.conftest import plan_of

PICKS = [Pick("a", "first", 0, "word"), Pick("b", "first", 1, "word"), Pick("c", "second", 0, "hash_id")]


def test_words_of_texts(spark):
    texts = spark.createDataFrame([("The cat, the CAT; a Ünder-way it's",), ("",), (None,)], "text string")
    assert sorted(row.word for row in words_of(texts, "text").collect()) == ["a", "cat", "it", "s", "the", "way", "ünder"]


def test_index_is_dense_in_digest_order(spark):
    words = [f"w{n}" for n in range(10_000)]
    df = spark.createDataFrame([(word,) for word in words + words[:3000]], "word string")
    found = {row.idx: (row.word, row.hash_id) for row in index_words(df).collect()}
    digests = sorted((hashlib.sha256(word.encode()).hexdigest(), word) for word in words)
    assert found == {n: (word, digest[50:]) for n, (digest, word) in enumerate(digests)}


def test_index_sorts_no_words_in_one_task(spark):
    words = spark.range(100).selectExpr("cast(id as string) AS word")
    plan = plan_of(index_words(words))
    # The only single-task window is the one over the bucket sizes.
    assert plan.split("== Initial Plan ==")[0].count("Exchange SinglePartition") == 1
    assert "[bucket" in plan


def test_word_list_file(spark, tmp_path):
    (tmp_path / "words").write_text("alpha\nbeta\ngamma\n")
    dictionary = Dictionary.build(read_words(spark, str(tmp_path / "words")))
    assert dictionary.size == 3
    assert {row.word for row in dictionary.entries.collect()} == {"alpha", "beta", "gamma"}


def test_empty_dictionary_is_refused(spark):
    with pytest.raises(ValueError):
        Dictionary.build(spark.createDataFrame([], "word string"))


@pytest.mark.parametrize("picks", [PICKS, PICKS[:1], PICKS[2:], []])
def test_both_paths_agree(spark, dictionary, picks):
    rows = with_draws(spark.range(2000).withColumnRenamed("id", "row_id"))
    small = dictionary.attach(rows, picks)
    large = dictionary.attach(rows, picks, broadcast_bytes=0)
    assert small.columns == large.columns
    assert sorted(small.collect()) == sorted(large.collect())


def test_every_word_is_picked(spark, dictionary):
    rows = with_draws(spark.range(10_000).withColumnRenamed("id", "row_id"))
    found = dictionary.attach(rows, PICKS).select("a").distinct().collect()
    assert {row.a for row in found} == {f"word{n}" for n in range(500)}


def test_size_decides_the_path(spark, dictionary):
    rows = with_draws(spark.range(5).withColumnRenamed("id", "row_id"))
    small = plan_of(dictionary.attach(rows, PICKS, broadcast_bytes=dictionary.in_memory_bytes))
    large = plan_of(dictionary.attach(rows, PICKS, broadcast_bytes=dictionary.in_memory_bytes - 1))
    assert "Join" not in small
    assert "ShuffledHashJoin" in large and "Broadcast" not in large
    for plan in (small, large):
        assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("columns", [["row_id", "a", "b", "c"], ["row_id"], ["c"]])
def test_null_and_repeated_keys_on_both_paths(spark, dictionary, columns):
    rows = with_draws(spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "row_id long"))
    small = dictionary.attach(rows, PICKS).select(columns)
    large = dictionary.attach(rows, PICKS, broadcast_bytes=0).select(columns)
    assert small.count() == large.count() == 5
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))


def test_null_words_have_no_number(spark):
    words = spark.createDataFrame([("a",), (None,), ("b",)], "word string")
    assert sorted(row.idx for row in index_words(words).collect()) == [0, 1]


def _words(spark, *words):
    return spark.createDataFrame([(w,) for w in words], "word string")


def test_a_saved_dictionary_is_opened_and_extended(spark, tmp_path):
    first = [f"w{n}" for n in range(3000)]
    more = [*first[:50], *(f"new{n}" for n in range(700)), None, "new1"]
    built = Dictionary.build(_words(spark, *first))
    built.save(f"{tmp_path}/one")
    opened = Dictionary.open(spark, f"{tmp_path}/one")
    assert (opened.size, opened.in_memory_bytes) == (built.size, built.in_memory_bytes)
    assert sorted(opened.entries.collect()) == sorted(built.entries.collect())
    grown = Dictionary.extend(spark, f"{tmp_path}/one", _words(spark, *more), f"{tmp_path}/two")
    whole = Dictionary.build(_words(spark, *first, *more))
    assert (grown.size, grown.in_memory_bytes) == (whole.size, whole.in_memory_bytes) == (3700, whole.in_memory_bytes)
    assert sorted(grown.entries.collect()) == sorted(whole.entries.collect())
    rows = with_draws(spark.range(500).withColumnRenamed("id", "row_id"))
    want = sorted(whole.attach(rows, PICKS).collect())
    assert sorted(grown.attach(rows, PICKS).collect()) == sorted(grown.attach(rows, PICKS, broadcast_bytes=0).collect()) == want
    # The first dictionary stays, and words that are there already change nothing.
    assert sorted(Dictionary.open(spark, f"{tmp_path}/one").entries.collect()) == sorted(built.entries.collect())
    same = Dictionary.extend(spark, f"{tmp_path}/two", _words(spark, "w1", None), f"{tmp_path}/three")
    assert sorted(same.entries.collect()) == sorted(whole.entries.collect())


def test_opening_scans_no_words(spark, tmp_path):
    Dictionary.build(_words(spark, *(f"w{n}" for n in range(100)))).save(f"{tmp_path}/d")
    for part in (tmp_path / "d" / "words").glob("*"):
        part.unlink()
    for part in (tmp_path / "d" / "words").glob(".*"):
        part.unlink()
    assert Dictionary.open(spark, f"{tmp_path}/d").size == 100


def test_few_new_words_leave_other_buckets_alone(spark, tmp_path):
    Dictionary.build(_words(spark, *(f"w{n}" for n in range(2000)))).save(f"{tmp_path}/one")
    Dictionary.extend(spark, f"{tmp_path}/one", _words(spark, "added"), f"{tmp_path}/two")
    stored = [{r.word: (r.bucket, r.place) for r in spark.read.parquet(f"{tmp_path}/{n}/words").collect()} for n in ("one", "two")]
    bucket = stored[1]["added"][0]
    assert all(stored[1][w] == at for w, at in stored[0].items() if at[0] != bucket)
    with pytest.raises(Exception):
        Dictionary.extend(spark, f"{tmp_path}/one", _words(spark, "again"), f"{tmp_path}/two")


def _shuffled_bytes_a_pick(spark, dictionary, rows, picks) -> float:
    """Bytes that the shuffled path hands on in its shuffles, per pick, by the sizes that its plan measured."""
    found = dictionary.attach(rows, picks, broadcast_bytes=0)
    found.collect()
    total = 0

    def walk(node):
        nonlocal total
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name == "ResultQueryStageExec":
            return walk(node.plan())
        if name == "ShuffleQueryStageExec":
            total += node.shuffle().metrics().apply("dataSize").value()
            return walk(node.shuffle().child())
        for n in range(node.children().size()):
            walk(node.children().apply(n))

    walk(found._jdf.queryExecution().executedPlan())
    return total / (rows.count() * len(picks))


def test_shuffled_picks_carry_no_columns_of_their_rows(spark):
    dictionary = Dictionary.build(spark.range(2000).selectExpr("concat('word', id) AS word"))
    picks = [Pick(f"p{n}", "value", n, "word") for n in range(20)]
    rows = with_draws(spark.range(4000).selectExpr("id AS row_id", "repeat(cast(id AS string), 30) AS wide"))
    # Two numbers out, a number and a word back; the rows themselves, once for all their picks.
    assert 0 < _shuffled_bytes_a_pick(spark, dictionary, rows, picks) < 110


def test_index_shuffles_no_digests(spark):
    words = spark.range(3000).selectExpr("concat('w', id) AS word")
    indexed = index_words(words)
    plan = plan_of(indexed).split("== Initial Plan ==")[-1]
    below = plan.split("Window")[-1].split("Exchange hashpartitioning(bucket")[1]
    assert "sha2(cast(word" in plan.split("Exchange hashpartitioning(bucket")[0] and "digest" not in below.split("\n")[1]
    assert indexed.count() == 3000


def test_more_than_ten_and_a_hundred_picks_keep_their_order(spark, dictionary):
    picks = [Pick(f"p{n}", "label", n, "hash_id" if n % 3 else "word") for n in range(120)]
    rows = with_draws(spark.range(40).withColumnRenamed("id", "row_id"))
    assert sorted(dictionary.attach(rows, picks).collect()) == sorted(dictionary.attach(rows, picks, 0).collect())


def test_rows_that_lack_their_words_fail(spark, dictionary):
    short = dictionary._replace(entries=dictionary.entries.where("idx < 400"))
    rows = with_draws(spark.range(200).withColumnRenamed("id", "row_id"))
    with pytest.raises(Exception, match="lacks words"):
        short.attach(rows, PICKS, broadcast_bytes=0).collect()
