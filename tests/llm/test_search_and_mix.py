"""Top-k search, mixing and fingerprints against brute force."""

from __future__ import annotations

import hashlib

import numpy as np

from rowloom.llm.fingerprints import edited_pairs
from rowloom.llm.mixing import SplitTree, mix, mixed_texts, permuted, targets
from rowloom.llm.topk import integer_vectors, top_k


def test_top_k_with_ties_copies_and_bad_vectors(spark):
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(size=6).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 400)]
    rows += [(400, None), (401, [1.0, None] + [0.0] * 4), (402, [float("nan")] * 6), (None, rows[0][1]), (500, [9.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = integer_vectors(frame)
    found = {}
    for r in top_k(vectors, vectors.where("vec_id % 100 = 0"), k=5).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    whole = {i: np.floor(1024 * np.array(v)).astype(int) for i, v in rows[:400]}
    for query in (0, 100, 200, 300):
        scores = sorted((-int(whole[query] @ v), i) for i, v in whole.items() if i != query)[:5]
        assert sorted(found[query]) == [(n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    assert set(found) == {0, 100, 200, 300}


def test_top_k_of_an_empty_table(spark):
    vectors = integer_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert top_k(vectors, vectors).collect() == []


def test_targets_stop_at_the_cap():
    found = targets({"b": 100, "a": 10, None: 10})
    assert found["a"] == 20 and found[None] == 20 and found["b"] == 140


def test_permutation_and_tree_are_exact():
    assert sorted(permuted(np.arange(1000), 1000, 5).tolist()) == list(range(1000))
    tree = SplitTree([70, 30, 0], 7, 3)
    quotas = np.array([tree.quota(s) for s in range(7)])
    assert quotas.sum(axis=0).tolist() == [70, 30, 0] and set(quotas.sum(axis=1)) <= {14, 15}
    for code, drawn in enumerate((70, 30)):
        shards = tree.shard_of(code, np.arange(drawn))
        assert np.bincount(shards, minlength=7).tolist() == quotas[:, code].tolist()


def test_mix_reaches_targets_and_repeats(spark):
    rows = [(i, "w " * (i % 37), f"s{i % 3}" if i % 4 else None, 5) for i in range(400)] + [(None, None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    first = sorted(mix(docs).collect(), key=repr)
    assert first == sorted(mix(docs.repartition(5)).collect(), key=repr)
    assert len(first) == 401 and all(r.taken <= 2 * r.size for r in first)
    for source in {r.source for r in first}:
        mine = [r for r in first if r.source == source]
        assert mine[0].source_size == sum(r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(2, 0.01 * mine[0].target)
    texts = mixed_texts(docs).collect()
    assert sum(len(r.text.split()) for r in texts) == sum(r.taken for r in first)
    assert all(r.n_chars == len(r.text) for r in texts)


def test_fingerprints_follow_jaccard(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(5, " ".join(words)), (4, " ".join(words)), (3, " ".join(words[:380] + ["x"] * 20)), (2, "one two"), (1, None), (1, "")]
    found = {(r.doc_id, r.n_chars): r for r in edited_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(found) >= 5
    five, four, two = found[5, len(rows[0][1])], found[4, len(rows[1][1])], found[2, 7]
    assert five.fingerprint == four.fingerprint and five.near_next == 1.0
    assert abs(four.near_next - 376 / 412) < 0.12
    text = rows[0][1]
    half = len(text) // 2
    assert five.edited_sha256 == hashlib.sha256((text[: len(text) - half] + text[:half]).encode()).hexdigest()
    assert two.near_next == 0.0 and found[1, 0].fingerprint == ""
