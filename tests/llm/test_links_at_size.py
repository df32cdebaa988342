"""What the near-duplicate operators shuffle, and links of sets against loops."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.llm import jaccard
from rowloom.llm.common import possible


def shuffle_files(spark) -> dict[str, int]:
    """Bytes of the files that shuffles have left on disk."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [found.apply(i) for i in range(found.size())]
    return {f.getName(): f.length() for f in files if f.getName().startswith("shuffle_")}


@pytest.fixture
def no_broadcasts(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("query", [jaccard.one_of_each, jaccard.link_classes])
def test_texts_without_copies_are_not_shuffled(spark, no_broadcasts, tmp_path, monkeypatch, query):
    draw = np.random.default_rng(2)
    texts = [" ".join(f"{w:x}" for w in draw.integers(1 << 60, size=2500)) for _ in range(150)]
    words = texts[7].split()
    near = [" ".join(["other", *words[1:]]), " ".join([*words[:-1], "other"])]
    rows = list(enumerate([*texts, *near, texts[9], "", " \t", None]))
    spark.createDataFrame([*rows, rows[3]], "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    before, after = shuffle_files(spark), {}
    staged = jaccard.staged

    def watched(df, name):  # shuffles of earlier steps may be cleaned later
        out = staged(df, name)
        after.update(shuffle_files(spark))
        return out

    monkeypatch.setattr(jaccard, "staged", watched)
    out = query(docs)
    found = out.collect()
    after.update(shuffle_files(spark))
    shuffled = sum(size for name, size in after.items() if name not in before)
    gone = {150, 151, 152}
    if query is jaccard.one_of_each:
        assert sorted(r.doc_id for r in found) == [k for k in range(len(rows)) if k not in gone]
    else:
        classes = {r.doc_id: (r.class_id, r.n_links) for r in found if r.doc_id < 153}
        assert {k for k, (c, _) in classes.items() if c != k} == gone
        assert {k for k, (_, n) in classes.items() if n} == {3, 7, 9, *gone}
    assert shuffled < sum(map(len, texts)) / 4


def test_a_large_group_is_not_copied_for_every_few_of_its_texts(spark):
    draw = np.random.default_rng(3)
    base = [f"w{w}" for w in draw.integers(0, 10**6, 60)]
    texts = []
    for k in range(700):
        words = list(base)
        words[int(draw.integers(60))] = f"x{k}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = jaccard.signed(docs).groupBy("k1", "k2").agg(F.min("key").alias("key"), F.count("*").alias("copies"))
    reps = rows.withColumn("rid", F.col("key"))
    groups = reps.select(F.col("rid").alias("node"), F.lit(0).cast("long").alias("component"))
    found = jaccard.exact_links(docs, reps, groups).collect()
    assert len(found) == 700
    sets = [{tuple(t.split()[i : i + 5]) for i in range(56)} for t in texts]
    for r in found[::50]:
        own = sets[r.rid]
        assert r.links == sum(5 * len(own & s) >= 4 * len(own | s) for s in sets) - 1


def test_blocks_of_a_large_group_are_dealt_to_many_tasks(spark, no_broadcasts, monkeypatch):
    monkeypatch.setattr(jaccard, "EXACT_BLOCK", 10)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        docs = spark.range(120).selectExpr("id AS doc_id", "concat('a b c d e f g h i j k l m n o ', id) AS text")
        rows = jaccard.signed(docs).select("k1", "k2", "key", F.lit(1).cast("long").alias("copies"))
        reps = rows.withColumn("rid", F.col("key"))
        groups = reps.select(F.col("rid").alias("node"), F.lit(0).cast("long").alias("component"))
        found = jaccard.exact_links(docs, reps, groups).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set(name, before)
    assert len(found) == 120 * 12 and len({r.task for r in found}) > 3
    assert sum(r.links for r in found) == 120 * 119


def test_texts_that_share_a_passage_are_no_group(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BUCKET", 16)
    draw = np.random.default_rng(4)
    texts = []
    for k in range(1500):
        own = [f"w{w}" for w in draw.integers(0, 10**9, 40)]
        texts.append(" ".join([*own[:20], *(f"passage{i}" for i in range(14)), *own[20:]]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    reps = jaccard.signed(docs).withColumn("rid", F.col("key"))
    assert jaccard.bucket_links(reps).count() == 0


@pytest.mark.parametrize("cross", [False, True])
def test_links_of_sets_equal_loops(monkeypatch, cross):
    draw = np.random.default_rng(5)
    for _ in range(40):
        for name, values in (("EXACT_ROWS", (3, 7, 256)), ("COMMON", (1, 2, 16, 100)), ("PAIRS", (5, 100, 1 << 21))):
            monkeypatch.setattr(jaccard, name, int(draw.choice(values)))
        many = int(draw.integers(2, 40))
        bases = [draw.choice(300, int(draw.integers(1, 60)), replace=False) for _ in range(3)]
        sets = []
        for _ in range(many):
            base = bases[draw.integers(3)]
            more = draw.integers(1000, 1000 + int(draw.choice([5, 10**6])), int(draw.integers(0, 5)))
            sets.append(np.unique(np.concatenate([base[:1], base[draw.random(len(base)) < 0.95], more])).astype(np.uint64))
        copies, other = draw.integers(1, 5, many), draw.random(many) < 0.5
        n = np.array([len(s) for s in sets])
        links, label = jaccard.set_links(np.concatenate(sets), n, copies, other if cross else None)
        plain = [set(s.tolist()) for s in sets]
        linked = np.array(
            [
                [i != j and (not cross or other[i] != other[j]) and 5 * len(a & b) >= 4 * len(a | b) for j, b in enumerate(plain)]
                for i, a in enumerate(plain)
            ]
        )
        assert (links == linked @ copies).all()
        least = np.arange(many)
        for _ in range(many):
            least = np.array([min([least[i], *least[linked[i]]]) for i in range(many)])
        assert (label == least).all()


def test_a_bitmap_lets_its_own_hashes_pass_and_few_others(spark):
    hashes = spark.range(3000).select(F.xxhash64("id").alias("h"))
    passes = possible(hashes)
    found = spark.range(30000).select("id", passes(F.xxhash64("id")).alias("met")).where("met").collect()
    ids = {r.id for r in found}
    assert ids.issuperset(range(3000)) and len(ids) < 3000 + 27000 * 0.15
    assert not spark.range(100).where(possible(hashes.limit(0))(F.xxhash64("id"))).count()
