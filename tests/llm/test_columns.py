"""No stage loses, changes or confuses a column of the table it is given."""

from __future__ import annotations

from collections import Counter

import numpy as np

import corpus_pipeline
from rowloom.llm.mixing import mixed_texts, piece_texts
from rowloom.llm.toxicity import text_words

# What operators call their own columns.
NAMES = "severity grade p1 p2 p3 scores size source_size target taken pieces class_id key body rid n tokens shard position row carried c0"


def test_columns_named_like_those_of_the_operators(spark, tmp_path):
    names = NAMES.split() + ["a.b", "a b"]
    draw = np.random.default_rng(3)
    rows = []
    for k in range(60):
        lines = [" ".join(f"w{i}" for i in draw.integers(0, 4000, 9)) for _ in range(6)]
        if k >= 40:
            lines[0] = "vile nasty gross " + lines[0]
        rows.append((k, "\n".join(lines), "en", f"s{k % 2}", 7, *(f"{name} {k}" for name in names)))
    rows.append((70, rows[3][1].replace("\n", "  "), *rows[3][2:5], *(f"{name} 70" for name in names)))
    rows.append((71, None, None, None, None, *([None] * len(names))))
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, schema).repartition(3)
    labels = spark.createDataFrame([(k, 1, int(k >= 40)) for k in range(60)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    want = {r[0]: r[5:] for r in rows}
    counts = []
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        found = docs.collect()
        assert docs.columns == [f.split()[0].strip("`") for f in schema.split(", ")][:5] + names
        assert all(tuple(r)[5:] == want[r.doc_id] for r in found)
        counts.append(len({r.doc_id for r in found}))
        docs = spark.createDataFrame(found, docs.schema)
    assert counts[:3] == [42, 42, 41]
    assert corpus_pipeline.pack_sequences(spark, docs, str(tmp_path)).count() >= len(found)


def test_one_long_text_is_cut_in_one_pass(spark):
    words = [f"word{i}" for i in range(300_000)]
    docs = spark.createDataFrame([(1, " ".join(words), "a"), (2, "short one", "a"), (3, "", "b"), (4, None, "c")], "doc_id long, text string, source string")
    found = mixed_texts(docs, block_words=100).collect()
    taken = Counter(w for r in found if r.doc_id == 1 for w in r.text.split())
    assert len(found) > 1000 and set(taken.values()) <= {1, 2} and set(taken) <= set(words)
    assert {r.doc_id for r in found} <= {1, 2}


def test_pieces_of_a_text():
    text = "\n é a\tb  c\x0b日本 \x85d  "
    pieces = [(0, 2), (1, 1), (2, 3), (0, 6), (5, 1)]
    assert piece_texts(text, pieces, 6) == ["é a", "a", "b  c\x0b日本", text, "\x85d"]


def test_one_splitter_reads_combining_marks():
    assert text_words("हिन्दी CAFÉ café 3x") == {"हिन्दी": 1, "café": 2, "x": 1}
