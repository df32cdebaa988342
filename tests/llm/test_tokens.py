"""Token ids, packing and wavelet matrices against the tokenizer and plain Python."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from tokenizers import Tokenizer

from rowloom.llm.packing import pack
from rowloom.llm.queries import tokenizer_path
from rowloom.llm.tokens import _STEM_AND_MARKS, WordTokenizer
from rowloom.llm.wavelet import WaveletMatrix, token_store

ROWS = [
    (3, "The cat's hat, don't!  İstanbul ﬁx \x1cx\x85y ªº ẞ 中文 12ab"),
    (1, ""),
    (None, "null id"),
    (2, None),
    (2, "tie"),
    (2, "tie"),
    (9, "word " * 3000),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_give_the_ids_of_whole_texts(plain):
    texts = [text for _, text in ROWS]
    ((_, ids, offsets),) = WordTokenizer(tokenizer_path()).encode(pa.array(texts), 7)
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [plain(t) + [7] for t in texts]


def test_pieces_cover_each_id_once(spark, plain):
    docs = spark.createDataFrame([(*r, "x") for r in ROWS], SCHEMA + ", part string").repartition(3)
    rows = sorted(pack(docs, tokenizer_path(), window=64).collect(), key=lambda r: (r.sequence_id, r.offset))
    at, found = 0, {}
    for r in rows:
        assert r.sequence_id * 64 + r.offset == at
        at += r.length
        assert r.offset + r.length <= 64
        assert len(r.ids) == 4 * r.length
        found.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    assert at == sum(len(plain(t)) + 1 for _, t in ROWS)
    long = sorted(found[9, len(plain(ROWS[-1][1])) + 1])
    assert [i for _, ids in long for i in ids] == plain(ROWS[-1][1]) + [1]


def test_packing_an_empty_table(spark):
    assert pack(spark.createDataFrame([], SCHEMA), tokenizer_path()).collect() == []


def test_wavelet_matrix_against_a_list():
    ids = np.random.default_rng(1).integers(0, 50, 3000).astype(np.uint32)
    built = WaveletMatrix.build(ids)
    matrix = WaveletMatrix.from_bytes(
        built.n, built.levels, built.zeros, built.planes.tobytes(), built.ranks.astype("<u4").tobytes()
    )
    assert matrix.decode().tolist() == ids.tolist()
    assert [matrix.access(i) for i in range(0, 3000, 97)] == ids[::97].tolist()
    for value in (0, 7, 49, 51):
        places = np.flatnonzero(ids == value)
        assert matrix.count(value) == len(places)
        assert matrix.count(value, 1000) == (places < 1000).sum()
        assert [matrix.locate(value, k) for k in range(0, len(places), 13)] == places[::13].tolist()
    assert WaveletMatrix.build(np.zeros(0, np.uint32)).decode().tolist() == []


def test_store_round_trip(spark, plain):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    rows = token_store(docs, tokenizer_path()).collect()
    rows = sorted(rows, key=lambda r: r.start)
    order = sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [r.doc_id for r in rows] == [k for k, _ in order]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in rows] == [plain(t) + [2] for _, t in order]
    assert rows[0].start == 0 and rows[-1].start == sum(len(plain(t)) + 1 for _, t in order[:-1])


def test_all_letters_of_stems_in_both_cases():
    """Stems are lower-cased by Arrow; the tokenizer, and Python, must agree for every letter they may hold."""
    path = tokenizer_path()
    every = pa.array([chr(c) for c in range(0x41, 0x250)])
    letters = every.filter(pc.match_substring_regex(every, _STEM_AND_MARKS)).to_pylist()
    assert len(letters) > 400
    assert pc.utf8_lower(pa.array(letters)).to_pylist() == [letter.lower() for letter in letters]
    words = [*letters, *(a + b for a, b in zip(letters, reversed(letters))), *("Ab" + letter + "er," for letter in letters)]
    plain = Tokenizer.from_file(path)
    ids, offsets = next((ids, offsets) for _, ids, offsets in WordTokenizer(path).encode(pa.array(words)))
    found = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
    assert found == [plain.encode(word, add_special_tokens=False).ids for word in words]


def test_words_that_differ_in_case_are_looked_up_once():
    pieces, pair = WordTokenizer(tokenizer_path())._word_ids(pa.array(["Word", "word", "WORD", "Éa", "éa"]))
    assert len(pieces) == 4  # two stems, no marks, and the empty piece
    assert pair[:, 0].tolist() == [0, 0, 0, 1, 1]
