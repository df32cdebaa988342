"""Tree reduction against the tiktoken library."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from rowloom.llm.bytepairs import BytePairs, TextCoder, decode, encode, token_digest

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    "", " ", "\n", "a", "It's 12 o'clock,  isn't it?\n\nYes... \t no\r\n", "naïve Ünïcode — ½ ² ١٢ 中文字 한국어 हिन्दी", " x y　",
    "tab\tword", "a\n\n\nb", "a\n b", " a", "a ", "line one\nline two,\n\nline (three)", "\x00nul\x1cfs  private ", "<|endoftext|> as text", "''s 're're",
]


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@pytest.fixture(scope="module")
def plain(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("leaf", [1, 2, 16])
def test_joined_halves_are_the_encoding_of_the_whole(ranks, plain, leaf):
    draw, coder, tokens = np.random.default_rng(leaf), BytePairs(ranks, leaf), list(ranks)
    pieces = [b"".join(tokens[i] for i in draw.integers(0, len(tokens), draw.integers(1, 12))) for _ in range(150)]
    pieces += [bytes(draw.integers(97, 103, draw.integers(1, 90)).tolist()) for _ in range(150)]
    pieces += [unit * int(draw.integers(1, 120)) for unit in (b"a", b"=", b"ab", b"\xc3\xa9", b"-", b" ") for _ in range(8)]
    want = [plain._encode_single_piece(p) for p in pieces]
    assert [coder.encode(p) for p in pieces] == want
    assert [np.frombuffer(ids, "<i4").tolist() for ids in coder.encode_many(pieces)] == want
    assert all(coder.decode(ids) == piece for ids, piece in zip(want, pieces, strict=True))


def test_windows_that_grow_to_the_end(ranks, plain):
    """One more letter shifts every merge of a run to the right of it."""
    coder = BytePairs(ranks)
    left, right = coder.encode(b"a" * 3), coder.encode(b"a" * 40)
    assert coder.join(left, right) == plain._encode_single_piece(b"a" * 43)
    assert coder.join([], right) == right and coder.join(left, []) == left


def test_texts_against_the_library(ranks, plain):
    draw = np.random.default_rng(1)
    parts = [" ", "\n", "a", "word", ",", "1", "é", "\t", " ", "\x1c", " b", "'s", "\r", "x y", "ß", "٣"]
    texts = TEXTS + ["".join(draw.choice(parts, draw.integers(0, 10))) for _ in range(1500)]
    ids, ends = TextCoder(BytePairs(ranks), public_tokenizers.PATTERN).encode(pa.array(texts))
    assert [p.tolist() for p in np.split(ids, ends[1:-1])] == [plain.encode_ordinary(t) for t in texts]


def test_query_against_the_library(spark, plain):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "no id"), (None, None), (3, "same id"), (3, "same id")]
    rows.append((99, "long " * 40_000 + "x" * 5000 + " wörter" * 20_000))
    docs = spark.createDataFrame([(k, t, "a", [1]) for k, t in rows], "doc_id long, text string, ids string, decoded array<int>")
    encoded = encode(docs.repartition(3), PATH, public_tokenizers.PATTERN)
    found = sorted((tuple(r) for r in token_digest(decode(encoded, PATH)).collect()), key=repr)
    want = []
    for k, text in rows:
        ids, raw = plain.encode_ordinary(text or ""), (text or "").encode()
        digests = [hashlib.sha256(b).hexdigest() for b in (",".join(map(str, ids)).encode(), raw)]
        want.append((k, len(ids), *digests))
    assert found == sorted(want, key=repr)
    empty = docs.limit(0)
    assert token_digest(decode(encode(empty, PATH, public_tokenizers.PATTERN), PATH)).collect() == []
