"""Periodic runs against a plain search, and their query against plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from rowloom.llm.periods import looped, periodic_runs, run_digest, runs_of, windows


def plain_runs(words, least, periods):
    """Maximal stretches of each period, but for those with a smaller one."""
    n, out = len(words), []
    for q in range(1, n // periods + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            stretch = words[at : at + length]
            smaller = any(all(stretch[k] == stretch[k + r] for k in range(length - r)) for r in range(1, q))
            if end > at and length >= max(least, periods * q) and not smaller:
                out.append((at, length, q))
            at = max(end, at + 1)
    return sorted(out)


def drawn_words(draw):
    words = draw.integers(0, draw.choice([1, 2, 3, 5, 40]), draw.integers(0, 110)).tolist()
    if words and draw.random() < 0.7:
        a = int(draw.integers(len(words)))
        p = int(draw.integers(1, max(2, (len(words) - a) // 3 + 1)))
        for i in range(a, int(draw.integers(a, len(words) + 1))):
            words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("least, periods", [(24, 3), (6, 3), (4, 2), (2, 2), (12, 4)])
def test_runs_against_a_plain_search(least, periods):
    draw = np.random.default_rng(least)
    for _ in range(250):
        words = drawn_words(draw)
        want = plain_runs(words, least, periods)
        assert runs_of(words, least, periods) == want
        # The stretches that are searched hold all runs of all texts beside each other.
        codes, n = np.array([*words, *words[::-1], *words]), len(words)
        ends, found = np.array([0, n, 2 * n, 3 * n]), [[], [], []]
        for mine, low, high in windows(codes, ends, least, periods):
            found[mine] += [(int(low + s - ends[mine]), k, p) for s, k, p in runs_of(codes[low:high].tolist(), least, periods)]
        assert [sorted(f) for f in found] == [want, plain_runs(words[::-1], least, periods), want]


def test_long_runs_cost_little():
    n = 60_000
    assert runs_of([0] * n) == [(0, n, 1)]
    assert runs_of([i % 7000 for i in range(n)]) == [(0, n, 7000)]


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words, 24, 3)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    row = (doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None)
    return (*row, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query_against_plain_python(spark):
    draw = np.random.default_rng(8)
    rows = []
    for k in range(120):
        text = " ".join(f"w{i}" for i in draw.integers(0, 500, draw.integers(0, 130)))
        if k % 4 == 0:
            text = f"start {'again and  again\t' * (k // 4)}\n{text} " + "é x y\x0b" * (k % 9 * 3)
        rows.append((k, text))
    rows += [(None, None), (None, "a " * 40), (5, "a b " * 30), (5, "a b " * 30), (7, ""), (8, " \n "), (-3, "x y " * 30)]
    rows.append((500, "z " * 30 + " ".join(f"u{i}" for i in range(30_000)) + " z" * 24))
    assert sum(zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in rows if k is not None) > 5
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id long, text string, runs string, n_runs int, start string")
    found = sorted((tuple(r) for r in run_digest(periodic_runs(looped(docs.repartition(3)))).collect()), key=repr)
    assert found[0][1] is not None
    short = sorted((plain_row(*r) for r in rows if r[0] != 500), key=repr)
    assert [r for r in found if r[0] != 500] == short
    (long,) = (r for r in found if r[0] == 500)
    assert long[1:6] == (2, 0, 30, 1, 30_000)
    raw = periodic_runs(docs.where("doc_id = 500")).collect()[0]
    assert [tuple(r) for r in raw.runs] == [(0, 30, 1), (30_030, 24, 1)] and raw.collapsed.endswith(" u29999 z")


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert run_digest(periodic_runs(looped(docs))).collect() == []
