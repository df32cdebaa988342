"""Models, fingerprints and joins recomputed by plain loops."""

from __future__ import annotations

import numpy as np
import pytest
import xxhash

from rowloom.llm import fingerprints, jaccard, pages, quality, toxicity
from rowloom.llm.fingerprints import BINS, BITS, edited_pairs
from rowloom.llm.topk import integer_vectors, top_k


def test_top_k_of_repeated_ids(spark):
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(size=4).tolist()) for i in range(60)]
    # Other vectors under a query's id, equal rows of a query, and many rows of one id.
    rows += [(0, draw.normal(size=4).tolist()), (0, rows[0][1]), (0, rows[3][1])] + [(7, rows[0][1])] * 9
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = integer_vectors(frame)
    asked = vectors.where("vec_id % 20 = 0")
    found = [tuple(r) for r in top_k(vectors, asked, k=4).collect()]
    whole = [(i, tuple(np.floor(1024 * np.array(v)).astype(int).tolist())) for i, v in rows]
    expected = []
    for query in {row for row in whole if row[0] % 20 == 0}:
        others = list(whole)
        others.remove(query)
        best = sorted((-int(np.dot(query[1], v)), i) for i, v in others)[:4]
        expected += [(query[0], n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert sorted(found) == sorted(expected)


def ordinal_loss(theta, dense, grade, penalty):
    """The mean cumulative logistic loss of a dense table, classes weighted evenly."""
    words = dense.shape[1]
    bounds = [theta[words]]
    for step in theta[words + 1 :]:
        bounds.append(bounds[-1] + np.exp(step))
    loss = 0.0
    for x, g in zip(dense, grade, strict=True):
        weight = 0.5 / (grade > 0).sum() if g > 0 else 0.5 / (grade == 0).sum()
        for k, bound in enumerate(bounds):
            z = x @ theta[:words] - bound
            loss += weight * np.log1p(np.exp(-z if g > k else z))
    return loss + penalty / 2 * (theta[:words] ** 2).sum()


def slopes(theta, *given):
    out = np.zeros_like(theta)
    for i in range(len(theta)):
        move = np.zeros_like(theta)
        move[i] = 1e-5
        out[i] = (ordinal_loss(theta + move, *given) - ordinal_loss(theta - move, *given)) / 2e-5
    return out


def test_ordinal_regression_finds_the_dense_optimum():
    draw = np.random.default_rng(8)
    dense = draw.integers(0, 3, (60, 4)) * 1.0
    grade = np.clip(np.round(dense @ [1.0, 0.5, -0.5, 0.0] + draw.normal(0, 0.8, 60)), 0, 3).astype(int)
    row, at = np.nonzero(dense)
    sparse = (grade, row, at, dense[row, at], 4)
    weights, thresholds = toxicity._descend(*sparse, epochs=4000, penalty=0.01, rate=0.01)
    assert (np.diff(thresholds) > 0).all()
    theta = np.concatenate([weights, thresholds[:1], np.log(np.diff(thresholds))])
    assert np.abs(slopes(theta, dense, grade, 0.01)).max() < 2e-3
    # The first step of the optimizer goes against the sign of each slope.
    start = np.array([0.0] * 4 + [1.0, 0.0, 0.0])
    slope = slopes(start, dense, grade, 0.01)
    weights, thresholds = toxicity._descend(*sparse, epochs=1, penalty=0.01, rate=0.05)
    moved = np.concatenate([weights, thresholds[:1], np.log(np.diff(thresholds))]) - start
    assert (np.abs(slope) > 1e-4).all() and np.allclose(moved, -0.05 * np.sign(slope), atol=1e-4)


def test_severity_is_the_expected_grade(spark):
    index = {"bad": 0, "हिन्दी": 1, "çé": 2}
    model = toxicity.Severity(index, np.array([1.5, -0.5, 2.0]), np.array([1.0, 2.0, 4.0]))
    texts = ["bad BAD bad", "हिन्दी bad.हिन्दी", "ÇÉ çé, other", "", None, "bad_çé1हिन्दी"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = [{0: 3}, {1: 2, 0: 1}, {2: 2}, {}, {}, {0: 1, 1: 1, 2: 1}]
    for r in toxicity.score(docs, model).collect():
        z = sum(model.weights[w] * (1 + np.log(n)) for w, n in counts[r.doc_id].items())
        above = [1 / (1 + np.exp(t - z)) for t in model.thresholds]
        mass = [1 - above[0], above[0] - above[1], above[1] - above[2], above[2]]
        assert np.allclose([r.p1, r.p2, r.p3], above) and r.grade == int(np.argmax(mass))
        assert np.isclose(r.severity, sum(g * p for g, p in enumerate(mass)))


def network(seed: int) -> quality.ByteNetwork:
    draw = np.random.default_rng(seed)
    f, h = quality.FILTERS, quality.HIDDEN
    return quality.ByteNetwork(
        draw.normal(0, 0.5, (quality.WIDTH, 256, f)), draw.normal(size=f), draw.normal(0, 0.3, (3 * f, h)),
        draw.normal(size=h), draw.normal(size=h), 0.2,
    )


def plain_probability(net, data: bytes) -> float:
    """The network written as loops over windows, chunks and filters."""
    data = data + b"\0" * (quality.WIDTH - len(data))
    windows = len(data) - quality.WIDTH + 1
    act = np.array([sum(net.kernel[j][data[i + j]] for j in range(quality.WIDTH)) for i in range(windows)])
    chunks = []
    for low in range(0, windows, quality.CHUNK):
        best = [max(act[low : low + quality.CHUNK, k]) for k in range(quality.FILTERS)]
        chunks.append([max(b + net.bias[k], 0) for k, b in enumerate(best)])
    columns = list(zip(*chunks, strict=True))
    joined = [sum(c) / len(c) for c in columns] + [max(c) for c in columns] + [min(c) for c in columns]
    hidden = np.maximum(np.array(joined) @ net.inner + net.inner_bias, 0)
    return 1 / (1 + np.exp(-(hidden @ net.outer + net.outer_bias)))


@pytest.mark.parametrize("size", [0, 1, 5, 6, 7, 260, 261, 262, 1500])
def test_quality_network_equals_loops(size, monkeypatch):
    monkeypatch.setattr(quality, "SPAN", 2 * quality.CHUNK)
    data = np.random.default_rng(size).integers(0, 256, size, np.uint8).tobytes()
    net = network(1)
    assert np.isclose(net.probability(data), plain_probability(net, data), atol=1e-4)


def test_quality_slopes_equal_differences():
    net, data = network(2), bytes(np.random.default_rng(3).integers(97, 103, 600, np.uint8))
    names = ("kernel", "bias", "inner", "inner_bias", "outer", "outer_bias")
    slope = {n: np.zeros_like(np.asarray(getattr(net, n), float)) for n in names}
    quality._backward(net, net.kernel.astype(np.float32), data, 1.0, 1.0, slope)

    def loss():
        return -np.log(plain_probability(net, data))

    draw = np.random.default_rng(5)
    for name in names[:-1]:
        values = getattr(net, name)
        steep = np.argsort(-np.abs(slope[name]).ravel())[:3]
        for place in {*steep.tolist(), *draw.integers(values.size, size=2).tolist()}:
            at, before = np.unravel_index(place, values.shape), values.ravel()[place]
            values[at] = before + 1e-5
            up = loss()
            values[at] = before - 1e-5
            down = loss()
            values[at] = before
            assert np.isclose((up - down) / 2e-5, slope[name][at], rtol=1e-2, atol=1e-5), (name, at)


def fold(parts: list[bytes]) -> int:
    """The hash of a struct: each field is hashed with the hash before it as seed."""
    found = 42
    for part in parts:
        found = xxhash.xxh64_intdigest(part, seed=found)
    return found


def signed(number: int) -> int:
    return number - (1 << 64) if number >= 1 << 63 else number


def plain_fingerprint(text: str) -> str:
    words = [w for w in text.replace("\x0b", " ").split() if w]
    n = max(len(words) - 4, min(len(words), 1))
    bins: list[int | None] = [None] * BINS
    for low in range(n):
        value = fold([w.encode() for w in words[low : low + 5]])
        place = value >> (64 - (BINS.bit_length() - 1))
        bins[place] = min(signed(value), signed(value) if bins[place] is None else bins[place])
    if n == 0:
        return ""
    out = ""
    for i in range(BINS):
        value = bins[i]
        start = signed(fold([i.to_bytes(4, "little"), (1).to_bytes(4, "little")])) % BINS
        step = signed(fold([i.to_bytes(4, "little"), (2).to_bytes(4, "little")])) % (BINS // 2) * 2 + 1
        attempt = 0
        while value is None:
            value = bins[(start + step * attempt) % BINS]
            attempt += 1
        out += "0123456789abcdef"[value & 15]
    return out


def plain_likeness(one: str, two: str) -> float:
    if one == two:
        return 1.0
    if not one or not two:
        return 0.0
    same = sum(a == b for a, b in zip(one, two, strict=True)) / BINS
    return min(1.0, max(0.0, (same - 2.0**-BITS) / (1 - 2.0**-BITS)))


def test_fingerprints_equal_loops(spark):
    draw = np.random.default_rng(6)
    texts = [" ".join(f"w{w}" for w in draw.integers(0, 90, size)) for size in (1, 4, 5, 6, 20, 150, 900)]
    texts += ["", " \t", "é\x0bü  same words again here", texts[4]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in edited_pairs(docs).collect()}
    assert len(found) == len(texts)
    for k, text in enumerate(texts):
        after = texts[k - 1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, other, edit = plain_fingerprint(text), plain_fingerprint(after), plain_fingerprint(edited)
        assert (found[k].fingerprint, found[k].edited_fingerprint) == (own, edit)
        assert found[k].near_edited == pytest.approx(plain_likeness(own, edit))
        assert found[k].near_next == pytest.approx(plain_likeness(own, other))


@pytest.mark.parametrize("bucket", [128, 6])
def test_links_are_those_of_all_pairs(spark, monkeypatch, bucket):
    monkeypatch.setattr(jaccard, "BUCKET", bucket)
    monkeypatch.setattr(jaccard, "EXACT_BLOCK", 8)
    draw = np.random.default_rng(9)
    texts = []
    for family in range(6):
        base = [f"f{family}w{w}" for w in draw.integers(0, 60, 80)]
        for _ in range(14):
            words = list(base)
            for at in draw.integers(0, 80, int(draw.integers(0, 5))):
                words[at] = f"x{int(draw.integers(1 << 30))}"
            texts.append(" ".join(words))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(76)} for t in texts]
    links = [
        sum(j != i and 5 * len(a & b) >= 4 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)
    ]
    assert sum(links) > 200
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.n_links for r in jaccard.link_classes(docs).collect()}
    # No link is made up, and of those there are, hardly any may be lost to chance.
    assert all(found[k] <= links[k] for k in range(len(texts)))
    assert sum(found.values()) >= 0.995 * sum(links)


def longest_repeats(one: list[str], other: list[str]) -> set[int]:
    """Places of ``one`` that a longest substring common with ``other``, of eight words at least, covers."""
    out: set[int] = set()
    for i in range(len(one)):
        for j in range(len(other)):
            if i and j and one[i - 1] == other[j - 1]:
                continue
            n = 0
            while i + n < len(one) and j + n < len(other) and one[i + n] == other[j + n]:
                n += 1
            if n >= 8:
                out.update(range(i, i + n))
    return out


def test_pages_lose_what_longest_repeated_substrings_cover(spark):
    draw = np.random.default_rng(12)
    shared = [[f"s{k}w{w}" for w in range(size)] for k, size in enumerate((7, 8, 9, 23, 60))]
    rows, words = [], []
    for k in range(24):
        blocks = []
        for _ in range(int(draw.integers(1, 7))):
            if draw.random() < 0.5:
                run = shared[int(draw.integers(len(shared)))]
                low = int(draw.integers(0, 3))
                blocks.append(run[low : len(run) - int(draw.integers(0, 3))])
            else:
                blocks.append([f"p{int(draw.integers(4))}" for _ in range(int(draw.integers(1, 30)))])
        words.append(blocks)
        rows.append((k, f"http://h{k % 2}.org/{k}", "".join(f"<p>{' '.join(b)}</p>" for b in blocks)))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    found = {r.page_id: r.text for r in pages.main_texts(frame).collect()}
    streams = [[w for b in blocks for w in b] for blocks in words]
    changed = 0
    for k, blocks in enumerate(words):
        others = [streams[j] for j in range(len(rows)) if j % 2 == k % 2 and words[j] != blocks]
        gone = set().union(*(longest_repeats(streams[k], other) for other in others))
        at, want = 0, []
        for block in blocks:
            left = [w for i, w in enumerate(block, at) if i not in gone]
            at += len(block)
            want += [" ".join(left)] * bool(left)
        changed += bool(gone)
        assert found[k] == "\n".join(want)
    assert changed > 12


def test_blocks_of_articles_go_alike_on_hosts_of_every_size(spark):
    notice = "all rights are with the makers of these pages"
    texts = {}
    for size in (10, 1200):
        rows = [(k, "http://a.org/", f"<article><p>story {k}</p>{f'<p>{notice}</p>' * (k < 10)}</article>") for k in range(size)]
        found = pages.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
        texts[size] = {r.page_id: r.text for r in found}
    assert all(texts[size][k] == f"story {k}" for size in texts for k in range(size))


def test_formulas_and_drawn_words_of_articles_stay():
    html = "<article><p>where <math><mi>x</mi><annotation>\\x</annotation></math> is <svg><text>five</text><desc>d</desc></svg></p></article>"
    assert pages.blocks(html) == [(pages.MAIN, "where x is five")]
