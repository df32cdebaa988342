"""Line deduplication, similarity classes, pages and classifiers on small cases."""

from __future__ import annotations

import numpy as np
import pytest

from rowloom.llm import quality, toxicity
from rowloom.llm.components import components
from rowloom.llm.jaccard import link_classes, one_of_each
from rowloom.llm.linededup import deduplicate_lines
from rowloom.llm.pages import blocks, main_texts, unique_runs
from rowloom.llm.samples import labelled_sample

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string"


def docs_of(spark, rows):
    return spark.createDataFrame([(k, t, "en", "s", len(t or ""), "extra") for k, t in rows], DOCS)


def test_later_windows_go_and_covered_lines_merge(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\n\nb\nc\nd\ny"), (3, "a\nb"), (4, None), (5, ""), (6, "q\nq\nq\nq"), (None, "b\nc\nd")]
    found = {r.doc_id: r for r in deduplicate_lines(docs_of(spark, rows)).collect()}
    assert found[1].text == "a\nb\nc\nd" and found[3].text == "a\nb" and found[4].text is None and found[5].text == ""
    assert found[2].text == "x\n\ny" and found[2].n_chars == 4 and found[2].key == "extra"
    assert found[6].text == "q" and found[None].text == ""


def test_copies_without_an_id_and_repeated_rows_are_cut(spark):
    rows = [(None, "a\nb\n\nc\nd", 1), (None, "a\nb\n\nc\nd", 2), (None, "a\nb\n\nc\nd", 3), (7, "k\nl\nm", 4), (7, "k\nl\nm", 4)]
    rows += [(8, "x\ny", 5), (8, "x\ny", 5), (9, None, 6), (9, None, 6), (None, "b\nc\nd\ne", 7), (3, "q\nq\nq\nq", 8), (3, "q\nq\nq\nq", 9)]
    docs = spark.createDataFrame([(k, t, len(t or ""), n) for k, t, n in rows], "doc_id long, text string, n_chars int, `a.b` int")
    found = deduplicate_lines(docs.repartition(3))
    assert found.columns == docs.columns
    out = sorted(((r.doc_id, r.text) for r in found.collect()), key=repr)
    assert all(r.n_chars == len(r.text or "") for r in found.collect())
    # Which of two texts without an id comes first is up to a hash of them.
    longest = [t for k, t in out if k is None]
    assert sorted(longest) in (["", "", "a\nb\n\nc\nd", "e"], ["", "", "a", "b\nc\nd\ne"]) or longest.count("") == 2
    assert [t for k, t in out if k == 7] == ["", "k\nl\nm"] and [t for k, t in out if k == 8] == ["x\ny"] * 2
    assert [t for k, t in out if k == 9] == [None] * 2 and [t for k, t in out if k == 3] == ["", "q"]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 120)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(21)} | {i: 100 for i in range(100, 120)}


def test_links_against_all_pairs(spark):
    draw = np.random.default_rng(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(60):
        words = list(base)
        for at in draw.integers(0, 120, k % 5):
            words[at] = f"e{k}"
        rows.append((k, " ".join(words)))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (200, "a b"), (201, "a  b"), (202, "a c"), (300, ""), (301, None), (None, rows[0][1])]
    sets = [frozenset(zip(*(w[i:] for i in range(5)))) if len(w := (t or "").split()) > 4 else frozenset([tuple(w)] if w else []) for _, t in rows]
    links = [sum(1 for j, b in enumerate(sets) if i != j and a and b and 5 * len(a & b) >= 4 * len(a | b)) for i, a in enumerate(sets)]
    found = link_classes(docs_of(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_links) for r in found) == sorted((str(k), n) for (k, _), n in zip(rows, links))
    classes = {r.doc_id: r.class_id for r in found}
    assert classes[100] == classes[101] == classes[3] and classes[201] == 200 and classes[202] == 202 and classes[300] == 300
    kept = one_of_each(docs_of(spark, rows)).collect()
    assert {r.doc_id for r in kept if r.text} == {r.class_id for r in found} & {k for k, t in rows if t}
    assert sum(not r.text for r in kept) == 2 and all(r.key == "extra" for r in kept)


def test_blocks_of_a_page():
    html = (
        "<head><title>t</title></head><body><nav><ul><li>m</ul></nav><div class='cookie-notice'>c</div><article>"
        "<header><h1>A &amp;lt; B</h1></header><p>one\n two<br>three<!-- x --><script>var a='</p>'</script><p>four"
        "<aside>s</aside><div id=comments><div>r</div></div></article><footer>f</footer> tail"
    )
    assert [text for zone, text in blocks(html) if zone == 0] == ["A &lt; B", "one two three", "four"]
    assert blocks(None) == [] and blocks("") == []


def test_references_are_decoded_within_a_text_and_comments_go():
    html = "<article><p>AT&<b>amp;</b> AT&amp;T &#65;</p><section class='user-comments'>r</section><div class='post-comments'>s</div></article>"
    assert [text for zone, text in blocks(html) if zone == 0] == ["AT&amp; AT&T A"]


def test_names_of_wrappers_and_parts_of_names_hide_no_text():
    def main(html):
        return [text for zone, text in blocks(html) if zone == 0]

    body = "<p class='share-price'>Shares fell</p><p>to <b class='no-ads'>nine</b></p>"
    for start, end in [
        ("<div class='layout has-sidebar'><article>", "</article></div>"),
        ("<article class='post no-comments'>", "</article>"),
        ("<div class='sidebar'><div id=search><article>", "</article></div></div>"),
        ("<main class='search'>", "</main>"),
        ("<form id=f><div hidden><article role=banner>", "</article></div></form>"),
        ("<aside><main>", "</main></aside>"),
        ("<head><title>t</title><article>", "</article>"),
    ]:
        assert main(f"{start}{body}{end}") == ["Shares fell", "to nine"], start
    around = f"<div class=sidebar><nav>menu</nav><article>{body}<div class=cookie_banner>ok</div></article></div>"
    assert main(around) == ["Shares fell", "to nine"]
    # Articles in an article and those of an aside are not the page's text.
    nested = "<article>one<div id=comments><article>reply</article></div></article>"
    teaser = "<aside class=related><article>teaser</article></aside>"
    assert main(nested + teaser) == ["one"]


def test_repeated_runs_go_where_no_article_is_marked(spark):
    menu = "home news sport weather travel culture food music"
    rows = [(k, "http://h.example/a", f"<div>{menu}</div><p>{k}th story is told by number {k} alone here</p>") for k in range(3)]
    rows += [(9, "http://other.example/", f"<p>{menu}</p>"), (10, None, None), (10, None, None)]
    found = main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    texts = {r.page_id: r.text for r in found}
    assert len(found) == 6 and texts[9] == menu and texts[10] == ""
    assert texts[1] == "1th story is told by number 1 alone here"
    assert unique_runs(["a b", "c"], [0], 2) == "c"


@pytest.mark.parametrize("few", [500_000, 0])
def test_blocks_of_articles_that_many_pages_share_go(spark, monkeypatch, few):
    monkeypatch.setattr("rowloom.llm.pages.GONE_BLOCKS", few)
    notice = "All rights are with the makers of these pages, ask first"
    quoted = "to be or not to be that is the question"
    rows = []
    for k in range(12):
        text = f"<p>Story {k} is told here in some words of its own</p><p>Read on</p><p>{notice}</p>"
        rows.append((k, "http://a.org/" + str(k), f"<article>{text}{f'<p>{quoted}</p>' * (k < 9)}</article>"))
    # The same notice on too few pages of another host, and many copies of one page, stay.
    rows += [(20 + k, "http://b.org/", f"<article><p>{notice}</p><p>{k}</p></article>") for k in range(9)]
    rows += [(40, "http://c.org/", f"<article><p>{notice}</p></article>")] * 15
    found = main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.page_id < 12:
            want = [f"Story {r.page_id} is told here in some words of its own", "Read on"] + [quoted] * (r.page_id < 9)
        else:
            want = [notice] + [str(r.page_id - 20)] * (r.page_id < 40)
        assert r.text == "\n".join(want) and r.n_chars == len(r.text)


def test_toxicity_learns_words(spark):
    rows = [(i, f"some plain words {i} about things") for i in range(60)]
    rows += [(100 + i, f"you {'vile ' * (1 + i % 8)}words") for i in range(60)] + [(None, None), (500, "")]
    labels = spark.createDataFrame([(k, 1, int(k >= 100)) for k, _ in rows if k not in (None, 500)], "doc_id long, quality int, toxic int")
    docs = docs_of(spark, rows)
    model = toxicity.fit(docs, labels)
    assert (np.diff(model.thresholds) > 0).all()
    scored = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert scored[107].severity > scored[100].severity > 0.5 > scored[3].severity
    kept = toxicity.reject(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 62
    assert toxicity.reject(docs, labels.limit(0)).count() == len(rows)


def test_quality_scores_whole_texts(spark):
    good = ["plain words of some text " * 8, "other sentence, with marks. " * 8]
    rows = [(i, good[i % 2] + str(i) if i % 3 else "X!! " * (20 + i)) for i in range(150)] + [(900, None), (None, "a")]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(150)], "doc_id long, quality int, toxic int")
    docs = docs_of(spark, rows)
    scored = quality.score(docs, quality.fit(docs, labels, epochs=8)).collect()
    assert len(scored) == 152 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in scored)
    held = [r for r in scored if r.held_out]
    assert held and np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in held]) > 0.9
    net = quality.train([b"a"], np.array([1.0]), 1, 3)
    long = b"ab" * 100_000 + b"!!!!!!"
    assert net.pooled(long).max() == net.pooled(long[:65_536] + long[65_536:]).max()


def test_samples_hold_one_text_of_a_repeated_id(spark, monkeypatch):
    rows = [(7, f"copy {k % 40}") for k in range(300)] + [(k, f"text {k}") for k in range(10, 30)] + [(None, "x"), (8, None), (8, "y")]
    docs = docs_of(spark, rows)
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in [7, 7, 8, *range(10, 30)]], "doc_id long, quality int, toxic int")
    for order in (docs, docs.repartition(5, "text")):
        found = labelled_sample(order, labels, "quality", 100).collect()
        assert sorted(r.doc_id for r in found) == [7, 8, *range(10, 30)]
        assert all((r.doc_id, r.text) in rows or (r.doc_id, r.text) == (8, "") for r in found)
        assert all(r.label == r.doc_id % 2 for r in found)
        kept = {r.doc_id: r.text for r in found}
        assert kept == {r.doc_id: r.text for r in labelled_sample(docs.distinct(), labels, "quality", 100).collect()}
    seen = []
    monkeypatch.setattr(quality, "train", lambda texts, label, epochs, seed: seen.extend(zip(texts, label, strict=True)))
    quality.fit(docs, labels, max_bytes=100)
    assert sum(len(t) for t, _ in seen) <= 100 and sum(t.startswith(b"copy") for t, _ in seen) <= 1
