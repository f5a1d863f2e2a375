import itertools
import random

import numpy as np
import pytest

from strata.llm import htmlcrf as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><div class="ad">Buy this now, it is cheap.</div>
<article><h1>A   title&amp;&nbsp;more</h1><p><b>First <i>para</i>graph<br>goes on with enough words to read well.
<p>Second &eacute; &#233; &nosuch; paragraph, also of a good length.</p><!-- <p>comment</p> -->
<div class="comments"><p>I liked this article a lot, thanks for it.</p></div></article>
<footer>&copy; site</footer></body></html>"""


@pytest.fixture(scope="module")
def model():
    rng = random.Random(3)
    words = "river stone morning quiet garden letter window of the a to and in was that".split()

    def line(n):
        return " ".join(rng.choices(words, k=n)).capitalize() + "."

    pages = []
    for _ in range(60):
        body = "".join(f"<p>{line(rng.randint(3, 60))}</p>" for _ in range(rng.randint(1, 9)))
        menu = "".join(f'<li><a href="/x">{w}</a></li>' for w in rng.choices(words, k=5))
        pages.append(f'<html><head><title>x</title></head><body><nav><ul>{menu}</ul></nav><div class="ad">{line(8)}</div>'
                     f"<article><h1>{line(6)}</h1>{body}</article><footer>&copy; {line(5)}</footer></body></html>")
    return H.fit(H.labelled_pages(pages))


def test_blocks():
    got = [b.text for b in H.blocks(PAGE, H.Paths())]
    assert got == ["Home", "News", "Buy this now, it is cheap.", "A title& more",
                   "First paragraph goes on with enough words to read well.",
                   "Second é é &nosuch; paragraph, also of a good length.", "I liked this article a lot, thanks for it.",
                   "© site"]


@pytest.mark.parametrize("page", ["", "plain", "<p", "<p>a<p>b</div></p>", "</p></ul>x", "<script>a", "<!-- a", "<ul><li>a<li>b",
                                  "<table><tr><td>a<td>b<tr><td>c</table>", "<a href='x>y\">z</a>", "<" * 2000,
                                  "<div>" * 3000 + "x", '<p class="' + "a" * 100_000, "&" * 1000, "<svg><p>a</p></svg>b"])
def test_odd_pages(model, page):
    assert isinstance(H.Extractor(model).text(page), str)
    want = {"plain": ["plain"], "<p>a<p>b</div></p>": ["a", "b"], "<ul><li>a<li>b": ["a", "b"],
            "<table><tr><td>a<td>b<tr><td>c</table>": ["a", "b", "c"], "<script>a": [], "<!-- a": [],
            "<svg><p>a</p></svg>b": ["b"]}
    if page in want:
        assert [b.text for b in H.blocks(page, H.Paths())] == want[page]


def test_extracts_the_article(model):
    assert H.Extractor(model).text(PAGE).split("\n\n") == [
        "A title& more", "First paragraph goes on with enough words to read well.",
        "Second é é &nosuch; paragraph, also of a good length."]


@pytest.mark.parametrize("noise", [
    '<aside class="sidebar"><p>Read more about gardens and rivers.</p></aside>', '<div id="cookie-notice">We use cookies here.</div>',
    '<form><label>Mail</label><input><button>Send</button></form>', '<section id="comments"><p>What a lovely morning it was.</p></section>',
    '<header><p>The daily stone</p></header>', '<div class="menu"><a href="/">Home</a> <a href="/x">Window</a></div>',
    '<div class="footer"><p>All rights of the garden.</p></div>', '<div class="advertisement"><p>A stone for the garden, cheap.</p></div>'])
@pytest.mark.parametrize("where", ["before", "after", "inside"])
def test_other_layouts(model, noise, where):
    text = ["The morning was quiet and the river ran by the garden of stone.", "A letter lay in the window that day, unread."]
    main = "".join(f"<p>{t}</p>" for t in text)
    for open_, close in (("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>")):
        page = {"before": noise + open_ + main + close, "after": open_ + main + close + noise,
                "inside": open_ + main + noise + close}[where]
        assert H.Extractor(model).text(f"<html><body>{page}</body></html>") == "\n\n".join(text)


def test_viterbi_equals_enumeration():
    rng = random.Random(2)
    for _ in range(200):
        m = H.Model({}, tuple(tuple(rng.gauss(0, 1) for _ in "ab") for _ in "ab"), (rng.gauss(0, 1), rng.gauss(0, 1)))
        g = [rng.gauss(0, 1) for _ in range(rng.randint(1, 7))]

        def score(y):
            return m.start[y[0]] + sum(a for a, k in zip(g, y) if k) + sum(m.move[a][b] for a, b in itertools.pairwise(y))

        assert tuple(m.decode(g)) == max(itertools.product((0, 1), repeat=len(g)), key=score)
    assert m.decode([]) == []


def test_fit_follows_the_likelihood():
    chains = [([frozenset({"a"}), frozenset({"b"}), frozenset({"b"})], [0, 1, 1])] * 5 + [([frozenset({"a"})], [0])] * 5
    m = H.fit(chains)
    assert m.weight["b"] > 0 > m.weight["a"] and m.decode([m.weight["a"], m.weight["b"]]) == [0, 1]


def test_edge_rows(spark, model):
    rows = [(1, None, "t"), (2, "", None), (3, PAGE, "t"), (3, PAGE, "t"), (None, PAGE.replace("A   title", "B " * 50_000), None)]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    out, text = H.extract(df, model)
    assert out.columns[:3] == df.columns and text not in df.columns
    got = out.collect()
    assert [r[text] for r in got[:2]] == ["", ""] and got[2][text] == got[3][text] != ""
    assert len(got[4][text]) > 99_000
    assert H.extract(df.limit(0), model)[0].collect() == []


def test_training_without_pages(spark):
    m = H.train(spark.createDataFrame([(None,)], "html string"))
    assert "Second é" in H.Extractor(m).text(PAGE)
    assert H.train(spark.createDataFrame([(PAGE,)] * 3, "html string")) == H.train(
        spark.createDataFrame([(PAGE,)] * 3, "html string"))
    assert np.isfinite(list(m.weight.values())).all()


@pytest.mark.parametrize("page, want", [
    ('<p>a <svg class="icon"/> b</p><p>c</p>', ["a b", "c"]), ("<p>a <svg hidden/>b", ["a b"]),
    ("<p>a <svg class=icon/>x</svg>b</p>c", ["a b", "c"]), ("<p>a <svg><text>x</text></svg> b</p>", ["a b"]),
    ("<p>a <noscript><p>x<div>y</div></noscript> b</p>", ["a b"]), ("<p>a <object><svg>x</svg>y</object> b", ["a b"]),
    ("<div><p>a <svg>x</p>b</div>c", ["a", "b", "c"]), ("<p>a <map>x", ["a"]), ("<p>a</svg> b</p>", ["a b"])])
def test_silent_elements_are_inline(page, want):
    paths = H.Paths()
    got = H.blocks(page, paths)
    assert [b.text for b in got] == want
    assert all("a:svg" not in paths.features[b.path] for b in got)


def texts(page):
    return [b.text for b in H.blocks(page, H.Paths())]


@pytest.mark.parametrize("page, want", [
    ("<p>a<!-->b</p><!-- x -->c", ["ab", "c"]), ("<p>a<!--->b", ["ab"]), ("<p>a<!-- x --!>b<p>c", ["ab", "c"]),
    ("<p>a<!-- x > y", ["a"]), ("<p>a<!-- x y", ["a"]), ("<p>a</p>b <!-- x", ["a", "b"]), ("<p>a<!----->b", ["ab"]),
    ("<p>a <select><option>x<option>y</select>b</p>", ["a b"]), ("<p>a<button>x</button>b", ["ab"]),
    ("<div><p>a<select><option>x</p></div><p>b", ["a", "b"]), ("<p>1 < 2", ["1 < 2"]), ("<p>a<b", ["a<b"])])
def test_comment_ends_and_form_controls(page, want):
    assert texts(page) == want


@pytest.mark.parametrize("page", ["<a b=" * 200_000, "</li>" * 200_000, "<ul>" * 8_000 + "</li>" * 100_000,
                                  "<ul><li>" + "<div>" * 8_000 + "<li>x" * 50_000, "<p '" * 200_000, "<!" * 400_000,
                                  "<select>" * 100_000 + "</p>" * 100_000, "<div>" * 200_000 + "x"])
def test_unclosed_tags_take_linear_time(page):
    import time

    t = time.perf_counter()
    texts(page)
    assert time.perf_counter() - t < 5


def test_a_repeated_page_fills_no_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(H, "labelled_pages", lambda pages, **k: seen.append(pages))
    monkeypatch.setattr(H, "fit", lambda chains: None)
    pages = [(f"<article><p>page {i}</p></article>",) for i in range(30)] + [("<article><p>hot</p></article>",)] * 500
    H.train(spark.createDataFrame(pages, "html string"), sample_pages=20)
    assert len(seen[0]) == len(set(seen[0])) == 20
