"""Main text: parsing rules, consistent decoding, held-out layouts, odd pages."""

import numpy as np
import pytest

from tidemark.llm import html_extract as he
from tidemark.llm.boosting import fit_trees
from tidemark.llm.dom import parse
from tidemark.llm.layouts import labelled_layouts

SCHEMA = "page_id long, url string, html string, text string"


@pytest.fixture(scope="module")
def model():
    examples = []
    for html in labelled_layouts(150):
        page = he.describe(parse(html))
        examples.append((page, he.layout_labels(page)))
    return he.fit(examples)


def blocks(html):
    out = []

    def walk(node):
        out.append((node.tag, node.texts()))
        for child in node.children:
            walk(child)

    walk(parse(html))
    return [b for b in out if b[1]]


def test_parser():
    assert blocks("<p>a <b>b<br>c<p>d&amp;&eacute;&nbsp;x</p>tail") == [("html", ["tail"]), ("p", ["a b c"]), ("p", ["d&é x"])]
    assert blocks("<ul><li>a<li>b<ul><li>c</ul></ul>") == [("li", ["a"]), ("li", ["b"]), ("li", ["c"])]
    assert blocks('<script>var t="</p>";</script><style>p{}</style><!-- x --><p>y</p><title>z</title>') == [("p", ["y"])]
    assert blocks("<div>a<p>b</p>c</div>") == [("div", ["a", "c"]), ("p", ["b"])]
    assert blocks("<p>1 < 2 and</p><p>cut <a hre") == [("p", ["1 < 2 and"]), ("p", ["cut"])]
    assert blocks("<table><tr><td>a<td>b<tr><td>c</table>") == [("td", ["a"]), ("td", ["b"]), ("td", ["c"])]
    assert blocks("<div hidden>x</div><p style='display: none'>y</p></p></div><p>z") == [("p", ["z"])]


def test_held_out_layouts(model):
    right = total = 0
    for html in labelled_layouts(100, seed=77):
        page = he.describe(parse(html))
        label, keep = he.layout_labels(page), model.keep(page)
        for i in np.flatnonzero((page.own > 0) & (label < 2)):
            total += 1
            right += keep[i] == label[i]
    assert right / total > 0.98


def test_decoding_never_contradicts(model):
    """Below a block that is all article or all other, every block is so too."""
    rng = np.random.default_rng(0)
    for html in labelled_layouts(30, seed=3):
        page = he.describe(parse(html))
        pure, article = rng.normal(0, 3, (2, len(page.nodes)))
        keep = model._decode(page, pure, article)

        def value(i, state):  # brute force over consistent labellings
            soft = lambda m: -np.logaddexp(0, -m)
            below = [j for j in range(len(page.nodes)) if page.parent[j] == i]
            own = {1: soft(pure[i]) + soft(article[i]), -1: soft(pure[i]) + soft(-article[i])}
            if state:
                return own[state] + sum(value(j, state) for j in below)
            options = [value(i, 1), value(i, -1)]
            if below:
                options.append(soft(-pure[i]) + (soft(abs(article[i])) if page.own[i] else 0) + sum(value(j, 0) for j in below))
            return max(options)

        whole = {1: value(0, 1), -1: value(0, -1)}
        best = value(0, 0)
        if best == whole[1]:
            assert keep.all()
        elif best == whole[-1]:
            assert not keep.any()


def test_articles(frame, model):
    text = "Some words of the story, told at length. " * 6
    pages = [
        (1, "<nav><a href=x>Home</a></nav><article><h1>Title of it</h1><p>" + text + "</p><p>Second  one\n here, also told at some length.</p>"
            "<div class='comments'><p>I like it.</p></div></article><footer>&copy; us</footer>"),
        (2, None), (3, ""), (4, "<html>"), (5, "<nav><ul><li><a href=x>Home</a></li></ul></nav>"),
        (6, "<article>" + "<p>" + text * 400 + "</p>" * 3 + "</article>"),
    ]
    rows = [(i, "u", h, "clash") for i, h in pages] + [(4, None, "<html>", "x")]
    out = he.extract(frame(rows, SCHEMA), model).collect()
    assert len(out) == len(rows)
    found = {r.page_id: r.text for r in out}
    assert found[1] == "Title of it\n" + text.strip() + "\nSecond one here, also told at some length."
    assert [found[i] for i in (2, 3, 4, 5)] == [""] * 4
    assert found[6] == (text * 400).strip()
    assert all(r.n_chars == len(r.text) for r in out)


def test_training_from_pages_and_empty_tables(spark, frame):
    assert he.extract(frame([], SCHEMA)).count() == 0
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = he.extract(pages).join(pages.select("page_id", "html"), "page_id").collect()
    for r in rows:
        assert "track(" not in r.text and "<" not in r.text
        assert r.text.startswith(blocks(r.html[r.html.index("<article>") :])[0][1][0][:40])


def test_trees_separate_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = fit_trees(x[:600], y[:600], depth=3)
    assert ((trees.margin(x[600:]) > 0) == y[600:]).mean() > 0.93
    assert fit_trees(x[:0], y[:0]).margin(x[:3]).tolist() == [fit_trees(x[:0], y[:0]).start] * 3
