"""Main text of web pages: boosted trees on block features, decoded along the page's tree.

Each block of a page gets two log odds: whether its text is all of one kind,
and whether that kind is the article.  Decoding chooses for every block "all
article", "all other" or "mixed" by dynamic programming from the leaves up, so
what an ancestor and a descendant are called never contradicts.  The trees learn
from labelled layouts and from blocks whose markup states their kind.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.boosting import Trees, fit_trees
from tidemark.llm.dom import Node, parse
from tidemark.llm.layouts import MARK, labelled_layouts
from tidemark.llm.storage import slices

# Attribute tokens by what they tell.
TOKENS = {
    "navigation": "nav navigation navbar menu menubar breadcrumb breadcrumbs pagination pager toc tabs skip sitemap links",
    "header": "header masthead topbar banner head branding logo",
    "footer": "footer foot copyright colophon legal contentinfo bottom",
    "side": "sidebar side aside rail widget related recommended trending popular complementary more teaser",
    "notice": "notice cookie cookies consent gdpr alert modal popup overlay toast warning message subscribe newsletter paywall",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner dfp adsense",
    "form": "form search searchbox login signup signin register contact subscribe input",
    "comments": "comment comments commentlist respond reply replies discussion disqus reviews",
    "share": "share sharing social follow tweet facebook tools tags meta byline author",
    "article": "article content main post entry story body text articlebody maintext prose page blog",
}
_KIND = {word: k for k, words in enumerate(TOKENS.values()) for word in words.split()}
_TAGS = (
    ("p",), ("h1",), ("h2", "h3", "h4", "h5", "h6"), ("li", "dt", "dd"), ("ul", "ol", "dl", "menu"), ("div",), ("section",),
    ("article",), ("main",), ("nav",), ("header", "hgroup"), ("footer",), ("aside",), ("form", "fieldset", "search", "dialog"),
    ("table", "thead", "tbody", "tr", "td", "th"), ("blockquote", "pre", "figure", "figcaption"), ("html", "body"),
)
_TAG = {tag: k for k, tags in enumerate(_TAGS) for tag in tags}
_N_TAGS, _N_KINDS = len(_TAGS) + 1, len(TOKENS)
WIDTH = 3 * _N_TAGS + 2 * _N_KINDS + 17


@dataclass
class Page:
    """Blocks of a page, parents before children, with a feature row each."""

    nodes: list[Node]
    parent: np.ndarray
    features: np.ndarray
    own: np.ndarray


def describe(root: Node) -> Page:
    """Features per block: tag, attribute tokens (own and above), depth, siblings, and densities of its subtree."""
    nodes, parents, depth = [root], [-1], [0]
    for i, node in enumerate(nodes):  # grows while it runs
        for child in node.children:
            nodes.append(child)
            parents.append(i)
            depth.append(depth[i] + 1)
    n = len(nodes)
    parent = np.asarray(parents)
    tag = np.asarray([_TAG.get(x.tag, _N_TAGS - 1) for x in nodes])
    texts = [" ".join(x.texts()) for x in nodes]
    own = np.asarray([len(t) for t in texts], float)
    words = np.asarray([t.count(" ") + 1 if t else 0 for t in texts], float)
    stops = np.asarray([sum(map(t.count, ".,;:!?")) for t in texts], float)
    digits = np.asarray([sum(map(str.isdigit, t)) if len(t) < 400 else 0 for t in texts], float)
    links = np.asarray([x.links for x in nodes], float)
    inline = np.asarray([x.inline for x in nodes], float)
    controls = np.asarray([x.controls for x in nodes], float)
    kinds = np.zeros((n, _N_KINDS))
    for i, x in enumerate(nodes):
        for token in x.tokens:
            if token in _KIND:
                kinds[i, _KIND[token]] = 1
    above_tags, above_kinds = np.zeros((n, _N_TAGS)), np.zeros((n, _N_KINDS))
    number, same, siblings = np.zeros(n), np.zeros(n), np.ones(n)
    for i in range(n):
        p = parents[i]
        if p >= 0:
            above_tags[i] = above_tags[p]
            above_tags[i, tag[p]] = 1
            above_kinds[i] = np.maximum(above_kinds[p], kinds[p])
    for i, x in enumerate(nodes):
        if x.children:
            names = [c.tag for c in x.children]
            first = np.searchsorted(parent, i)  # children of one block are neighbours
            at = np.arange(first, first + len(names))
            number[at], siblings[at] = np.arange(len(names)), len(names)
            counts = {name: names.count(name) for name in set(names)}
            same[at] = [counts[name] / len(names) for name in names]
    total = np.stack((own, words, stops, links, inline, controls, np.ones(n), (tag == 0) * own), 1)
    for i in range(n - 1, 0, -1):
        total[parents[i]] += total[i]
    sub, sub_words, sub_stops, sub_links, sub_inline, sub_controls, sub_nodes, sub_p = total.T
    whole = max(sub[0], 1.0)
    depths = np.asarray(depth, float)
    above = np.maximum(parent, 0)
    columns = [
        depths, number, siblings, same, number / np.maximum(siblings - 1, 1), np.log1p(own), np.log1p(sub), sub / whole,
        sub_links / np.maximum(sub, 1), sub_stops / np.maximum(sub_words, 1), sub / sub_nodes, sub_inline / np.maximum(sub_words, 1),
        sub_controls, sub_p / np.maximum(sub, 1), sub / np.maximum(sub[above], 1), digits / np.maximum(own, 1), sub_words / sub_nodes,
    ]
    one = np.eye(_N_TAGS)[tag]
    features = np.concatenate((one, one[above] * (parent >= 0)[:, None], above_tags, kinds, above_kinds, np.stack(columns, 1)), 1)
    return Page(nodes, parent, features, own)


@dataclass
class Extractor:
    """Fitted trees: ``pure`` for all of one kind against mixed, ``article`` for the kind."""

    pure: Trees
    article: Trees

    def keep(self, page: Page) -> np.ndarray:
        """Per block whether its own text is article text."""
        return self._decode(page, self.pure.margin(page.features), self.article.margin(page.features))

    @staticmethod
    def _decode(page: Page, pure: np.ndarray, article: np.ndarray) -> np.ndarray:
        """The best consistent labelling of the tree, given the log odds of each block."""
        soft = lambda m: -np.logaddexp(0, -m)  # noqa: E731  (log of the logistic function)
        n = len(page.nodes)
        all_in, all_out = (soft(pure) + soft(article)).tolist(), (soft(pure) + soft(-article)).tolist()
        # Own text of a mixed block is of the likelier kind.
        mixed = (soft(-pure) + (page.own > 0) * soft(np.abs(article))).tolist()
        article, parent = article.tolist(), page.parent.tolist()
        best = [0.0] * n
        for i in range(n - 1, -1, -1):
            if not page.nodes[i].children:
                mixed[i] = -np.inf
            best[i] = max(all_in[i], all_out[i], mixed[i])
            if i:
                p = parent[i]
                all_in[p] += all_in[i]
                all_out[p] += all_out[i]
                mixed[p] += best[i]
        keep = [False] * n
        state = [0] * n  # 1 all in, -1 all out, 0 open
        for i in range(n):
            p = parent[i]
            above = state[p] if p >= 0 else 0
            state[i] = above or (1 if all_in[i] == best[i] else -1 if all_out[i] == best[i] else 0)
            keep[i] = state[i] == 1 or (state[i] == 0 and article[i] > 0)
        return np.asarray(keep)

    def texts(self, pages: list[str | None], together: int = 200) -> Iterator[str]:
        """Article text of pages; the trees judge the blocks of ``together`` pages at once."""
        for k in range(0, len(pages), together):
            described = [describe(parse(html)) for html in pages[k : k + together]]
            rows = np.concatenate([p.features for p in described])
            pure, article, at = self.pure.margin(rows), self.article.margin(rows), 0
            for page in described:
                n = len(page.nodes)
                yield self._text(page, self._decode(page, pure[at : at + n], article[at : at + n]))
                at += n

    @staticmethod
    def _text(page: Page, kept: np.ndarray) -> str:
        """Article blocks in page order, one per line."""
        keep = dict(zip(map(id, page.nodes), kept.tolist()))
        lines: list[str] = []
        stack: list = [page.nodes[0]]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                lines.append(item)
                continue
            texts = iter(item.texts()) if keep[id(item)] else iter(())
            # Own text stands between child blocks: rebuild the order.
            parts: list = []
            pending = False
            for run in [*item.runs, None]:
                if isinstance(run, str):
                    pending = pending or not run.isspace()
                    continue
                if pending and keep[id(item)]:
                    parts.append(next(texts, ""))
                pending = False
                if run is not None:
                    parts.append(run)
            stack += reversed(parts)
        return "\n".join(line for line in lines if line)


def _seed_label(node: Node) -> int | None:
    """What markup states by itself: 1 article, 0 other, None neither."""
    kinds = {_KIND[t] for t in node.tokens if t in _KIND}
    other = {k for k, name in enumerate(TOKENS) if name not in ("article", "share", "header")}
    if node.tag in ("nav", "footer", "aside", "form", "search", "dialog") or kinds & other:
        return 0
    if node.tag in ("article",):
        return 1
    return None


def seed_labels(page: Page) -> np.ndarray:
    """Labels of blocks: 1 article, 0 other, 2 mixed, -1 not known; the nearest statement above holds."""
    n = len(page.nodes)
    label = np.full(n, -1)
    for i in range(n):
        own, p = _seed_label(page.nodes[i]), page.parent[i]
        above = label[p] if p >= 0 else -1
        label[i] = 0 if above == 0 else own if own is not None else above
    inside = [set() for _ in range(n)]
    for i in range(n - 1, -1, -1):
        if page.own[i] or not page.nodes[i].children:
            inside[i].add(int(label[i]))
        if page.parent[i] >= 0:
            inside[page.parent[i]] |= inside[i]
    return np.asarray([2 if {0, 1} <= s else label[i] for i, s in enumerate(inside)])


def fit(examples: list[tuple[Page, np.ndarray]]) -> Extractor:
    """Fit both sets of trees on pages with labels (1 article, 0 other, 2 mixed, -1 not known) per block."""
    x = np.concatenate([p.features for p, _ in examples]) if examples else np.zeros((0, WIDTH))
    y = np.concatenate([label for _, label in examples]) if examples else np.zeros(0)
    known, pure = y >= 0, (y == 0) | (y == 1)
    return Extractor(fit_trees(x[known], (y[known] != 2).astype(float)), fit_trees(x[pure], y[pure].astype(float)))


def train(pages: DataFrame, *, sample: int = 200, layouts: int = 1200) -> Extractor:
    """Fit on ``layouts`` labelled layouts and at most ``sample`` pages, labelled where their markup states the kind.

    The pages are those with the smallest hash of their id, at every size; null pages are left out.
    """
    rows = pages.select("page_id", "html").where(F.length("html") > 0)
    chosen = rows.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    taken = rows.join(F.broadcast(chosen), "page_id", "left_semi").collect()  # ``sample`` ids
    taken = sorted(taken, key=lambda r: (r["page_id"] is None, r["page_id"], r["html"]))
    examples = []
    for row in taken:
        page = describe(parse(row["html"]))
        examples.append((page, seed_labels(page)))
    for html in labelled_layouts(layouts):
        page = describe(parse(html))
        examples.append((page, layout_labels(page)))
    return fit(examples)


def layout_labels(page: Page) -> np.ndarray:
    """Labels of a layout's blocks from the mark that its article text holds."""
    inside: list[set[int]] = [set() for _ in page.nodes]
    for i in range(len(page.nodes) - 1, -1, -1):
        for text in page.nodes[i].texts():
            inside[i].add(int(MARK in text))
        if page.parent[i] >= 0:
            inside[page.parent[i]] |= inside[i]
    return np.asarray([2 if len(s) == 2 else next(iter(s), -1) for s in inside])


def extract(pages: DataFrame, model: Extractor | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row.

    ``text`` is the article's blocks in page order, white space inside a block as one space, joined by a line break.
    Null and empty pages give empty text.  Repeated rows are answered each; other columns are ignored; an
    empty table gives no rows (the trees then learn from layouts alone).
    """
    source = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    sent = pages.sparkSession.sparkContext.broadcast(model or train(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = list(sent.value.texts(batch.column("html").to_pylist()))
            yield pa.record_batch(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")
