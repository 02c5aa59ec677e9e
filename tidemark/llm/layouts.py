"""Labelled page layouts to learn from: sections of known kind in the markup that sites use for them."""

from __future__ import annotations

import random
from collections.abc import Iterator

# Section kinds, each with openings as tag and attributes.
SECTIONS = {
    "menu": ("nav", 'div class="nav"', 'div id="menu"', 'ul class="navbar-nav"', 'div role="navigation"', 'div class="breadcrumbs"'),
    "head": ("header", 'div id="header"', 'div class="site-header"', 'div class="masthead"', 'div role="banner"'),
    "foot": ("footer", 'div id="footer"', 'div class="site-footer"', 'div class="copyright"', 'section class="footer-links"'),
    "side": ("aside", 'div id="sidebar"', 'div class="widget related"', 'section class="sidebar"', 'div class="recommended-posts"'),
    "notice": ('div class="cookie-notice"', 'div id="gdpr-consent"', 'div class="alert"', 'section class="newsletter-popup"', 'div role="alert"', 'div class="notice"'),
    "advert": ('div class="ad"', 'div class="advert"', 'div id="ad-top"', 'section class="sponsored"', 'aside class="ads"', 'div class="promo-box"'),
    "form": ("form", 'form class="search"', 'form id="login"', 'div class="contact-form"', "form method=post"),
    "comments": ('div class="comments"', 'section id="comments"', 'ol class="commentlist"', 'div id="disqus_thread"', 'section class="discussion"'),
}
ARTICLE = ("article", "main", 'div class="content"', 'div id="main"', 'div class="post-body"', 'div class="entry-content"', 'section class="story"', "div", 'main id="content"', 'div itemprop="articleBody"')
_SYLLABLES = "ba ce di fo gu la me ni po ru sa te vi xo zu an er on is ta".split()


def _word(rng: random.Random) -> str:
    return "".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4)))


def _words(rng: random.Random, low: int, high: int, marks: bool = True) -> str:
    out = [_word(rng) + (rng.choice((",", ".", ".")) if marks and rng.random() < 0.15 else "") for _ in range(rng.randint(low, high))]
    return " ".join(out).capitalize()


def _wrap(opening: str, body: str) -> str:
    return f"<{opening}>{body}</{opening.split()[0]}>"


def _links(rng: random.Random) -> str:
    items = [f'<a href="/{_word(rng)}">{_words(rng, 1, 3, False)}</a>' for _ in range(rng.randint(2, 9))]
    return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if rng.random() < 0.6 else " | ".join(items)


def _other(rng: random.Random, kind: str) -> str:
    opening = rng.choice(SECTIONS[kind])
    if kind == "menu":
        body = _links(rng)
    elif kind == "form":
        body = f"<label>{_words(rng, 1, 3)}</label><input name=q><p>{_words(rng, 2, 12)}</p><button>{_word(rng)}</button>"
    elif kind == "comments":
        item = "li" if opening.startswith("ol") else rng.choice(("div", 'div class="comment"', "article", "p"))
        body = "".join(_wrap(item, f"<p>{_words(rng, 4, 45)}</p>" if item != "p" else _words(rng, 4, 45)) for _ in range(rng.randint(1, 5)))
    elif kind == "side":
        body = f"<h3>{_words(rng, 1, 4, False)}</h3>" + (_links(rng) if rng.random() < 0.7 else f"<p>{_words(rng, 6, 40)}</p>")
    elif kind == "head":
        body = rng.choice((f"<h1>{_words(rng, 1, 3, False)}</h1>", f"<p>{_words(rng, 1, 6)}</p>", _words(rng, 1, 4))) + (_links(rng) if rng.random() < 0.4 else "")
    elif kind == "foot":
        body = rng.choice(("", "&copy; ")) + _words(rng, 3, 20) + (_links(rng) if rng.random() < 0.3 else "")
    else:
        body = rng.choice((f"<p>{_words(rng, 3, 30)}</p>", _words(rng, 3, 30)))
    return _wrap(opening, body)


#: Invisible, in every block of article text and nowhere else; no feature tells it from a letter.
MARK = "\u2060"


def labelled_layouts(count: int, seed: int = 5) -> Iterator[str]:
    """``count`` pages whose article blocks hold ``MARK``."""
    rng = random.Random(seed)
    for _ in range(count):
        say = lambda low, high: MARK + _words(rng, low, high)
        blocks = [f"<h1>{say(2, 10)}</h1>"] if rng.random() < 0.8 else []
        for _ in range(rng.randint(1, 9)):
            style = rng.random()
            if style < 0.7:
                blocks.append(f"<p>{say(3, 110)}" + rng.choice(("</p>", "</p>", "<br>", "")))
            elif style < 0.8:
                blocks.append(f"<h2>{say(1, 7)}</h2>")
            elif style < 0.9:
                blocks.append("<ul>" + "".join(f"<li>{say(2, 25)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
            else:
                blocks.append(_wrap(rng.choice(("blockquote", "div", "pre")), say(4, 40)))
        inner = [_other(rng, rng.choice(("advert", "notice", "side", "comments", "form"))) for _ in range(rng.choice((0, 0, 1, 2)))]
        for part in inner:
            blocks.insert(rng.randint(0, len(blocks)), part)
        article = "".join(blocks) if rng.random() < 0.08 else _wrap(rng.choice(ARTICLE), "".join(blocks))
        if rng.random() < 0.3:
            article = _wrap(rng.choice(("div", 'div class="wrapper"', 'div id="page"', "main")), article)
        busy = rng.choice((0.0, 0.2, 0.5, 0.8))
        before = [_other(rng, k) for k in ("head", "menu", "notice", "advert", "form") if rng.random() < busy]
        after = [_other(rng, k) for k in ("side", "comments", "advert", "menu", "foot", "form", "foot") if rng.random() < busy]
        if rng.random() < 0.2:  # a column beside the article, both in one block
            article = _wrap(rng.choice(("div", 'div class="row"', "section")), article + after.pop() if after else article)
        page = "".join(before) + article + "".join(after)
        yield rng.choice(("<html><body>{}</body></html>", "<body>{}", "{}")).format(page)
