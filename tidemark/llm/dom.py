"""A small block tree of an HTML page: block elements, their own text and attribute tokens."""

from __future__ import annotations

import re
from html.parser import HTMLParser

# HTML element groups.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head title script style noscript template svg math iframe object canvas audio video select datalist".split())
BLOCK = frozenset(
    "html body main article section nav header footer aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot "
    "tr td th caption form fieldset legend blockquote pre figure figcaption address details summary hgroup search menu dialog hr".split()
)
CLOSES_P = BLOCK - frozenset("html body td th tr thead tbody tfoot caption legend summary".split())
# An open element of the key is closed by a start tag of its group, up to the fence.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tbody": (frozenset(["thead", "tbody", "tr", "td", "th"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tr", "td", "th"]), frozenset(["table"])),
}
_CUT_TAG = re.compile(r"<[a-zA-Z/!?][^>]*\Z")
_SPACE = re.compile(r"\s+")


class Node:
    """A block element.  ``runs`` holds its own text and child blocks in page order."""

    __slots__ = ("tag", "tokens", "parent", "children", "runs", "links", "inline", "controls", "_texts")

    def __init__(self, tag: str, tokens: tuple[str, ...], parent: Node | None) -> None:
        self.tag, self.tokens, self.parent = tag, tokens, parent
        self.children: list[Node] = []
        self.runs: list[str | Node] = []
        self._texts: list[str] | None = None
        self.links = self.inline = self.controls = 0  # characters in links, inline elements, form controls

    def texts(self) -> list[str]:
        """Own text between child blocks, white space collapsed, without empty stretches; call when the tree is built."""
        if self._texts is not None:
            return self._texts
        out, now = [], []
        for run in [*self.runs, self]:
            if isinstance(run, str):
                now.append(run)
            elif now:
                text = _SPACE.sub(" ", "".join(now)).strip()
                if text:
                    out.append(text)
                now = []
        self._texts = out
        return out


def _tokens(attrs: list[tuple[str, str | None]]) -> tuple[str, ...]:
    found: list[str] = []
    for name, value in attrs:
        if value and name in ("class", "id", "role", "itemprop", "aria-label", "data-role"):
            for word in re.split(r"[^A-Za-z0-9]+", value):
                found += [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+", word)]
    return tuple(found)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", (), None)
        self.stack: list[tuple[str, Node, bool]] = [("html", self.root, False)]  # tag, block it writes to, hidden
        self.link = 0

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers are not needed

    def _hidden(self) -> bool:
        return self.stack[-1][2]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body") and len(self.stack) == 1:
            if tag == "html":
                return
        if tag in VOID:
            if not self._hidden():
                self._here().inline += 1
                self._here().controls += tag == "input"
                if tag in ("br", "hr"):
                    self._write(" ")
            return
        if tag == "body":
            self._close(lambda t: t == "head", frozenset(["html"]))
        if tag in CLOSES_P:
            self._close(lambda t: t == "p", frozenset("td th table button caption html".split()))
        if tag in IMPLIED:
            group, fence = IMPLIED[tag]
            self._close(group.__contains__, fence)
        names = dict(attrs)
        hidden = self._hidden() or tag in HIDDEN or "hidden" in names or "display:none" in (names.get("style") or "").replace(" ", "").lower()
        block = self._here()
        if tag in BLOCK and not hidden:
            block = Node(tag, _tokens(attrs), block)
            block.parent.children.append(block)
            block.parent.runs.append(block)
        elif not hidden:
            block.inline += 1
            block.controls += tag in ("button", "textarea", "label")
        self.link += tag == "a"
        self.stack.append((tag, block, hidden))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash means nothing on other elements

    def handle_endtag(self, tag: str) -> None:
        if tag == "p" and all(t != "p" for t, *_ in self.stack):
            return
        self._close(lambda t: t == tag, frozenset(["table"]) if tag not in BLOCK else frozenset())

    def _close(self, wanted, fence: frozenset[str]) -> None:
        """Close the nearest open element that is wanted, with all in it, unless a fence stands before it."""
        for k in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[k][0]
            if wanted(tag):
                self.link -= sum(t == "a" for t, *_ in self.stack[k:])
                del self.stack[k:]
                return
            if tag in fence:
                return

    def _here(self) -> Node:
        return self.stack[-1][1]

    def _write(self, text: str) -> None:
        self._here().runs.append(text)

    def handle_data(self, data: str) -> None:
        if not self._hidden():
            self._write(data)
            if self.link > 0:
                self._here().links += len(data.strip())

    def unknown_decl(self, data: str) -> None:
        """A CDATA section outside foreign content is a comment."""


def parse(html: str | None) -> Node:
    """The block tree; an unfinished tag at the end of the page is dropped, unclosed elements end where HTML says."""
    builder = _Builder()
    text = html or ""
    cut = text.rfind("<")
    if cut >= 0 and _CUT_TAG.match(text, cut):
        text = text[:cut]
    builder.feed(text)
    builder.close()
    return builder.root
