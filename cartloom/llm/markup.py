"""Text blocks of one HTML page, with the kind of container that holds them.

A small helper of ``extraction``: one pass over the marks of a page, no tree. Malformed pages are read as they
come: unclosed elements end with their container, stray end tags are ignored, a ``<`` that starts no mark is text.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

# Elements and names of HTML, and names that templates commonly give to parts of a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
DROPPED = RAW | set("head nav footer aside form noscript template svg math canvas object audio video button select dialog menu".split())
SECTIONS = set("article main nav aside header footer section form head body html table".split())
BLOCKS = SECTIONS | set(
    "address blockquote caption center dd details dir div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr legend li "
    "ol optgroup option p pre search summary tbody td tfoot th thead tr ul".split()
)
DROPPED_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog menu menubar toolbar form".split())
BOILERPLATE = set(
    "ad ads adsbygoogle advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification "
    "overlay pager pagination popup promo promotion recommended related replies respond search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe subscription teaser toolbar topbar widget widgets".split()
)
STATES = set("has with no without is body page layout".split())  # such a name says what a wrapper has, not what it is
CONTENT = set(
    "article article-body article-content article-text articlebody content content-body entry entry-content main main-content "
    "maincontent page-content post post-body post-content post-text story story-body".split()
)

NEUTRAL, NAMED, MAIN, ARTICLE = range(4)  # kinds of containers, weakest first

_MARK = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+)(?:>|\Z)"
    r"|</[^>]*+(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


def _is_boilerplate(name: str) -> bool:
    parts = re.split(r"[-_]+", name)
    return name not in CONTENT and parts[0] not in STATES and not {parts[0], parts[-1]}.isdisjoint(BOILERPLATE)


def _kind(tag: str, attributes: str) -> tuple[bool, int]:
    """Whether an element is dropped, and its kind of container."""
    kind = {"article": ARTICLE, "main": MAIN}.get(tag, NEUTRAL)
    if "=" not in attributes and "hidden" not in attributes.lower():
        return tag in DROPPED, kind
    given = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
    roles = given.get("role", "").lower().split()
    names = f"{given.get('class', '')} {given.get('id', '')}".lower().split()
    dropped = (
        tag in DROPPED or "hidden" in given or given.get("aria-hidden", "").lower() == "true" or not DROPPED_ROLES.isdisjoint(roles)
        or bool(_HIDDEN.search(given.get("style", "")))
    )
    if tag not in ("html", "body", "main"):
        dropped = dropped or any(map(_is_boilerplate, names))
    if "article" in roles or "articlebody" in given.get("itemprop", "").lower():
        kind = ARTICLE
    elif "main" in roles:
        kind = max(kind, MAIN)
    elif tag not in ("html", "body") and not CONTENT.isdisjoint(names):
        kind = max(kind, NAMED)
    return dropped, kind


class _Page:
    """The open elements of a page: name, whether its text is dropped, the strongest kind around it."""

    def __init__(self) -> None:
        self.open: list[tuple[str, bool, int]] = []
        self.counts: Counter[str] = Counter()

    @property
    def top(self) -> tuple[str, bool, int]:
        return self.open[-1] if self.open else ("", False, NEUTRAL)

    def pop(self) -> None:
        self.counts[self.open.pop()[0]] -= 1

    def start(self, tag: str, attributes: str) -> None:
        if tag == "body":
            while self.counts["head"]:
                self.pop()
        if tag in ("article", "main"):  # nobody puts these into a menu: its end is missing
            while self.counts["nav"]:
                self.pop()
        if tag in BLOCKS and self.top[0] == "p" or tag == self.top[0] and tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            self.pop()
        if tag in VOID:
            return
        dropped, kind = _kind(tag, attributes)
        _, outer_dropped, outer_kind = self.top
        if tag == "article" and outer_kind == ARTICLE:  # an article within an article is a reader's comment or a teaser
            dropped = True
        if tag == "header" and outer_kind < MAIN:  # an article's own header has its title
            dropped = True
        if dropped or outer_dropped or kind or tag in SECTIONS or tag == "div" or self.counts[tag]:
            self.open.append((tag, dropped or outer_dropped, max(kind, outer_kind)))
            self.counts[tag] += 1

    def end(self, tag: str) -> None:
        if not self.counts[tag]:
            return
        if tag not in SECTIONS:  # does not end the sections around it
            for name, _, _ in reversed(self.open):
                if name == tag:
                    break
                if name in SECTIONS:
                    return
        while self.open:
            name = self.top[0]
            self.pop()
            if name == tag:
                return


def text_blocks(html: str) -> list[tuple[int, str]]:
    """Kind of container and text of each block outside dropped elements, in page order; white space is one space."""
    page, blocks, parts, kind, at = _Page(), [], [], NEUTRAL, 0

    def close() -> None:
        text = " ".join("".join(parts).split())
        if text:
            blocks.append((kind, text))
        parts.clear()

    while at < len(html):
        mark = _MARK.search(html, at)
        end = mark.start() if mark else len(html)
        if end > at and not page.top[1]:
            if page.top[2] != kind:
                close()
                kind = page.top[2]
            text = html[at:end]
            parts.append(unescape(text) if "&" in text else text)
        if not mark:
            break
        at, tag = mark.end(), (mark[2] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS:
            close()
        elif tag == "br":
            parts.append("\n")
        if mark[1]:
            page.end(tag)
        elif tag in RAW:
            found = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE).search(html, at)
            at = found.start() if found else len(html)
        else:
            page.start(tag, mark[3])
    close()
    return blocks


def main_blocks(html: str, named_share: float = 1 / 3) -> tuple[bool, list[str]]:
    """Blocks of the strongest kind of container that has text, and whether that kind is marked as the main text.

    A container known by its name only counts if it holds ``named_share`` of the page's text.
    """
    blocks = text_blocks(html)
    for least in (ARTICLE, MAIN, NAMED):
        chosen = [text for kind, text in blocks if kind >= least]
        if chosen and (least > NAMED or sum(map(len, chosen)) >= named_share * sum(len(text) for _, text in blocks)):
            return True, chosen
    return False, [text for _, text in blocks]
