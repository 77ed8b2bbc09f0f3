"""Leaf blocks of a web page: the runs of text between block tags, each with its ancestors.

The reader goes through the page once.  Unclosed, misnested and cut-off tags are taken as browsers do in the cases
that matter for text: a block closes an open paragraph, an item the item before it, an end tag what it encloses.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# HTML elements by how they shape text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
UNSEEN = frozenset("script style title textarea xmp iframe noembed noframes noscript template svg math select datalist button "
                   "object video audio canvas map".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var".split())
#: An opening tag of the first kind closes an open one of the second, up to the container.
ITEMS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
         "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th", "thead"), "tfoot": ("tr", "td", "th", "tbody")}
CONTAINERS = frozenset("ul ol dl table menu div article section main aside nav header footer form body html td th blockquote".split())
#: Elements whose text is weighed together.
SECTIONS = frozenset("div article section main aside nav header footer form td body ul ol dl table blockquote".split())

#: Parts of class and id names that mark an area wherever they stand in the name.
STEMS = ("comment", "sidebar", "footer", "header", "nav", "menu", "advert", "cookie", "banner", "promo", "share", "social", "related",
         "widget", "article", "content", "post", "entry", "story", "breadcrumb", "sponsor", "newsletter", "subscri", "login", "search",
         "reply", "respon", "discuss", "legal", "copyright", "popup", "modal", "consent", "notice", "teaser", "recommend", "meta")

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"[>=]")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Path:
    """An element's ancestors as features; elements that are opened alike share one, over all pages."""

    __slots__ = ("all", "near", "own", "children", "cache")

    def __init__(self, features=frozenset(), near=frozenset(), own=""):
        #: Of all ancestors, and of the nearest one that has a name or is a section by its element.
        self.all, self.near, self.own, self.children, self.cache = features, near, own, {}, None

    @property
    def features(self) -> list[str]:
        return sorted(self.all) + sorted(self.near)

    def enter(self, name: str, raw: str) -> Path:
        path = self.children.get(raw)
        if path is None:
            mine = element_features(name, raw)
            telling = len(mine) > 1 or name in SECTIONS and name not in ("div", "td", "body")
            near = frozenset("n:" + f for f in mine) if telling else self.near
            path = self.children[raw] = Path(self.all | mine, near, name)
        return path


def element_features(name: str, raw: str) -> set[str]:
    """Features of an opening tag: its name, the words of its class and id, its role, and whether it is hidden."""
    out = {"t:" + name}
    for key, value in _ATTRIBUTE.findall(raw):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id"):
            out |= {"c:" + x.lower() for x in _TOKEN.findall(value)}
            low = value.lower()
            out |= {"s:" + s for s in STEMS if s in low}
        elif key == "role":
            out.add("r:" + value.lower())
        elif key == "style" and _HIDDEN.search(value) or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            out.add("hidden")
    return out


@dataclass
class Block:
    text: str
    path: Path
    section: int
    links: int
    """Characters of the text that lie in links, about."""


@dataclass
class _Open:
    name: str
    path: Path
    section: int


@dataclass
class _Reader:
    root: Path
    blocks: list[Block] = field(default_factory=list)

    def __post_init__(self):
        self.stack = [_Open("", self.root, 0)]
        self.count: dict[str, int] = {}
        self.unseen = self.links = self.sections = 0
        self.buffer: list[str] = []
        self.linked = 0
        self.at = self.stack[0]

    def text(self, chunk: str) -> None:
        if self.unseen or not chunk:
            return
        if "&" in chunk:
            chunk = unescape(chunk)
        if not self.buffer:
            if chunk.isspace():
                return
            self.at = self.stack[-1]
        self.buffer.append(chunk)
        if self.links:
            self.linked += len(chunk.strip())

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                # The text's block is the nearest one around it; inline elements have their parent's path.
                self.blocks.append(Block(text, self.at.path, self.at.section, self.linked))
            self.buffer, self.linked = [], 0

    def pop(self) -> None:
        top = self.stack.pop()
        self.count[top.name] -= 1
        self.unseen -= top.name in UNSEEN
        self.links -= top.name == "a"

    def push(self, name: str, raw: str) -> None:
        top = self.stack[-1]
        if name in INLINE:
            path, section = top.path, top.section
        else:
            path = top.path.enter(name, raw)
            section = top.section
            if name in SECTIONS:
                self.sections += 1
                section = self.sections
        self.stack.append(_Open(name, path, section))
        self.count[name] = self.count.get(name, 0) + 1
        self.unseen += name in UNSEEN
        self.links += name == "a"

    def close_to(self, names, stop) -> None:
        """Closes the nearest open element of these names, unless one of ``stop`` lies above it."""
        if not any(self.count.get(x) for x in names):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            name = self.stack[i].name
            if name in names:
                while len(self.stack) > i:
                    self.pop()
                return
            if name in stop:
                return

    def start(self, name: str, raw: str) -> None:
        if name == "br":
            self.text(" ")
        elif name in INLINE:
            if name == "a" and self.links:  # links do not nest
                self.close_to(("a",), CONTAINERS)
            self.push(name, raw)
        elif name in VOID:
            if name == "hr":
                self.flush()
        else:
            if name not in ("script", "style", "template", "noscript"):  # these may stand within a paragraph
                self.flush()
                self.close_to(("p",), CONTAINERS)
            if name in ITEMS:
                self.close_to(ITEMS[name], CONTAINERS - {"td", "th"})
            if name in ("html", "body") and self.count.get(name):
                return
            self.push(name, raw)

    def end(self, name: str) -> None:
        if name == "br":
            self.text(" ")
        elif name in INLINE:
            self.close_to((name,), CONTAINERS)
        elif name not in ("html", "body") and name not in VOID and self.count.get(name):
            if name not in UNSEEN:
                self.flush()
            self.close_to((name,), ())


def leaf_blocks(html: str, root: Path) -> list[Block]:
    """The page's blocks in order.  Linear in the page."""
    r = _Reader(root)
    at, n = 0, len(html)
    no_quote = {'"': False, "'": False}
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            r.text(html[at:])
            break
        follow = html[lt + 1:lt + 2]
        if follow == "!" or follow == "?":
            r.text(html[at:lt])
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 2)
                at = n if end < 0 else end + 3
            elif html.startswith("<![CDATA[", lt):
                end = html.find("]]>", lt)
                at = n if end < 0 else end + 3
            else:
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            continue
        closing = follow == "/"
        m = _NAME.match(html, lt + 1 + closing)
        if not m:
            if closing:  # "</" without a name is a comment up to ">"
                r.text(html[at:lt])
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                r.text(html[at:lt + 1])
                at = lt + 1
            continue
        r.text(html[at:lt])
        name, p = m.group().lower(), m.end()
        while True:  # the tag's end: a ">" outside quoted values
            stop = _STOP.search(html, p)
            if not stop:
                p = n
                break
            p = stop.end()
            if stop.group() == ">":
                break
            while html[p:p + 1].isspace():
                p += 1
            quote = html[p:p + 1]
            if quote in no_quote and not no_quote[quote]:
                end = html.find(quote, p + 1)
                no_quote[quote] = end < 0
                p = p + 1 if end < 0 else end + 1
        if not html.endswith(">", lt, p):
            break  # the page ends within a tag
        at = p
        if closing:
            r.end(name)
            continue
        r.start(name, html[lt:p])
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
            at = end.start() if end else n
    r.flush()
    return r.blocks
