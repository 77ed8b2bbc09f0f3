"""Labelled pages for the extraction model: invented articles in invented layouts, whose main text is known.

Every page has the parts that pages have (menus, headers, footers, sidebars, notices, adverts, forms, reader comments, scripts)
in random number, order, markup and naming: by HTML5 elements, by classes and ids, by table cells, or without any names.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator

#: Labelled pages that the query's model is fitted to.
TRAINING_PAGES = 700

# Names that sites give their areas.
ARTICLE = "article content post entry story main text body article-body post-content entry-content mainContent story-body prose".split()
WRAPPER = "page wrapper container row col site layout grid inner content main wrap".split()
AREAS = {
    "nav": "nav navbar menu navigation topnav main-menu breadcrumb breadcrumbs site-nav links tabs mega-menu toc pagination".split(),
    "header": "header masthead banner site-header top page-header branding logo topbar head tagline".split(),
    "footer": "footer site-footer bottom colophon copyright legal page-footer foot footer-links imprint".split(),
    "aside": "sidebar aside widget related popular trending recommended rail secondary right-col teaser more-stories side sidebarLeft".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo ad-slot adsbox banner-ad commercial partner promoted".split(),
    "notice": "notice cookie cookie-banner consent gdpr alert popup modal newsletter subscribe paywall message privacy-notice overlay".split(),
    "form": "form search login signup newsletter-form contact search-form register subscribe-form poll feedback".split(),
    "comments": "comments comment-list responses discussion replies disqus reader-comments respond comment-section thread".split(),
    "share": "share social tags share-buttons post-meta follow toolbar rating author-box buttons".split(),
}
ELEMENTS = {"nav": ("nav", "div", "ul", "div"), "header": ("header", "div"), "footer": ("footer", "div"), "aside": ("aside", "div", "section"),
            "ad": ("div", "aside", "section", "p"), "notice": ("div", "section", "p", "aside"), "form": ("form", "form", "div"),
            "comments": ("section", "div", "ol", "ul"), "share": ("div", "ul", "p")}
ROLES = {"nav": "navigation", "header": "banner", "footer": "contentinfo", "aside": "complementary", "form": "search", "notice": "alert"}
_SYLLABLES = "ba ce di fo gu ha in ja ke li mo nu or pa qui re so ti un va we xa yo zen é ü ß ñ ст ом 日 学".split()


class _Page:
    def __init__(self, rng: random.Random, names: slice):
        self.rng, self.names, self.blocks = rng, names, []
        self.named = rng.random() < 0.85          # the site names its areas
        self.semantic = rng.random() < 0.6        # the site uses HTML5 elements

    def word(self) -> str:
        return "".join(self.rng.choices(_SYLLABLES, k=self.rng.randint(1, 4)))

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(lo, hi))).capitalize()

    def prose(self, lo: int = 1, hi: int = 6) -> str:
        rng, out = self.rng, []
        for _ in range(rng.randint(lo, hi)):
            s = self.words(1, 18)
            if rng.random() < 0.4:
                s += ", " + self.words(1, 8).lower()
            if rng.random() < 0.08:
                s += rng.choice((" & ", " < ", " “", " — ", " # ")) + self.word()
            out.append(s + rng.choice("....!?"))
        return " ".join(out)

    def link(self, text: str) -> str:
        return f'<a href="/{self.word()}?a=1&b={self.rng.randint(1, 99)}">{html.escape(text)}</a>'

    def marked(self, text: str) -> str:
        """The text as markup: references, inline elements and white space that do not change it."""
        rng, out = self.rng, []
        for w in text.split(" "):
            e = html.escape(w, quote=rng.random() < 0.5)
            x = rng.random()
            if x < 0.02:
                e = self.link(w)
            elif x < 0.05:
                e = rng.choice(("<b>%s</b>", "<em>%s</em>", '<span class="x">%s</span>', "<code>%s</code>")) % e
            out.append(e + (rng.choice(("\n  ", "<br>", "&#32;", "\t")) if rng.random() < 0.03 else " "))
        return "".join(out)

    def article(self, tag: str, text: str, close: bool = True) -> str:
        """A block of the main text."""
        x = self.rng.random()
        if x < 0.04:    # an article may hold anything: rows of cells, marks, numbers, capitals
            text = " | ".join(self.word() for _ in range(self.rng.randint(1, 40)))
        elif x < 0.08:
            text = " ".join(w + self.rng.choice(("###", "%%%", "***", "$", "&&", "")) for w in text.split())
        elif x < 0.10:
            text = " ".join(str(self.rng.randint(0, 10 ** 6)) for _ in range(self.rng.randint(1, 30)))
        elif x < 0.12:
            text = text.upper()
        elif x < 0.14:
            text += self.rng.choice((f" © {self.word()}", f" {self.word()}@example.org", " • " + self.word(), " > " + self.word()))
        elif x < 0.16:
            text = self.word() + self.rng.choice((".", "", ":"))
        self.blocks.append(" ".join(text.split()))
        return f"<{tag}>{self.marked(text)}" + (f"</{tag}>" if close else "")

    def open(self, kind: str) -> tuple[str, str]:
        rng = self.rng
        tag = ELEMENTS[kind][0] if self.semantic and rng.random() < 0.7 else rng.choice(ELEMENTS[kind][1:])
        name = rng.choice(AREAS[kind][self.names])
        raw = tag
        if self.named and (tag == "div" or rng.random() < 0.6):
            raw += rng.choice((f' class="{name}"', f' id="{name}"', f' class="u{rng.randint(1, 99)} {name}-{rng.choice(("block", "inner", "1", "box"))}"'))
            if kind in ROLES and rng.random() < 0.1:
                raw += f' role="{ROLES[kind]}"'
        return f"<{raw}>", f"</{tag}>"

    def links(self, lo: int, hi: int) -> str:
        rng = self.rng
        texts = [self.words(1, rng.choice((2, 3, 9))) for _ in range(rng.randint(lo, hi))]
        style = rng.randint(0, 2)
        if style == 0:
            return "<ul>" + "".join(f"<li>{self.link(t)}" + rng.choice(("</li>", "")) for t in texts) + "</ul>"
        return (" | ", " ")[style - 1].join(self.link(t) for t in texts)

    def area(self, kind: str) -> str:
        rng = self.rng
        opened, closed = self.open(kind)
        # Without names, prose beside the article is told from it by nothing but its element.
        bare = not self.named and opened[1:-1] in ("div", "section", "p", "ul", "ol")
        if bare and kind in ("ad", "notice", "comments", "share"):
            return ""
        if kind == "nav":
            body = self.links(3, 10)
        elif kind == "header":
            body = rng.choice((f"<h1>{self.link(self.words(1, 4))}</h1>", f"<div>{self.words(1, 4)}</div>", f"<p>{self.words(1, 3)}</p>"))
            body += rng.choice(("", f"<p>{self.words(3, 9)}</p>", self.area("nav")))
        elif kind == "footer":
            body = rng.choice(("", f"<p>{self.prose(1, 3)}</p>", self.links(2, 6), f"<div>{self.links(2, 5)}</div>"))
            body += rng.choice((f"&copy; {rng.randint(1999, 2030)} {self.words(1, 4)}", f"<p>© {self.words(1, 4)} &middot; {self.prose(1, 2)}</p>",
                                f"<small>{self.words(1, 6)}</small>"))
        elif kind == "aside":
            body = rng.choice(("", f"<h3>{self.words(1, 4)}</h3>", f"<h2>{self.words(1, 4)}</h2>"))
            body += self.links(2, 8) if bare else rng.choice((self.links(2, 8), "".join(f"<p>{self.prose(1, 2)} {self.link(self.words(1, 3))}</p>" for _ in range(rng.randint(1, 4))),
                                f"<p>{self.prose(1, 3)}</p>", "".join(f"<article><h4>{self.link(self.words(2, 8))}</h4><p>{self.prose(1, 2)}</p></article>"
                                                                      for _ in range(rng.randint(1, 3)))))
        elif kind == "ad":
            body = rng.choice((html.escape(self.prose(1, 4)), f"<p>{html.escape(self.prose(1, 3))}</p>", self.link(self.words(2, 8)), f"<span>{self.words(1, 2)}</span>"))
        elif kind == "notice":
            body = rng.choice((html.escape(self.prose(1, 3)), f"<p>{html.escape(self.prose(1, 4))}</p><button>{self.word()}</button>",
                               f"{self.words(4, 12)} {self.link(self.word())}"))
        elif kind == "form":
            body = rng.choice(("", f"<h3>{self.words(1, 4)}</h3>", f"<p>{self.prose(1, 1)}</p>"))
            body += f'<label>{self.words(1, 3)}</label><input name="q"><select><option>{self.word()}<option>{self.word()}</select><button>{self.word()}</button>'
        elif kind == "comments":
            body = rng.choice(("", f"<h2>{rng.randint(1, 99)} {self.words(1, 2)}</h2>", f"<h3>{self.words(1, 2)}</h3>"))
            item, name = rng.choice((("li", "comment"), ("div", "comment"), ("article", "comment"), ("div", "reply"), ("p", "response"), ("div", "")))
            for _ in range(rng.randint(1, 6)):
                said = "".join(f"<p>{html.escape(self.prose(1, 4))}</p>" for _ in range(rng.randint(1, 2))) if item != "p" else html.escape(self.prose(1, 4))
                by = rng.choice(("", f"<b>{self.words(1, 2)}</b>", f'<div class="author">{self.words(1, 2)}</div>')) if item != "p" else ""
                body += f"<{item}" + (f' class="{name}"' if name and self.named else "") + f">{by}{said}</{item}>"
        else:
            body = self.links(2, 5) if rng.random() < 0.7 else self.words(1, 3) + " " + self.links(1, 3)
        if "<p" in opened[:2]:  # a paragraph holds no blocks
            body = html.escape(self.prose(1, 3))
        elif opened[:3] in ("<ul", "<ol") and "<li" not in body:
            body = f"<li>{body}</li>"
        return opened + body + closed

    def main(self) -> str:
        rng, out = self.rng, []
        if rng.random() < 0.85:
            title = self.article(rng.choice(("h1", "h1", "h2")), self.words(2, 14))
            out.append(f"<header>{title}</header>" if self.semantic and rng.random() < 0.15 else title)
        unclosed, odd_breaks = rng.random() < 0.15, rng.random() < 0.1
        for _ in range(rng.choice((1, 2, 4, 8, 14))):
            x = rng.random()
            if x < 0.72:
                out.append(self.article("p", self.prose(1, rng.choice((1, 4, 9))), not unclosed) + ("<br>" if odd_breaks else ""))
            elif x < 0.76:
                out.append(self.article("p", self.words(1, 3) + "."))
            elif x < 0.82:
                out.append(self.article(rng.choice(("h2", "h3")), self.words(1, 8)))
            elif x < 0.86:
                out.append("<ul>" + "".join(self.article("li", self.words(1, 16)) for _ in range(rng.randint(2, 5))) + "</ul>")
            elif x < 0.89:
                out.append("<blockquote>" + self.article("p", self.prose(1, 2)) + "</blockquote>")
            elif x < 0.91:
                out.append(self.article("blockquote", self.prose(1, 2)))
            elif x < 0.93:
                out.append("<figure><img src=x.png alt='y'>" + self.article("figcaption", self.words(3, 12)) + "</figure>")
            elif x < 0.95:
                out.append("<table>" + "".join("<tr>" + "".join(self.article("td", self.words(1, 3)) for _ in range(2)) + "</tr>"
                                               for _ in range(rng.randint(1, 3))) + "</table>")
            else:
                out.append(self.area(rng.choice(("ad", "ad", "aside", "share", "notice", "form"))))
            if rng.random() < 0.1:
                out.append(rng.choice(("<!-- x > y -->", "<script>if (a < b) document.write('<p>no</p>')</script>", "<style>p{margin:0}</style>")))
        return "".join(out)

    def wrapped(self, inner: str, tail: str) -> str:
        """The main text within its container; what follows stands within or behind it."""
        rng = self.rng
        within = tail if rng.random() < 0.4 else ""
        tag = rng.choice(("article", "main", "article", "section")) if self.semantic else "div"
        name = rng.choice(ARTICLE[self.names])
        raw = tag + (f' {rng.choice(("class", "id"))}="{name}"' if self.named and (tag == "div" or rng.random() < 0.4) else "")
        if rng.random() < 0.05:
            raw += ' role="main"'
        body = f"<{raw}>{inner}{within}</{tag}>"
        if tag == "article" and rng.random() < 0.3:
            body = f"<main>{body}</main>"
        return body + (tail if not within else "")

    def build(self) -> tuple[str, str]:
        rng = self.rng
        lead = [self.area(k) for k in ("notice", "header", "nav", "ad", "form", "nav") if rng.random() < 0.45]
        inner = self.main()
        tail = "".join(self.area(k) for k in rng.sample(("share", "comments", "aside", "form", "nav", "ad", "comments"), 4) if rng.random() < 0.4)
        close = [self.area(k) for k in ("aside", "notice", "footer", "nav") if rng.random() < 0.5]
        side = self.area("aside") if rng.random() < 0.4 else ""
        body = self.wrapped(inner, tail)
        layout = rng.random()
        if layout < 0.08:
            body = f"<table><tr><td>{self.links(3, 8)}</td><td>{body}</td><td>{side}</td></tr></table>"
        elif layout < 0.5:
            body = f'<div class="{rng.choice(WRAPPER)}">{side}{body}</div>' if rng.random() < 0.5 else f'<div class="{rng.choice(WRAPPER)}">{body}{side}</div>'
        else:
            body = side + body
        if rng.random() < 0.1:
            body += f'<div style="display:none">{html.escape(self.prose(1, 3))}</div>'
        page = "".join(lead) + body + "".join(close)
        if rng.random() < 0.2:
            page = f'<div id="{rng.choice(WRAPPER)}">{page}</div>'
        if rng.random() < 0.03:
            page = f'<form action="/">{page}</form>'
        head = f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{self.words(2, 9)}</title><style>p{{}}</style><script>var t="</p>";</script></head>'
        return f"{head}<body>{page}</body></html>", "\n\n".join(self.blocks)


def labelled_pages(n: int = TRAINING_PAGES, seed: int = 1, names: slice = slice(None)) -> Iterator[tuple[str, str]]:
    """n pages (html, main text).  ``names``: the part of the lists of area names that they use."""
    rng = random.Random(seed)
    for _ in range(n):
        yield _Page(rng, names).build()
