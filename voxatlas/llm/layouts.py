"""Labelled web pages by rule, to train and test the extraction of main texts.

A page's number seeds a choice of layout: semantic elements or named divisions, one of
many names for each, or none at all, wrapped in containers of any depth; an article of
headings, paragraphs, lists, quotations, tables and figures, with other things in the
middle of it at times; and around it menus, headers, footers, sidebars, notices,
adverts, forms, related links and readers' comments.  Words are drawn letters, so that
a model learns from the markup and the shape of texts and not from a language.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from html import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Names that authors give to elements, by what they hold.
NAMES = {
    "article": "article content post entry main story body text single hentry prose page markdown document".split(),
    "header": "header masthead top banner branding logo site brand topbar hero".split(),
    "nav": "nav menu navigation navbar breadcrumb breadcrumbs links tabs toc pagination pager".split(),
    "footer": "footer bottom copyright legal colophon foot credits imprint".split(),
    "sidebar": "sidebar aside widget rail column secondary complementary side panel".split(),
    "notice": "notice cookie consent gdpr alert popup modal overlay banner message warning privacy paywall".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion adsense banner commercial dfp".split(),
    "form": "form search subscribe newsletter login signup contact register".split(),
    "related": "related recommended more popular trending similar recent suggestions latest".split(),
    "share": "share social sharing follow facebook twitter buttons toolbar".split(),
    "comments": "comment comments reply replies discussion respond disqus thread reader feedback".split(),
}
#: Elements that hold such things, besides div and section.
TAGS = {"article": ["article", "main"], "header": ["header"], "nav": ["nav"], "footer": ["footer"], "sidebar": ["aside"], "form": ["form"], "notice": ["dialog", "aside"], "related": ["aside", "nav"], "ad": ["aside", "ins"], "share": [], "comments": ["section"]}
LABELS = {"nav": ["Home", "About", "Contact", "News", "Products"], "related": ["Related", "More", "Read next"], "comments": ["Comments", "Reply", "Leave a comment"], "share": ["Share", "Tweet", "Like"], "notice": ["We use cookies.", "Accept all cookies to go on.", "Read our privacy policy."], "footer": ["© 2024", "All rights reserved.", "Privacy", "Terms", "Imprint"], "form": ["Subscribe", "Search", "Your e-mail", "Sign up to our newsletter"], "ad": ["Advertisement", "Sponsored"], "sidebar": ["About us", "Archive", "Tags"], "header": ["Home"]}


class _Page:
    """One page in the making; ``main`` gathers the article's blocks."""

    def __init__(self, seed: int):
        self.r = random.Random(f"page {seed}")
        self.main: list[str] = []
        self.named = self.r.random() < 0.85
        self.semantic = self.r.random() < 0.65
        self.junk = self.r.random() < 0.1

    def word(self) -> str:
        w = "".join(self.r.choice("etaoinshrdlucmfwypvbgkéüñ") for _ in range(max(1, int(self.r.gauss(5, 3)))))
        return w + self.r.choice(["***", "%%%", "&&", "###"]) if self.junk and self.r.random() < 0.6 else w

    def words(self, n: int) -> str:
        return " ".join(self.word() for _ in range(max(1, n)))

    def sentence(self, n: int) -> str:
        return self.words(n).capitalize() + self.r.choice("....?!")

    def prose(self) -> str:
        many = self.r.choice([1, 1, 2, 3, 5, 8])
        return " ".join(self.sentence(self.r.choice([1, 2, 5, 9, 14, 22])) for _ in range(many))

    def open(self, kind: str) -> tuple[str, str]:
        """Start and end of an element of a kind."""
        tags = TAGS[kind]
        tag = self.r.choice(tags) if self.semantic and tags and self.r.random() < 0.8 else self.r.choice(["div", "div", "section"])
        if kind == "article" and not self.named and tag in ("div", "section"):
            return self.r.choice(["<div>", "<td>", "<section>"]), ""
        names = ""
        if self.named and (tag in ("div", "section") or self.r.random() < 0.5):
            name = self.r.choice(NAMES[kind])
            if self.r.random() < 0.5:
                name = self.r.choice(["site-{}", "{}-wrapper", "page_{}", "c-{}__inner", "{}1", "js-{}", "{}-box", "{}-area"]).format(name)
            if self.r.random() < 0.3:
                name += " " + self.r.choice(["row", "clearfix", "container", "col-md-8", "large", "x12", "u-mt"])
            names = f' {self.r.choice(["class", "class", "id"])}="{name}"'
        return f"<{tag}{names}>", f"</{tag}>"

    def inline(self, text: str) -> str:
        """Markup within a text."""
        parts = text.split(" ")
        for _ in range(self.r.choice([0, 0, 1, 2])):
            at = self.r.randrange(len(parts))
            tag = self.r.choice(["b", "i", "em", "strong", "span", "a", "code"])
            end = "" if tag == "b" and self.r.random() < 0.2 else f"</{tag}>"
            parts[at] = f'<{tag}{" href=/x" if tag == "a" else ""}>{parts[at]}{end}'
        return self.r.choice([" ", " ", "\n "]).join(parts)

    def own(self, tag: str, text: str, closed: bool = True) -> str:
        """A block of the article."""
        self.main.append(" ".join(text.split()))
        return f"<{tag}>{self.inline(escape(text))}" + (f"</{tag}>" if closed else "")

    def part(self) -> str:
        kind = self.r.choice(["p"] * 9 + ["short", "list", "quote", "table", "figure", "division", "heading", "code", "terms"])
        if kind == "p":
            return self.own("p", self.prose(), self.r.random() < 0.85)
        if kind == "short":
            return self.own("p", self.sentence(1))
        if kind == "list":
            tag = self.r.choice(["ul", "ol"])
            return f"<{tag}>" + "".join(self.own("li", self.r.choice([self.prose, lambda: self.words(self.r.randint(1, 8))])()) for _ in range(self.r.randint(2, 5))) + f"</{tag}>"
        if kind == "quote":
            return "<blockquote>" + self.own("p", self.prose()) + "</blockquote>"
        if kind == "table":
            return "<table>" + "".join("<tr>" + "".join(self.own("td", self.words(self.r.randint(1, 4))) for _ in range(2)) + "</tr>" for _ in range(3)) + "</table>"
        if kind == "figure":
            return "<figure><img src=x.png>" + self.own("figcaption", self.sentence(8)) + "</figure>"
        if kind == "division":
            return self.own("div", self.prose())
        if kind == "heading":
            return self.own(self.r.choice(["h2", "h3"]), self.words(self.r.randint(1, 7)))
        if kind == "code":
            return self.own("pre", self.words(12))
        return "<dl>" + self.own("dt", self.words(2)) + self.own("dd", self.prose()) + "</dl>"

    def other(self, kind: str) -> str:
        """Something that is not the article."""
        start, end = self.open(kind)
        label = lambda: escape(self.r.choice(LABELS.get(kind, ["More"])))
        link = lambda n: f'<a href="/{self.word()}">{self.words(n)}</a>'
        if kind in ("nav", "share", "related"):
            item = self.r.choice(["li", "li", "p", "div"])
            body = "".join(f"<{item}>{link(self.r.randint(1, 2 if kind != 'related' else 8))}</{item}>" for _ in range(self.r.randint(2, 7)))
            body = (f"<h3>{label()}</h3>" if kind == "related" or self.r.random() < 0.2 else "") + (f"<ul>{body}</ul>" if item == "li" else body)
        elif kind == "comments":
            inner = self.r.choice(["div", "li", "article"])
            body = f"<h3>{label()}</h3>" + "".join(f'<{inner}{self.r.choice([" class=comment", " class=comment", ""]) if self.named and inner != "article" else " class=comment" if inner == "article" else ""}><p>{self.word()}</p><p>{self.prose()}</p><a href=#r>Reply</a></{inner}>' for _ in range(self.r.randint(1, 4)))
        elif kind == "form":
            body = f'<label>{label()}</label><input name=q>{self.r.choice(["<p>" + self.sentence(7) + "</p>", ""])}<button>Go</button>'
        elif kind == "footer":
            line = lambda: f"{self.r.choice(['', '', '&copy; ', 'Copyright '])}{escape(self.r.choice([*LABELS['footer'], self.words(3), self.prose()]))}{self.r.choice(['', ' &middot; ' + link(1), ' | ' + self.sentence(9)])}"
            body = self.r.choice([line(), line(), "".join(f"<p>{line()}</p>" for _ in range(self.r.randint(1, 3)))])
        elif kind == "sidebar":
            body = self.r.choice([f"<h3>{label()}</h3><p>{self.prose()}</p><ul>" + "".join(f"<li>{link(2)}</li>" for _ in range(3)) + "</ul>", f"<p>{self.prose()}</p>", self.prose()])
        elif kind == "header":
            body = self.r.choice(["<h1>{}</h1>", "<div>{}</div>", "<h2>{}</h2>", "<p>{}</p>", "{}"]).format(link(self.r.randint(1, 3))) + self.r.choice(["", f"<p>{self.words(5)}</p>"])
        else:  # notices and adverts
            body = self.r.choice(["<p>{}</p>", "{}", "<div>{}</div>"]).format(self.r.choice([label(), self.sentence(7), self.prose(), f"{label()} {link(4)}"]))
        return start + body + end

    def page(self) -> str:
        r = self.r
        heading = self.words(r.randint(2, 9))
        start, end = self.open("article")
        inside = [self.own("h1", heading)] if r.random() < 0.9 else []
        if inside and r.random() < 0.15:
            inside = [f"<header>{inside[0]}</header>"]
        for _ in range(r.choice([1, 2, 4, 8, 16])):
            inside.append(self.part())
            if r.random() < 0.07:
                inside.append(self.other(r.choice(["ad", "ad", "related", "share", "form", "notice"])))
        after = [self.other(k) for k in ("share", "related", "comments") if r.random() < 0.25]
        if r.random() < 0.5:
            inside, after = inside + after, []
        article = start + "".join(inside) + end
        for _ in range(r.choice([0, 0, 1, 2])):
            article = f'<div{r.choice(["", " class=container", " id=wrap", " class=row"])}>{article}</div>'
        before = [self.other(k) for k in ("notice", "header", "nav", "ad", "form", "nav", "sidebar") if r.random() < 0.4]
        later = [self.other(k) for k in ("comments", "related", "sidebar", "ad", "form", "nav", "footer", "notice") if r.random() < 0.35]
        if r.random() < 0.9:
            later.append(self.other("footer"))
        title = escape(heading if r.random() < 0.7 else self.words(4))
        body = r.choice(["", "\n"]).join([*before, article, *after, *later])
        return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{margin:0}}</style></head><body><script>var a='<p>';</script>{body}<!-- end --></body></html>"


def page(seed: int) -> tuple[str, str]:
    """One page and its main text."""
    made = _Page(seed)
    html = made.page()
    return html, "\n".join(made.main)


def labelled_pages(spark: SparkSession, first: int, many: int) -> DataFrame:
    """(page_id, html, text) of the pages with these numbers."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            pages = [page(k) for k in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays([ids, pa.array([p[0] for p in pages], pa.string()), pa.array([p[1] for p in pages], pa.string())], ["page_id", "html", "text"])

    return spark.range(first, first + many).mapInArrow(draw, "page_id bigint, html string, text string")
