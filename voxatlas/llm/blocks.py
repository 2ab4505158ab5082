"""Leaf blocks of web pages: runs of text between the borders of block elements.

A reader for pages as they are found: it follows the HTML rules for comments, raw text,
quoted attributes, unknown markup, implied ends of p, li, dt, dd, tr, td and th, and
ends that match nothing.  Every block has its text, with character references decoded
and white space turned into single spaces, and the path of its block elements.
"""

from __future__ import annotations

import re
from html import unescape

#: Elements that stand within a line of text; all others that are known border blocks.
INLINE = frozenset("a abbr acronym b bdi bdo big blink cite code data del dfn em font i img ins kbd label map mark meter nobr output picture progress q rb rp rt rtc ruby s samp small span strike strong sub sup time tt u var".split())
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
#: Elements without text of the page, up to their end; an unclosed one of the first kind takes the rest.
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
SKIPPED = RAW | frozenset("noscript template svg math select button object canvas audio video datalist".split())
_DOCUMENT = frozenset(("html", "head", "body"))
_CELLS = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "thead": ("thead", "tbody", "tfoot"), "tbody": ("thead", "tbody", "tfoot"), "tfoot": ("thead", "tbody", "tfoot")}
_ITEMS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd")}
_FENCES = frozenset(("table", "td", "th", "caption"))
_BLOCK = frozenset("address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|aria-label|itemprop)(?=[\s=/]|$)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_LETTERS = re.compile(r"[a-z]+")


class Node:
    """A block element with what its path says: its tags and the words of its names."""

    __slots__ = ("tag", "names", "children", "score", "made")

    def __init__(self, tag: str, names: tuple[str, ...], made: list[int]):
        self.tag, self.names, self.children, self.score, self.made = tag, names, {}, None, made
        made[0] += 1

    def child(self, tag: str, attributes: str) -> Node:
        key = (tag, attributes)
        node = self.children.get(key)
        if node is None:
            node = Node(tag, self._with(tag, attributes), self.made)
            self.children[key] = node
        return node

    def _with(self, tag: str, attributes: str) -> tuple[str, ...]:
        new = [f"in:{tag}"] + [f"name:{w}" for w in attribute_words(attributes)]
        have = set(self.names)
        new = [n for n in dict.fromkeys(new) if n not in have]
        return self.names + tuple(new) if new else self.names


def attribute_words(attributes: str) -> list[str]:
    """Words of an element's class, id and the like."""
    out = []
    for kind, *values in _ATTRIBUTE.findall(attributes):
        if kind.lower() == "hidden":
            out.append("hidden")
            continue
        value = unescape("".join(values))
        out += _LETTERS.findall(_CAMEL.sub(" ", value).lower())
    return out


class Block:
    __slots__ = ("text", "node", "linked")

    def __init__(self, text: str, node: Node, linked: int):
        self.text, self.node, self.linked = text, node, linked


def root() -> Node:
    """An empty path; ``made`` counts the paths that begin with it."""
    return Node("", (), [0])


def blocks(html: str, top: Node) -> tuple[list[Block], str]:
    """The blocks of a page in its order, and its title.

    ``top`` holds the paths met so far; it may be used for many pages, or a new one for
    each.
    """
    out: list[Block] = []
    stack: list[tuple[str, Node]] = [("", top)]
    held: dict[str, int] = {}
    runs: list[str] = []
    links = linked = 0
    title = ""

    def flush() -> None:
        nonlocal linked
        if runs:
            text = " ".join("".join(runs).split())
            runs.clear()
            if text:
                out.append(Block(text, stack[-1][1], min(linked, len(text))))
        linked = 0

    def pop_to(at: int) -> None:
        nonlocal links
        for tag, _ in stack[at:]:
            held[tag] -= 1
            links -= tag == "a"
        del stack[at:]

    def close(names: tuple[str, ...], fences) -> None:
        """End the nearest of ``names`` unless a fence stands before it."""
        if not any(held.get(n) for n in names):
            return
        for at in range(len(stack) - 1, 0, -1):
            tag = stack[at][0]
            if tag in names:
                pop_to(at)
                return
            if fences(tag):
                return

    def text(run: str) -> None:
        nonlocal linked
        if run:
            if "&" in run:
                run = unescape(run)
            runs.append(run)
            if links > 0:
                linked += len(run)

    pos, size = 0, len(html)
    while pos < size:
        at = html.find("<", pos)
        if at < 0:
            text(html[pos:])
            break
        mark = html[at + 1 : at + 2]
        if mark == "!" or mark == "?" or (mark == "/" and not html[at + 2 : at + 3].isalpha() and at + 2 < size):
            text(html[pos:at])
            if html.startswith("<!--", at):
                if html.startswith(("<!-->", "<!--->"), at):
                    pos = html.index(">", at) + 1
                    continue
                ends = [e for e in (html.find("-->", at + 4), html.find("--!>", at + 4)) if e >= 0]
                pos = html.index(">", min(ends)) + 1 if ends else size
            else:
                end = html.find(">", at)
                pos = end + 1 if end >= 0 else size
            continue
        if not (mark.isascii() and mark.isalpha()) and mark != "/":
            text(html[pos : at + 1])
            pos = at + 1
            continue
        text(html[pos:at])
        found = _TAG.match(html, at)
        if found is None:  # the page ends within a tag
            break
        pos = found.end()
        ending, tag, attributes = found[1], found[2].lower(), found[3]
        if tag in _DOCUMENT:
            flush()
            continue
        if ending:
            if tag == "br":
                runs.append(" ")
            elif tag in INLINE:
                close((tag,), _BLOCK.__contains__)
            elif tag in _BLOCK:
                flush()
                close((tag,), (lambda t: t == "table") if tag in _FENCES or tag in _CELLS else _FENCES.__contains__)
            else:
                close((tag,), _FENCES.__contains__)
            continue
        if tag in SKIPPED:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, pos)
            if end is None:
                if tag in RAW:
                    break
                continue
            if tag == "title" and not title:
                title = " ".join(unescape(html[pos : end.start()]).split())
            after = html.find(">", end.end())
            pos = after + 1 if after >= 0 else size
            continue
        if tag in VOID:
            if tag in ("br", "wbr"):
                runs.append(" " if tag == "br" else "")
            elif tag == "hr":
                flush()
                close(("p",), lambda t: t not in INLINE)
            continue
        if tag in _BLOCK:
            flush()
            close(("p",), lambda t: t not in INLINE)
            if tag in _ITEMS:
                close(_ITEMS[tag], lambda t: t in _BLOCK and t not in ("address", "div", "p"))
            elif tag in _CELLS:
                close(_CELLS[tag], lambda t: t == "table")
            elif tag[0] == "h" and tag[1:].isdigit() and stack[-1][0][:1] == "h" and stack[-1][0][1:].isdigit():
                pop_to(len(stack) - 1)
            node = stack[-1][1].child(tag, attributes)
        else:  # inline and unknown elements leave the path as it is
            node = stack[-1][1]
            if tag == "a":
                close(("a",), _BLOCK.__contains__)
                links += 1
        stack.append((tag, node))
        held[tag] = held.get(tag, 0) + 1
    flush()
    return out, title
