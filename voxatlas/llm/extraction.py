"""Main texts of web pages by a linear-chain conditional random field (operator 11).

A page is read as its leaf blocks in order (``blocks``).  What the field knows of a block
is the tags and names of the elements around it, the shape of its text, its links and its
place among the others; what it knows of two neighbours is whether they have one parent.
It is fitted on labelled pages by the exact gradient of their likelihood, and every page is
decoded by Viterbi, in its own task and without any shuffle.

Defined results: a null or empty page, or one without blocks of an article, has an empty
text; a page that breaks off counts as far as it goes; repeated rows are extracted each;
an empty table gives no rows; other columns are ignored, whatever their names.  Line
breaks (br) are white space within a block.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxatlas.llm import blocks as B
from voxatlas.llm.labelled import sigmoid
from voxatlas.llm.layouts import labelled_pages

#: Labelled pages that a fit uses at most, those of least hash; and those that the registered query draws.
SAMPLE, DRAWN = 5000, 1200
#: Ridge of the weights, and steps of the fit.
RIDGE, STEPS = 0.3, 150
#: Paths that a task remembers before it starts afresh, and characters of texts that it sends at once.
PATHS, SLICE = 20_000, 4_000_000

_CUES = frozenset("cookie cookies copyright subscribe newsletter advertisement sponsored reply comments related share privacy rights".split())
_WORD = re.compile(r"[a-z]+")
_LAYOUT = frozenset(("in:article", "in:main"))
_READERS = frozenset(("name:comment", "name:comments", "name:reply", "name:replies"))


def _shape(block: B.Block) -> list[str]:
    """What the text of a block shows by itself."""
    text = block.text
    n = text.count(" ") + 1
    size = "1" if n == 1 else "3" if n <= 3 else "8" if n <= 8 else "20" if n <= 20 else "60" if n <= 60 else "many"
    share = block.linked / len(text)
    links = "none" if share == 0 else "some" if share < 0.3 else "half" if share < 0.8 else "all"
    out = ["always", f"words:{size}", f"links:{links}", f"last:{'.' if text[-1] in '.!?…' else ':' if text[-1] in ':;,' else '-'}", f"words:{size} links:{links}"]
    if text[0] == "©":
        out.append("cue:©")
    if n <= 20:
        out += [f"cue:{w}" for w in set(_WORD.findall(text.lower())) & _CUES]
    return out


def _own(block: B.Block) -> bool:
    """Whether an element for articles is around a block, and not around a comment only."""
    return not _LAYOUT.isdisjoint(block.node.names) and _READERS.isdisjoint(block.node.names)


def _place(found: list[B.Block], title: str) -> list[list[str]]:
    """What the places of a page's blocks show."""
    prose = [b.text.count(" ") >= 14 and b.linked * 3 < len(b.text) for b in found]
    last = max((i for i, p in enumerate(prose) if p), default=-1)
    layout = any(_own(b) for b in found)
    first_heading = next((i for i, b in enumerate(found) if b.node.tag == "h1"), -1)
    out, seen = [], False
    for i, b in enumerate(found):
        seen = seen or prose[i]
        own = [f"tag:{b.node.tag}", "prose:before" if seen else "prose:none yet", "prose:after" if i < last else "prose:no more"]
        if layout:
            own.append("inside" if _own(b) else "outside")
        if first_heading >= 0:
            own.append("heading:after" if i >= first_heading else "heading:ahead")
        if title and len(b.text) >= 4 and title.startswith(b.text[: len(title)]) and len(b.text) * 2 >= len(title):
            own.append("title")
        out.append(own)
    return out


def features(html: str, top: B.Node) -> tuple[list[B.Block], list[list[str]], list[bool]]:
    """A page's blocks, what is known of each besides its path, and whether it shares its predecessor's parent."""
    found, title = B.blocks(html, top)
    known = [s + p for s, p in zip(map(_shape, found), _place(found, title), strict=True)] if found else []
    same = [i > 0 and b.node is found[i - 1].node for i, b in enumerate(found)]
    return found, known, same


def labels(found: list[str], main: str) -> list[int]:
    """Which blocks are the lines of a page's main text."""
    lines = [" ".join(x.split()) for x in main.split("\n")]
    out = [0] * len(found)
    for at, _, n in SequenceMatcher(None, found, [x for x in lines if x], autojunk=False).get_matching_blocks():
        out[at : at + n] = [1] * n
    return out


@dataclass
class Model:
    """Weights of what speaks for main text, and of pairs of neighbours: [same parent, label before, label]."""

    weights: dict[str, float]
    pairs: np.ndarray

    def decode(self, html: str, top: B.Node) -> str:
        """The main text of a page."""
        found, known, same = features(html, top)
        weigh = self.weights.get
        scores = []
        for b, names in zip(found, known, strict=True):
            if b.node.score is None:
                b.node.score = sum(weigh(n, 0.0) for n in b.node.names)
            scores.append(b.node.score + sum(weigh(n, 0.0) for n in names))
        return "\n".join(b.text for b, y in zip(found, viterbi(scores, same, self.pairs), strict=True) if y)


def viterbi(scores: list[float], same: list[bool], pairs: np.ndarray) -> list[int]:
    """The labels of the highest total; equal ones go to 0."""
    table = pairs.tolist()
    a = b = 0.0
    back: list[tuple[int, int]] = []
    for i, s in enumerate(scores):
        if i:
            t = table[same[i]]
            zero, one = (a + t[0][0], b + t[1][0]), (a + t[0][1], b + t[1][1])
            back.append((int(zero[1] > zero[0]), int(one[1] > one[0])))
            a, b = max(zero), max(one) + s
        else:
            b = s
    out = []
    y = int(b > a)
    for step in reversed([(0, 0), *back][: len(scores)]):
        out.append(y)
        y = step[y]
    return out[::-1]


class _Likelihood:
    """The labelled pages as arrays: one row a page, the longest first."""

    def __init__(self, pages: list[tuple[list[list[int]], list[bool], list[int]]], width: int):
        pages = sorted(pages, key=lambda p: -len(p[2]))
        self.width = width
        self.n, self.longest = len(pages), max((len(p[2]) for p in pages), default=0)
        self.length = np.array([len(p[2]) for p in pages], int)
        shape = (self.n, self.longest)
        self.y, self.same = np.zeros(shape, int), np.zeros(shape, int)
        place, feature = [], []
        for k, (known, same, y) in enumerate(pages):
            self.y[k, : len(y)], self.same[k, : len(same)] = y, same
            for i, ids in enumerate(known):
                place += [k * self.longest + i] * len(ids)
                feature += ids
        self.place, self.feature = np.array(place, int), np.array(feature, int)
        self.inside = np.arange(self.longest) < self.length[:, None]
        self.rows = self.inside.sum(axis=0).tolist()  # pages that reach a place

    def value(self, w: np.ndarray) -> tuple[float, np.ndarray]:
        """Minus the log-likelihood with its ridge, and its gradient."""
        pairs = w[self.width :].reshape(2, 2, 2)
        node = np.bincount(self.place, w[self.feature], self.n * self.longest).reshape(self.n, self.longest)
        score = np.zeros((self.n, self.longest, 2))
        score[:, :, 1] = node
        ahead, behind = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0]
        step = pairs[self.same]  # page, place, label before, label
        for i in range(1, self.longest):
            k = self.rows[i]
            ahead[:k, i] = score[:k, i] + np.logaddexp(ahead[:k, i - 1, 0, None] + step[:k, i, 0], ahead[:k, i - 1, 1, None] + step[:k, i, 1])
        for i in range(self.longest - 2, -1, -1):
            k = self.rows[i + 1]
            after = score[:k, i + 1] + behind[:k, i + 1]
            behind[:k, i] = np.logaddexp(step[:k, i + 1, :, 0] + after[:, 0, None], step[:k, i + 1, :, 1] + after[:, 1, None])
        rows = np.arange(self.n)
        end = ahead[rows, self.length - 1]
        total = np.logaddexp(end[:, 0], end[:, 1])
        p = sigmoid((ahead + behind)[:, :, 1] - (ahead + behind)[:, :, 0])
        own = np.where(self.inside, np.where(self.y == 1, node, 0), 0).sum()
        gradient = np.zeros_like(w)
        gradient[: self.width] = np.bincount(self.feature, (np.where(self.inside, p - self.y, 0).ravel())[self.place], self.width)
        both = self.inside[:, 1:]
        log_pair = ahead[:, :-1, :, None] + step[:, 1:] + (score + behind)[:, 1:, None, :] - total[:, None, None, None]
        chance = np.where(both[:, :, None, None], np.exp(np.minimum(log_pair, 0)), 0)
        before, now, same = self.y[:, :-1], self.y[:, 1:], self.same[:, 1:]
        for s in (0, 1):
            here = both & (same == s)
            gradient[self.width + 4 * s :][:4] = np.where(here[:, :, None, None], chance, 0).sum(axis=(0, 1)).ravel() - np.bincount((2 * before + now)[here], minlength=4)
        own += pairs[same, before, now][both].sum()
        return total.sum() - own + RIDGE / 2 * (w @ w), gradient + RIDGE * w


def minimise(f, w: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """L-BFGS with backtracking."""
    value, g = f(w)
    s_all: list[np.ndarray] = []
    y_all: list[np.ndarray] = []
    for _ in range(steps):
        q, alphas = g.copy(), []
        for s, y in zip(reversed(s_all), reversed(y_all), strict=True):
            alphas.append((s @ q) / (s @ y))
            q -= alphas[-1] * y
        q *= (s_all[-1] @ y_all[-1]) / (y_all[-1] @ y_all[-1]) if s_all else 1 / max(1.0, np.abs(g).max())
        for s, y, a in zip(s_all, y_all, reversed(alphas), strict=True):
            q += s * (a - (y @ q) / (s @ y))
        step = 1.0
        while True:
            new = w - step * q
            new_value, new_g = f(new)
            if new_value <= value - 1e-4 * step * (g @ q) or step < 1e-8:
                break
            step /= 2
        s, y = new - w, new_g - g
        if s @ y > 1e-10:
            s_all, y_all = [*s_all, s][-memory:], [*y_all, y][-memory:]
        done = abs(value - new_value) < 1e-5 * max(1.0, abs(value))
        w, value, g = new, new_value, new_g
        if done:
            break
    return w


def train(labelled: DataFrame, most: int = SAMPLE) -> Model:
    """A model fitted on labelled pages: (html, text), the text being the main text's blocks, a line each.

    At most ``most`` pages are used, those of least hash; their features come to the
    driver, of no other page.
    """
    chosen = labelled.select("html", "text").where("html is not null").orderBy(F.xxhash64("html"), "html").limit(most)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, same, ys = [], [], []
            top = B.root()
            for html, main in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found, own, together = features(html, top)
                known.append([[*b.node.names, *names] for b, names in zip(found, own, strict=True)])
                same.append(together)
                ys.append(labels([b.text for b in found], main or ""))
            yield pa.RecordBatch.from_arrays([pa.array(known, pa.list_(pa.list_(pa.string()))), pa.array(same, pa.list_(pa.bool_())), pa.array(ys, pa.list_(pa.int32()))], ["known", "same", "y"])

    rows = chosen.mapInArrow(scan, "known array<array<string>>, same array<boolean>, y array<int>").where("size(y) > 0").collect()
    names = {n: k for k, n in enumerate(sorted({n for r in rows for block in r["known"] for n in block}))}
    if not rows:
        return Model({}, np.zeros((2, 2, 2)))
    likelihood = _Likelihood([([[names[n] for n in block] for block in r["known"]], r["same"], r["y"]) for r in rows], len(names))
    w = minimise(likelihood.value, np.zeros(len(names) + 8), STEPS)
    return Model({n: float(w[k]) for n, k in names.items() if abs(w[k]) > 1e-6}, w[len(names) :].reshape(2, 2, 2))


_DRAWN: list[Model] = []


def drawn_model(spark) -> Model:
    """A model fitted on drawn pages; the same one whenever it is fitted."""
    if not _DRAWN:
        _DRAWN.append(train(labelled_pages(spark, 0, DRAWN)))
    return _DRAWN[0]


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    kinds = dict(pages.dtypes)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = B.root()
        for batch in batches:
            lo, texts, size = 0, [], 0
            for k, html in enumerate(batch.column(2)):
                texts.append(model.decode(html.as_py() or "", top))
                size += len(texts[-1])
                if top.made[0] > PATHS:
                    top = B.root()
                if size > SLICE or k + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(texts)), batch.column(1).slice(lo, len(texts)), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
                    lo, texts, size = k + 1, [], 0

    return pages.select("page_id", "url", "html").mapInArrow(scan, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
