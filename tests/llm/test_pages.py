"""Main texts of web pages: the reader, the random field, and whole pages against a plain parser."""

import itertools
from html.parser import HTMLParser

import numpy as np
import pytest

from voxatlas.llm import blocks, extraction, layouts


class Plain(HTMLParser):
    """The text of <article>, a line for each run between tags that are no inline ones."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.runs, self.lines = 0, [], []

    def end(self):
        line = " ".join("".join(self.runs).split())
        self.runs = []
        if line:
            self.lines.append(line)

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.runs.append(" ")
        elif tag not in blocks.INLINE:
            self.end()
        self.inside += tag == "article"

    def handle_endtag(self, tag):
        if tag not in blocks.INLINE:
            self.end()
        self.inside -= tag == "article"

    def handle_data(self, data):
        if self.inside:
            self.runs.append(data)


def plain(html):
    parser = Plain()
    parser.feed(html)
    if parser.rawdata.startswith("<"):  # the page ends within a tag
        parser.rawdata = ""
    parser.close()
    parser.end()
    return "\n".join(parser.lines)


@pytest.fixture(scope="module")
def model(spark):
    return extraction.drawn_model(spark)


def test_given_pages(spark, sf, model):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    want = {r["page_id"]: plain(r["html"]) for r in pages.collect()}
    got = extraction.extract(pages, model).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert min(map(len, want.values())) > 0


def test_unseen_layouts(spark, model):
    """Pages that the fit has not seen: block by block, and whole."""
    top, right, total, whole = blocks.root(), 0, 0, 0
    for k in range(50_000, 50_300):
        html, main = layouts.page(k)
        found, _, _ = extraction.features(html, top)
        want = extraction.labels([b.text for b in found], main)
        lines = [x for x in main.split("\n") if x]
        assert sum(want) == len(lines)  # the reader finds every block of the article
        got = extraction.labels([b.text for b in found], model.decode(html, top))
        right += sum(a == b for a, b in zip(got, want, strict=True))
        total += len(want)
        whole += model.decode(html, top).split("\n") == lines
    assert right / total > 0.985 and whole / 300 > 0.8


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<p>a&amp;b &lt;c&gt; &eacute;&#33;<p>d", ["a&b <c> é!", "d"]),
        ("<ul><li>one<li>two <b>bold</ul>after", ["one", "two bold", "after"]),
        ("<div>x<p>y</p>z</div>", ["x", "y", "z"]),
        ("<script>if (a<b) '<p>no'</script>yes<style>p{}</style>", ["yes"]),
        ("<!-- <p>no</p> -->yes<!no><?no?></ no>!", ["yes!"]),
        ("<p title='a>b' class=x>in</p>", ["in"]),
        ("1 < 2 and <3", ["1 < 2 and <3"]),
        ("<p>open <a href='x", ["open"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("x<br>y<wbr>z &nbsp; w", ["x yz w"]),
        ("<P>UP</P><select><option>no</select>", ["UP"]),
        ("<p>a</div></span>b</p></p>", ["a", "b"]),
        ("&am<b>p;</b>", ["&amp;"]),
        ("", []),
        ("<", ["<"]),
    ],
)
def test_reader(html, want):
    assert [b.text for b in blocks.blocks(html, blocks.root())[0]] == want


def test_viterbi_and_gradient():
    """Decoding against all label sequences, the gradient against differences."""
    rng = np.random.default_rng(1)
    for n in range(7):
        scores, same, pairs = rng.normal(size=n).tolist(), [False] + (rng.random(max(n - 1, 0)) < 0.5).tolist(), rng.normal(size=(2, 2, 2))
        total = lambda y: sum(s for s, v in zip(scores, y, strict=True) if v) + sum(pairs[int(same[i])][y[i - 1]][y[i]] for i in range(1, n))  # noqa: B023, E731
        assert extraction.viterbi(scores, same[:n], pairs) == list(max(itertools.product((0, 1), repeat=n), key=total))
    pages = [([[int(rng.integers(4)), 4] for _ in range(n)], [False] + (rng.random(n - 1) < 0.5).tolist(), rng.integers(0, 2, n).tolist()) for n in (1, 3, 5, 2)]
    likelihood, w = extraction._Likelihood(pages, 5), rng.normal(size=13)
    _, gradient = likelihood.value(w)
    step = 1e-5 * np.eye(13)
    assert np.allclose(gradient, [(likelihood.value(w + e)[0] - likelihood.value(w - e)[0]) / 2e-5 for e in step], atol=1e-4)


def test_odd_pages(spark, model):
    """Null, empty, broken and repeated pages; other columns; none at all."""
    long = "<article>" + "<p>A sentence of some words, again and again.</p>" * 20_000 + "</article>"
    deep = "<div>" * 5_000 + "<p>Deep, but a text of more than a few words all the same.</p>"
    rows = [(1, "u", None), (1, "u", ""), (2, None, "<nav><a href=/>Home</a></nav>"), (None, "v", long), (4, "w", deep), (4, "w", deep), (5, "x", "<p")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'clash' as text", "1 as n_chars", "2 as known")
    got = extraction.extract(pages, model)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == len(rows)
    by = {(r["page_id"], r["url"]): r["text"] for r in got.collect()}
    assert by[(1, "u")] == by[(2, None)] == by[(5, "x")] == ""
    assert by[(None, "v")].count("\n") == 19_999
    assert extraction.extract(pages.limit(0), model).count() == 0


def test_fit_without_pages(spark):
    none = extraction.train(spark.createDataFrame([], "html string, text string"))
    assert none.decode("<p>text</p>", blocks.root()) == ""
