"""HTML extraction: the reader against html.parser, the field against enumeration, pages against their source."""

import html
import itertools
import re
from html.parser import HTMLParser

import numpy as np
import pytest
from brute import SF, ordered

from tidemark.llm import pages
from tidemark.llm.pages import Block, Field, extract_text, features, leaf_blocks, likelihood, main_text


@pytest.fixture(scope="module")
def chain():
    return pages.train(pages.generated_pages())


class Shown(HTMLParser):
    """All text outside of the head, script and style."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("head", "script", "style")

    def handle_endtag(self, tag):
        self.skip -= tag in ("head", "script", "style")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def article(page):
    """What stands between <article> and </article>, cut at paragraphs and the heading."""
    own = page[page.index("<article>"):page.index("</article>")].replace("<br>", " ")
    parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?p>|</?h1>", own)]
    return "\n".join(x for x in parts if x)


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [tuple(r) for r in df.select("page_id", "url", "html").collect()]
    want = [(i, u, article(h), len(article(h))) for i, u, h in rows]
    assert ordered(extract_text(df).collect()) == ordered(want)
    for _, _, h in rows:
        reader = Shown()
        reader.feed(h)
        reader.close()
        assert "".join("".join(b.text.split()) for b in leaf_blocks(h)) == "".join("".join(reader.out).split())


EDGE = [(1, "u", None), (2, "u", ""), (3, None, "  "), (4, "u", "<p"), (5, "u", "<!-- open"), (6, "u", "plain words only, no tags. " * 4),
        (7, "u", "<article><h1>A &lt;b&gt; &amp;amp; &copy; caf&eacute;&#33;</h1><p>x  \n\t y&nbsp;z.<p>" + "word " * 200_000 + ".</article>"),
        (7, "u", "<article><p>same id, other page here.</p></article>"), (None, "u", "<article><p>No id, but text is here.</p></article>"),
        (8, "u", "<html><body><article><h1>Title</h1><p>a&lt;script&gt;c, in a sentence.</p><script>if (a<b) x = '</p>';</script><style>p>b{}</style></article>"),
        (9, "u", "<article><p>Twice the same.</p></article>"), (9, "u", "<article><p>Twice the same.</p></article>"),
        (10, "u", "<b>" * 5_000 + "<div>" * 5_000 + "deep" + "</i>" * 5_000)]


def test_edge_cases(spark, empty):
    """Nulls, empty and cut pages, a page of a megabyte, repeated rows, deep nests, other columns."""
    df = spark.createDataFrame([(*r, 1, "t") for r in EDGE], "page_id long, url string, html string, n_chars int, text string")
    out = extract_text(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    rows = out.collect()
    assert len(rows) == len(EDGE) and all(r["n_chars"] == len(r["text"]) for r in rows)
    text = {(r["page_id"], len(r["text"])): r["text"] for r in rows}
    by_id = {k[0]: v for k, v in text.items()}
    assert [by_id[i] for i in (1, 2, 3, 4, 5)] == [""] * 5
    long = max((v for k, v in text.items() if k[0] == 7), key=len)
    assert long == "A <b> &amp; © café!\nx y z.\n" + "word " * 200_000 + "."
    assert by_id[8] == "Title\na<script>c, in a sentence." and [r["text"] for r in rows if r["page_id"] == 9] == ["Twice the same."] * 2
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract_text(none).collect() == []


def test_blocks_of_broken_markup():
    def said(page):
        return [(b.text, b.tags) for b in leaf_blocks(page)]
    assert said("<ul><li>a<li>b</ul>c") == [("a", ("ul", "li")), ("b", ("ul", "li")), ("c", ())]
    assert said("<p><b>one<br><p>two</b> three") == [("one", ("p",)), ("two three", ("p",))]
    assert said("<table><tr><td>a<td>b<tr><td>c</table>") == [
        ("a", ("table", "tr", "td")), ("b", ("table", "tr", "td")), ("c", ("table", "tr", "td"))]
    assert said("a < b <i>c</i>d<!-- <p>x --><!-->e") == [("a < b cde", ())]
    assert said("<div title=\"a>b\" class='x'>t</div><title>no</title><head><p>body") == [("t", ("div",)), ("body", ("p",))]
    assert leaf_blocks("<div id=Main-Col><p>x")[0].names == {"main", "col"}


def test_held_out_pages(chain):
    """Pages of another seed: at least 99 % of the blocks, and 90 % of the pages whole."""
    found = [(labels, chain.decode(blocks)) for _, blocks, labels in (pages.Layouts(5).page() for _ in range(1))]
    layouts = pages.Layouts(77)
    found += [(y, chain.decode(b)) for _, b, y in (layouts.page() for _ in range(150))]
    right = sum(a == b for y, z in found for a, b in zip(y, z, strict=True))
    assert right >= 0.99 * sum(len(y) for y, _ in found)
    assert sum(y == z for y, z in found) >= 0.9 * len(found)


OTHER_SITE = """<html><body class="home"><div id="masthead"><a href="/">Daily Paper</a></div><div class="breadcrumb"><a href="/">Home</a> / <a href="/n">News</a></div>
<div id="cookie-banner">We use cookies. <button>Accept</button></div><div class="story"><h1>Floods in the north</h1>
<p>The river rose by two metres in the night, and many people left their homes.</p><div class="ad-slot">Buy now, pay later.</div>
<p>Help came from the <a href="/x">army</a> in the morning. It rained all day.</p><ul><li>Roads are closed.</li></ul></div>
<div class="sidebar"><h3>Related</h3><ul><li><a href="/1">One</a></li><li><a href="/2">Two</a></li></ul></div>
<form action="/s"><input name=q><button>Search</button></form>
<section id="comments"><h3>2 comments</h3><div class="comment"><b>Ann</b><p>I saw it, it was bad.</p></div></section>
<div id="footer">&copy; 2024 Daily Paper. All rights reserved.</div></body></html>"""


def test_layout_without_article_tags(chain):
    assert main_text(OTHER_SITE, chain).split("\n") == [
        "Floods in the north", "The river rose by two metres in the night, and many people left their homes.",
        "Help came from the army in the morning. It rained all day.", "Roads are closed."]


def test_field_against_enumeration():
    """Likelihood, its gradients and Viterbi paths against all label sequences."""
    rng = np.random.default_rng(4)
    emit, step, start = rng.normal(size=(5, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    size, label = np.array([4, 2]), np.array([[1, 0, 1, 1], [0, 1, 0, 0]])
    rows, names = np.array([0, 0, 1, 2, 3, 3, 4, 5, 5]), np.array([0, 3, 1, 2, 4, 0, 1, 3, 2])
    weights = [emit, step, start]

    def score(page, path):
        s = start[path[0]] + sum(step[a, b] for a, b in itertools.pairwise(path))
        return s + sum(emit[f, path[r - 4 * page]] for r, f in zip(rows, names) if 0 <= r - 4 * page < size[page])

    def mean():
        every = [[score(k, p) for p in itertools.product((0, 1), repeat=n)] for k, n in enumerate(size)]
        return np.mean([score(k, label[k, :n]) - np.log(np.exp(every[k]).sum()) for k, n in enumerate(size)])

    got, *grads = likelihood(*weights, rows, names, label, size)
    assert abs(got - mean()) < 1e-9
    for w, g in zip(weights, grads, strict=True):
        for at in np.ndindex(w.shape):
            old = w[at]
            w[at] = old + 1e-5
            up = mean()
            w[at] = old - 1e-5
            down = mean()
            w[at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 1e-6
    blocks = [Block(f"text {i}, number {i}.", ("p",) if i % 2 else ("nav", "li"), frozenset()) for i in range(6)]
    known = sorted({n for f in features(blocks) for n in f})
    chain = Field({n: i for i, n in enumerate(known)}, rng.normal(size=(len(known), 2)), step, start)
    s = chain.scores(blocks)
    best = max(itertools.product((0, 1), repeat=6), key=lambda p: start[p[0]] + s[range(6), list(p)].sum()
               + sum(step[a, b] for a, b in itertools.pairwise(p)))
    assert chain.decode(blocks) == list(best) and chain.decode([]) == []
