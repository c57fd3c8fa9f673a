"""HTML extraction: a linear-chain conditional random field over the leaf blocks of a page.

A page is read into its leaf blocks (runs of text without a block-level tag inside). Each block
has features of its ancestors' tags, of the words in their class and id, of its text and of its
neighbours. The field is trained in numpy on labelled pages and labels a page's blocks as main
text or not by Viterbi's algorithm. Labelled pages are written by a seeded generator over several
page layouts, or given by the caller; no row of the table is used for training.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import map_arrow

#: Generated training pages; the only data the field is fitted to unless a caller gives pages.
TRAIN_PAGES = 600
STEPS, BATCH, RATE, DECAY = 500, 64, 0.05, 1e-4

# Fixed values of the HTML standard: elements without an end tag, those of a page's head, those whose
# content is not markup, those never shown as text, and inline ones, which do not end a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IN_HEAD = frozenset("base link meta title style script noscript template".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("script style title iframe noembed noframes head template noscript svg "
                   "textarea select datalist".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr br".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag that ends an open element of its kind, up to the element that holds both.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}

_MARKUP = re.compile(r"<(?:(?P<comment>!--)|(?P<end>/)?(?P<tag>[A-Za-z][^\s/>]*)"
                     r"(?P<attrs>(?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)>?|[!?/][^>]*+>?)")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_TOKEN = re.compile(r"[a-z]+")
_ABOUT = re.compile("cookie|subscri|newsletter|sign up|log in|privacy|copyright|©|all rights|advert|sponsor|comment|repl(?:y|ies)|"
                    "share|read more|related|terms of|contact|follow us|search|menu|home")


@dataclass
class Block:
    text: str
    tags: tuple[str, ...]              # ancestors, outermost first
    names: frozenset[str]              # words of their class, id and role
    linked: int = 0                    # characters inside links


def leaf_blocks(page: str | None) -> list[Block]:
    """Leaf blocks in page order. Unclosed and misnested tags are closed where a block starts or ends;
    a tag cut off by the end of the page ends there."""
    page = page or ""
    blocks: list[Block] = []
    stack: list[tuple[str, frozenset[str], bool]] = []  # tag, names so far, hidden
    open_tags: Counter = Counter()
    parts: list[str] = []
    linked, at = 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            blocks.append(Block(text, tuple(s[0] for s in stack if s[0] not in INLINE),
                                stack[-1][1] if stack else frozenset(), linked))
        parts.clear()
        linked = 0

    def pop() -> None:
        open_tags[stack.pop()[0]] -= 1

    def say(chunk: str) -> None:
        nonlocal linked
        if chunk and not (stack and stack[-1][2]):
            chunk = html.unescape(chunk) if "&" in chunk else chunk
            parts.append(chunk)
            if open_tags["a"]:
                linked += len(chunk)

    while True:
        m = _MARKUP.search(page, at)
        if m is None:
            break
        say(page[at:m.start()])
        at = m.end()
        if m["comment"]:
            end = page.find("-->", m.start() + 2)
            at = len(page) if end < 0 else end + 3
            continue
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if tag in HEADINGS and not open_tags[tag]:  # one heading's end ends any other
                tag = next((s[0] for s in reversed(stack) if s[0] in HEADINGS), tag)
            if not open_tags[tag]:
                if tag == "p":
                    flush()
                continue
            if tag not in INLINE:
                flush()
            elif next(s[0] for s in reversed(stack) if s[0] == tag or s[0] not in INLINE) != tag:
                continue  # opened outside of this block
            while stack[-1][0] != tag:
                pop()
            pop()
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if open_tags["head"] and tag not in IN_HEAD and not any(s[2] and s[0] != "head" for s in stack):
            while open_tags["head"]:  # left open
                pop()
        if tag not in INLINE:
            flush()
            while stack and stack[-1][0] in INLINE:  # left open before a block
                pop()
            if open_tags["p"] and stack[-1][0] == "p":
                pop()
            if tag in CLOSES:
                ended, bounds = CLOSES[tag]
                for depth in range(len(stack) - 1, max(-1, len(stack) - 40), -1):
                    if stack[depth][0] in bounds:
                        break
                    if stack[depth][0] in ended:
                        while len(stack) > depth:
                            pop()
                        if tag != "tr":
                            break
        if tag in VOID:
            continue
        names = stack[-1][1] if stack else frozenset()
        if "=" in m["attrs"]:
            own = {t for x in _NAMES.findall(m["attrs"]) for t in _TOKEN.findall("".join(x).lower())}
            names = names | own if own else names
        if tag == "body" or tag == "html":
            names = frozenset()
        hidden = tag in HIDDEN or bool(stack and stack[-1][2] and tag != "body")
        stack.append((tag, names, hidden))
        open_tags[tag] += 1
        if tag in RAW:
            end = re.compile(f"</{tag}", re.I).search(page, at)
            if end is None:
                say(page[at:])
                at = len(page)
            else:
                say(page[at:end.start()])
                at = end.start()
    say(page[at:])
    flush()
    return blocks


def _bucket(n: int, edges: Sequence[int]) -> int:
    return sum(n >= e for e in edges)


def features(blocks: list[Block]) -> list[list[str]]:
    """Names of the features that hold for each block."""
    out, headed = [], False
    sizes = [len(b.text) for b in blocks]
    for i, b in enumerate(blocks):
        own = b.tags[-1] if b.tags else "none"
        words = b.text.count(" ") + 1
        ends = b.text[-1] in ".!?…:;\"”»)"
        f = ["bias", f"tag={own}", f"words={_bucket(words, (2, 4, 8, 16, 32, 64))}",
             f"link={_bucket(100 * b.linked // sizes[i], (1, 30, 70))}", f"ends={ends}",
             f"stops={_bucket(len(re.findall('[.,;!?]', b.text[:2000])), (1, 3, 8))}",
             f"headed={headed}", f"tag={own},ends={ends}"]
        f += {f"in={t}" for t in b.tags[:-1]}
        f += [f"name={t}" for t in b.names]
        if sizes[i] < 300:
            f += {f"about={x}" for x in _ABOUT.findall(b.text.lower())}
        for side, j in (("before", i - 1), ("behind", i + 1)):
            if 0 <= j < len(blocks):
                f.append(f"{side}={_bucket(sizes[j], (20, 80, 300))},{blocks[j].tags[-1] if blocks[j].tags else 'none'}")
        headed = headed or own == "h1"
        out.append(f)
    return out


@dataclass
class Field:
    """Weights of a chain with two labels: 1 is main text."""

    index: dict[str, int]
    emit: np.ndarray     # feature, label
    step: np.ndarray     # label, next label
    start: np.ndarray

    def scores(self, blocks: list[Block]) -> np.ndarray:
        out = np.zeros((len(blocks), 2))
        for i, names in enumerate(features(blocks)):
            known = [self.index[n] for n in names if n in self.index]
            out[i] = self.emit[known].sum(axis=0)
        return out

    def decode(self, blocks: list[Block]) -> list[int]:
        """The most likely labels of a page's blocks (Viterbi)."""
        if not blocks:
            return []
        s = self.scores(blocks)
        best, back = self.start + s[0], []
        for row in s[1:]:
            ways = best[:, None] + self.step
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + row
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def likelihood(emit: np.ndarray, step: np.ndarray, start: np.ndarray, rows: np.ndarray, names: np.ndarray, label: np.ndarray,
               size: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Mean log-likelihood of labelled pages, padded side by side, and its gradients.

    ``rows`` and ``names`` are the (block, feature) pairs, blocks numbered page * longest + place.
    """
    pages, longest = label.shape
    s = np.zeros((pages * longest, 2))
    for k in (0, 1):
        s[:, k] = np.bincount(rows, emit[names, k], minlength=pages * longest)
    s = s.reshape(pages, longest, 2)
    inside = np.arange(longest) < size[:, None]
    forward, backward = np.zeros((longest, pages, 2)), np.zeros((longest, pages, 2))
    forward[0] = start + s[:, 0]
    for t in range(1, longest):
        on = _logsum(forward[t - 1][:, :, None] + step, 1) + s[:, t]
        forward[t] = np.where(inside[:, t, None], on, forward[t - 1])
    for t in range(longest - 2, -1, -1):
        on = _logsum(step + (s[:, t + 1] + backward[t + 1])[:, None, :], 2)
        backward[t] = np.where(inside[:, t + 1, None], on, backward[t + 1])
    whole = _logsum(forward[-1], 1)
    who = np.arange(pages)
    truth = start[label[:, 0]] + s[who, 0, label[:, 0]]
    d_step, d_start, d_s = np.zeros((2, 2)), np.zeros(2), np.zeros((pages, longest, 2))
    for t in range(longest):
        use = inside[:, t]
        p = np.exp(forward[t] + backward[t] - whole[:, None])
        d_s[use, t] = -p[use]
        d_s[who[use], t, label[use, t]] += 1
        if t:
            joint = forward[t - 1][:, :, None] + step + (s[:, t] + backward[t])[:, None, :] - whole[:, None, None]
            d_step -= np.exp(joint[use]).sum(axis=0)
            np.add.at(d_step, (label[use, t - 1], label[use, t]), 1)
            truth += np.where(use, step[label[:, t - 1], label[:, t]] + s[who, t, label[:, t]], 0)
    d_start += d_s[:, 0].sum(axis=0)
    flat = d_s.reshape(-1, 2)
    d_emit = np.stack([np.bincount(names, flat[rows, k], minlength=len(emit)) for k in (0, 1)], axis=1)
    return float((truth - whole).mean()), d_emit / pages, d_step / pages, d_start / pages


def train(pages: Sequence[tuple[list[Block], list[int]]], steps: int = STEPS, seed: int = 5) -> Field:
    """Fit the field to (blocks, labels) pairs by gradient ascent on the likelihood of ``BATCH`` pages
    at a time (Adam, weight decay, a falling rate).

    Features seen on fewer than three pages are left out. Without pages nothing is main text.
    """
    pages = [(b, y) for b, y in pages if b]
    listed = [features(b) for b, _ in pages]
    seen = Counter(n for page in listed for n in {x for f in page for x in f})
    index = {n: i for i, n in enumerate(sorted(n for n, k in seen.items() if k >= 3))}
    emit, step, start = np.zeros((len(index), 2)), np.zeros((2, 2)), np.zeros(2)
    if not pages:
        return Field(index, emit, step, np.array([0.0, -1.0]))
    known = []  # of each page: places and features of its blocks
    for own in listed:
        pairs = [(i, index[n]) for i, f in enumerate(own) for n in f if n in index]
        known.append(np.array(pairs or np.zeros((0, 2)), int))
    rng, weights = np.random.default_rng(seed), [emit, step, start]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for t in range(1, steps + 1):
        batch = rng.choice(len(pages), min(BATCH, len(pages)), replace=False)
        size = np.array([len(pages[k][0]) for k in batch])
        longest = int(size.max())
        label = np.zeros((len(batch), longest), int)
        for row, k in enumerate(batch):
            label[row, :size[row]] = pages[k][1]
        rows = np.concatenate([known[k][:, 0] + row * longest for row, k in enumerate(batch)])
        names = np.concatenate([known[k][:, 1] for k in batch])
        _, *grads = likelihood(*weights, rows, names, label, size)
        rate = RATE * min(1.0, 2 * (1 - t / (steps + 1)))
        for w, g, m, v in zip(weights, grads, first, second, strict=True):
            g = g - DECAY * w
            m[...] = 0.9 * m + 0.1 * g
            v[...] = 0.999 * v + 0.001 * g * g
            w += rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Field(index, *weights)


# ------------------------------------------------------------------ labelled pages

_SYLLABLES = "the an er in on re ti ou es th ar la de que en ch und ge ver os cion ment eau ing".split()


class Layouts:
    """Labelled pages in several layouts: every piece of text says whether it is main text."""

    #: Plain words that layouts give to the class or id of what holds the article, and of all else.
    MAIN = ("content", "main", "post", "entry", "article", "story", "body text", "article-body", "post-content", "markdown")
    OTHER = {"menu": ("nav", "menu", "navbar", "breadcrumb", "topnav", "main-nav", "toc"),
             "header": ("header", "masthead", "site-header", "banner", "branding", "post-meta byline"),
             "footer": ("footer", "site-footer", "copyright", "colophon", "legal"),
             "sidebar": ("sidebar", "aside", "widget", "related", "popular", "tags", "share social", "content-sidebar"),
             "notice": ("cookie", "cookie-banner", "notice", "alert", "gdpr consent", "popup modal", "subscribe newsletter"),
             "advert": ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot"),
             "comments": ("comments", "comment-list", "replies", "disqus", "discussion", "post-comments")}
    SAYINGS = {"notice": ("We use cookies to improve your visit.", "Accept all cookies", "Subscribe to our newsletter!", "Read our privacy policy."),
               "footer": ("© 2024 All rights reserved.", "Copyright", "Terms of use · Privacy", "Contact us"),
               "advert": ("Advertisement", "Sponsored", "Buy now", "Our best offer of the week."),
               "comments": ("Reply", "3 comments", "Leave a comment", "Comments"),
               "menu": ("Home", "About", "Contact", "Menu", "Skip to content"), "sidebar": ("Related", "Popular", "Read more", "Share"),
               "header": ("Welcome", "Search", "By", "Published")}

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        return " ".join("".join(self.r.choices(_SYLLABLES, k=self.r.randint(1, 4))) for _ in range(self.r.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        mark = self.r.choice(("", "", "", " &amp;", "***", " &lt;b&gt;", ", 1999", " – "))
        gap = self.r.choice((" ",) * 9 + (" | ", "### ", " &amp;&amp; "))
        return " ".join(self.words(1, 25).capitalize().replace(" ", gap) + mark + self.r.choice((".", ".", "!", "?", ""))
                        for _ in range(self.r.randint(low, high)))

    def inline(self, text: str) -> str:
        if self.r.random() < 0.3:
            w = text.split(" ")
            i = self.r.randrange(len(w))
            w[i] = self.r.choice(("<b>{}</b>", "<a href='/x'>{}</a>", "<em class=x>{}</em>", "<b>{}", "{}<br>", "<span>{}</span>")).format(w[i])
            return " ".join(w)
        return text

    def element(self, tag: str, inner: str, name: str = "") -> str:
        attr = self.r.choice(("class", "id", "class")) if name else ""
        return f'<{tag} {attr}="{name}">{inner}</{tag}>' if name else f"<{tag}>{inner}</{tag}>"

    def links(self, low: int, high: int) -> str:
        items = [f"<a href='/{i}'>{self.words(1, 3)}</a>" for i in range(self.r.randint(low, high))]
        style = self.r.random()
        if style < 0.6:
            return self.element("ul", "".join(f"<li>{x}{'</li>' if style < 0.4 else ''}" for x in items))
        return " | ".join(items) if style < 0.8 else "".join(f"<div>{x}</div>" for x in items)

    def aside(self, kind: str) -> str:
        """Markup of a piece that is not main text."""
        said = self.r.choice(self.SAYINGS[kind]) if self.r.random() < 0.6 else self.words(1, 6)
        inner = {"menu": lambda: self.links(2, 8),
                 "header": lambda: self.r.choice((f"<h2>{said}</h2>", f"<p>{said}</p>", said, f"<form><input name=q><button>{said}</button></form>")),
                 "footer": lambda: self.r.choice((f"{said} &middot; {self.sentences(1, 2)}", f"&copy; {self.words(1, 2)} &middot; {self.sentences(0, 3)}", f"<p>{said}</p>" + self.links(1, 4))),
                 "sidebar": lambda: f"<h3>{said}</h3>" + self.r.choice((self.links(2, 6), f"<p>{self.sentences(1, 3)}</p>")),
                 "notice": lambda: self.r.choice((f"<p>{said}</p>", f"{said} <button>OK</button>", f"<form>{said}<input type=email><button>{self.words(1, 2)}</button></form>", said + " " + self.sentences(0, 2))),
                 "advert": lambda: self.r.choice((said, self.sentences(1, 3), f"<p>{self.sentences(1, 2)}</p>", f"<a href=#>{self.sentences(1, 1)}</a>")),
                 "comments": lambda: f"<h3>{said}</h3>" + "".join(self.r.choice((
                     f"<div class=comment><b>{self.words(1, 2)}</b><p>{self.sentences(1, 4)}</p></div>", f"<li><p>{self.sentences(1, 4)}</p></li>",
                     f"<article><p>{self.sentences(1, 3)}</p></article>")) for _ in range(self.r.randint(1, 5)))}[kind]()
        tags = {"menu": ("nav", "div"), "header": ("header", "div"), "footer": ("footer", "div"), "sidebar": ("aside", "div"),
                "notice": ("div", "section", "dialog", "div"), "advert": ("div", "aside", "div", "section"), "comments": ("section", "div")}[kind]
        tag = self.r.choice(tags)
        named = self.r.random() < (0.4 if tag in ("nav", "header", "footer", "aside") else 0.97)
        return self.element(tag, inner, self.r.choice(self.OTHER[kind]) if named else "")

    def article(self, title: str) -> list[str]:
        """Markup of the pieces of an article, in order."""
        def paragraph() -> str:
            kind = self.r.random()
            text = (self.sentences(1, 9) if kind < 0.75 else self.words(1, 3).capitalize() + "." if kind < 0.85
                    else self.words(3, 60) if kind < 0.93 else " ".join([self.words(1, 2)] * self.r.randint(2, 30)))
            if self.r.random() < 0.08:  # what is said around articles is said in them, too
                text = self.r.choice(self.SAYINGS[self.r.choice(list(self.SAYINGS))]) + self.r.choice(("", " " + text))
            text = self.inline(text)
            return f"<p>{text}</p>" if self.r.random() < 0.85 else f"<p><b>{self.words(1, 12)}.<br><p>{text}</p>"
        out = [self.element(self.r.choice(("h1", "h1", "h2")), title)] if self.r.random() < 0.75 else []
        plain = self.r.random() < 0.1
        for _ in range(self.r.choice((1, 2, 4, 8, 14, 25))):
            kind = self.r.random()
            if plain:
                out.append(f"<div>{self.sentences(1, 6)}</div>")
            elif kind < 0.8:
                out.append(paragraph())
            elif kind < 0.86:
                out.append(f"<h{self.r.choice('23')}>{self.words(1, 6)}</h2>")
            elif kind < 0.91:
                out.append(self.element(self.r.choice(("ul", "ol")), "".join(f"<li>{self.sentences(1, 2)}</li>" for _ in range(self.r.randint(1, 5)))))
            elif kind < 0.94:
                out.append(f"<blockquote>{self.sentences(1, 3)}</blockquote>")
            elif kind < 0.97:
                out.append(f"<pre>{self.words(3, 12)}</pre>")
            else:
                out.append(f"<table><tr><th>{self.words(1, 2)}<td>{self.words(1, 3)}<tr><td>{self.words(1, 2)}<td>{self.words(1, 4)}</table>")
        return out

    def page(self) -> tuple[str, list[Block], list[int]]:
        """(html, leaf blocks, labels); the labels come from where each piece was put."""
        r, title = self.r, self.words(1, 9).capitalize() + self.r.choice((".", "", ""))
        bare = r.random() < 0.1  # an article and little else
        kinds = [k for k in ("menu", "header", "notice", "advert") if r.random() < (0.05 if bare else 0.6)]
        r.shuffle(kinds)
        tails = [k for k in ("sidebar", "comments", "advert", "notice", "footer")
                 if r.random() < (0.05 if bare else 0.85 if k == "footer" else 0.4)]
        pieces: list[tuple[str, int]] = [(self.aside(k), 0) for k in kinds]
        own = [(x, 1) for x in self.article(title)]
        for _ in range(r.choice((0, 0, 0, 1, 2))):  # what stands in the middle of an article
            own.insert(r.randint(min(1, len(own)), len(own)), (self.aside(r.choice(("advert", "sidebar", "notice"))), 0))
        if r.random() < 0.15:
            own.append((self.aside("comments"), 0))
        holder, name = r.choice((("article", ""), ("article", ""), ("article", r.choice(self.MAIN)), ("main", ""), ("div", r.choice(self.MAIN)),
                                 ("div", r.choice(self.MAIN)), ("section", r.choice(self.MAIN)), ("td", "")))
        attr = f' class="{name}"' if name else ""
        opened, closed = f"<{holder}{attr}>", f"</{holder}>"
        if holder == "td":
            opened, closed = "<table><tr><td>", "</td></tr></table>"
        if r.random() < 0.2:
            opened, closed = opened + f'<div class="{r.choice(("wrap", "inner", "container", "row"))}">', "</div>" + closed
        head = (f"<!DOCTYPE html><html lang=en><head><meta charset=utf-8><title>{title}</title><style>p{{margin:0}}</style>"
                f"<script>var t=\"</p>\";</script></head><body>" if r.random() < 0.9 else "")
        wrap = r.random() < 0.3
        whole = [(head + ('<div class="page container">' if wrap else ""), None), *pieces, (opened, None), *own, (closed, None),
                 *[(self.aside(k), 0) for k in tails],
                 ((("</div>" if wrap else "") + "</body></html>") if r.random() < 0.9 else "", None)]
        text, done, ends = "".join(x for x, _ in whole), "", []
        for x, kind in whole:  # pieces are whole block elements, so the blocks up to each one's end tell its own
            done += x
            if kind is not None:
                ends.append((len(leaf_blocks(done)), kind))
        blocks = leaf_blocks(text)
        return text, blocks, [next((kind for n, kind in ends if i < n), 0) for i in range(len(blocks))]


def generated_pages(n: int = TRAIN_PAGES, seed: int = 11) -> list[tuple[list[Block], list[int]]]:
    layouts = Layouts(seed)
    return [layouts.page()[1:] for _ in range(n)]


def main_text(page: str | None, chain: Field) -> str:
    """The blocks that the field labels as main text, joined by line ends."""
    blocks = leaf_blocks(page)
    return "\n".join(b.text for b, y in zip(blocks, chain.decode(blocks), strict=True) if y)


def extract_text(pages: DataFrame, chain: Field | None = None) -> DataFrame:
    """Per page: page_id, url, text (the main text, empty if there is none) and n_chars.

    ``chain`` is a trained field; by default one is fitted to the generated pages. A null page is an
    empty one; repeated rows, ids or urls that are null are kept as they are. Pages of any length are
    read whole; other columns are left out, whatever their names.
    """
    handle = pages.sparkSession.sparkContext.broadcast(chain or train(generated_pages()))
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = handle.value
        for batch in batches:
            found = [main_text(x, chain) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()),
                                              pa.array([len(x) for x in found], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    kind = rows.schema
    return map_arrow(rows, run, f"page_id {kind['page_id'].dataType.simpleString()}, "
                                f"url {kind['url'].dataType.simpleString()}, text string, n_chars long")
