"""Spelling variants against plain Python."""

import collections
import random
import re
import zlib

import brute
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import variants


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def brute_counts(docs):
    out = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = run.translate(brute.ASCII_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 2}


def brute_variants(docs):
    n = brute_counts(docs)
    holes = collections.defaultdict(set)  # a word with one place left out, or the word itself
    for w in n:
        for key in {(w[:i], w[i + 1:]) for i in range(len(w))} | {(w[:i], w[i:]) for i in range(len(w) + 1)}:
            holes[key].add(w)
    near = {w: set() for w in n}
    for group in holes.values():
        for w in group:
            near[w] |= {x for x in group if one_edit(w, x)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return brute.ordered(out)


def found(df):
    return brute.ordered(df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_whole_table(spark, documents):
    df, docs = documents
    got = found(variants.spelling_variants(df))
    assert got == brute_variants(docs)
    assert any(r[1] for r in got)


def test_edge_cases(spark, edge, empty):
    df, docs = edge
    assert found(variants.spelling_variants(df)) == brute_variants(docs)
    assert found(variants.spelling_variants(empty)) == []


def test_chains_ties_and_long_words(spark):
    """Chains of forms, equal counts, every kind of edit, accents, repeated rows, very long and uniform words."""
    words = ["wordform"] * 3 + ["wordforms"] * 40 + ["wortforms"] * 700 + ["wartforms"] * 9000
    words += ["aaaaaaa"] * 2 + ["aaaaaaaa"] * 30 + ["aaaaaaaaa"] * 400 + ["bbbbbbbc"] * 2 + ["bbbbbbbd"] * 50 + ["bbbbbbba"] * 50
    words += ["éàüöïçñ"] * 2 + ["éàüöïçñé"] * 25 + ["ÉÀÜÖÏÇÑ"] * 5 + ["x" * 2_000, "x" * 2_001] * 3 + ["ab" * 400] * 2
    random.Random(3).shuffle(words)
    docs = [(i, " ".join(words[i::7]) + " Wordform; WORDFORMS") for i in range(7)] + [(None, "wordform"), (3, None), (4, ""), (4, "")]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, key long, other long")
    got = found(variants.spelling_variants(df))
    assert got == brute_variants(docs)
    assert max(len(r[0]) for r in got) > 1_900


LETTERS = "abcé"


@settings(max_examples=300, deadline=None)
@given(st.text(LETTERS, min_size=7, max_size=14), st.integers(0, 13), st.sampled_from(["add", "cut", "set"]),
       st.sampled_from(LETTERS), st.lists(st.text(LETTERS, min_size=7, max_size=10), max_size=5))
def test_one_edit_always_meets(word, at, kind, letter, others):
    """Whatever the order of rarity, one of two words an edit apart probes a key of the other."""
    at %= len(word)
    other = word[:at] + (letter if kind != "cut" else "") + word[at + (kind != "add"):]
    counts = collections.Counter(x[i:i + 2] for x in (word, other, *others) for i in range(len(x) - 1))
    grams = variants.Grams(counts)
    if other != word and len(other) > 3:
        assert (variants.probe_keys(word, grams) & variants.index_keys(other, grams)
                or variants.probe_keys(other, grams) & variants.index_keys(word, grams))
