"""Source divergence audit against plain Python."""

import collections
import re

import brute
import duckdb
import numpy as np
import pytest

from tidemark.llm import divergence
from tidemark.llm.oracle import ORACLE_SQL


def brute_audit(docs):
    groups, total, seen = {}, collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(brute.ASCII_LOWER))
        groups.setdefault((lang, source), collections.Counter()).update(words)
        total[lang].update(words)
        seen[lang].update(set(words))
    out = []
    for (lang, source), own in groups.items():
        kept = sorted(t for t, n in seen[lang].items() if n >= 3)

        def priced(counts, kept=kept):
            size = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 1) // size for t in kept}
        p = priced(own)
        pair = [(other, sum((p[t] - q) ** 2 // q for t, q in priced(c).items()))
                for (tongue, other), c in groups.items() if tongue == lang and other != source]
        q = priced(total[lang])
        term = [(t, (p[t] - q[t]) ** 2 // q[t]) for t in kept if own[t] and p[t] > q[t]]
        for part, rows, top in (("pair", pair, None), ("term", term, 200)):
            rows.sort(key=lambda r: (-r[1], r[0].encode()))
            out += [(lang, source, part, item, v, k) for k, (item, v) in enumerate(rows[:top], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


EDGE = [("en", "a", "x y z x"), ("en", "a", "x y z"), ("en", "b", "X y é,é q"), ("en", "b", "é é"), ("en", "c", None),
        ("en", "c", ""), ("en", None, "x é y_z 12"), (None, "a", "one one two"), (None, "b", "one two"), ("", "c", "one"),
        ("fr", "a", "seul"), ("fr", "b", "seul"), ("de", "only", "w " * 50_000), ("en", "a", "x y z"), ("en", "a", "x y z")]


@pytest.mark.parametrize("block,tile,held", [(8192, 16, 500_000), (1, 1, 3), (2, 2, 1)])
def test_edge_cases_in_blocks_and_tiles(spark, monkeypatch, block, tile, held):
    """Nulls, empty and long texts, ties, repeated rows and clashing names, also in the smallest blocks and tiles."""
    monkeypatch.setattr(divergence, "BLOCK_TERMS", block)
    monkeypatch.setattr(divergence, "TILE_GROUPS", tile)
    monkeypatch.setattr(divergence, "HELD_COUNTS", held)
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in EDGE],
                               "lang string, source string, text string, n long, term long, ids long, a long")
    assert found(divergence.source_divergence(df)) == brute_audit(EDGE)


def test_empty_table(spark, empty):
    assert found(divergence.source_divergence(empty)) == []


def test_prices_are_exact():
    counts = np.array([0, 1, 7, 10 ** 12, 9 * 10 ** 14 - 1])
    total = 9 * 10 ** 14
    assert divergence.prices(counts, total).tolist() == [1 + 10 ** 9 * (int(c) + 1) // total for c in counts]


def test_gallop_finds_shared_ids():
    rng = np.random.default_rng(1)
    for n, m in ((0, 5), (3, 300), (300, 3), (50, 50)):
        a, b = (np.unique(rng.integers(0, 400, k)) for k in (n, m))
        x, y = divergence.gallop(a, b)
        assert a[x].tolist() == b[y].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_whole_table_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{brute.SF}/documents.parquet')")
    cols = "lang, source, part, item, value, rank"
    want = sorted(con.sql(f"SELECT {cols} FROM ({ORACLE_SQL['op13_source_divergence']})").fetchall())
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet")
    assert found(divergence.source_divergence(docs)) == want
    assert want == brute_audit([tuple(r) for r in docs.select("lang", "source", "text").collect()])
