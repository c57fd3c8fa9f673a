import brute
import numpy as np
import pytest
from brute import ordered
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__
from tidemark.llm import components as C
from tidemark.llm import lines as L
from tidemark.llm import simhash as S
from tidemark.llm import substrings as U


def test_cover_meets_every_difference():
    assert {(a - b) % U.PERIOD for a in U.COVER for b in U.COVER} == set(range(U.PERIOD))


@pytest.mark.parametrize("bucket_bytes", [U.BUCKET_BYTES, 1 << 16])
def test_substrings_whole_table(documents, bucket_bytes):
    df, docs = documents
    rows = U.repeated_words(df, bucket_bytes=bucket_bytes).collect()
    want = brute.repeats(docs)
    assert ordered(rows) == ordered(want) and any(r[2] for r in want)


def test_substrings_every_shift(spark):
    """A passage of exactly one window repeats at every pair of remainders, and just below never does."""
    passage = " ".join(f"p{i}" for i in range(35))
    docs = [(k, " ".join(f"d{k}x{i}" for i in range(k)) + " " + passage + f" end{k}") for k in range(22)]
    docs += [(100 + k, " ".join([f"e{k}y{i}" for i in range(k)] + [f"q{i}" for i in range(34)] + [f"z{k}"])) for k in range(3)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r["doc_id"]: r for r in U.repeated_words(df, bucket_bytes=200, with_text=True).collect()}
    assert all(rows[k]["n_removed"] == 35 for k in range(22))
    assert all(rows[100 + k]["n_removed"] == 0 for k in range(3))
    assert rows[2]["kept_text"] == "d2x0 d2x1 end2"


def test_substrings_edge(edge, empty):
    df, docs = edge
    assert ordered(U.repeated_words(df).collect()) == ordered(brute.repeats(docs))
    assert U.repeated_words(empty).count() == 0


def test_substrings_of_rows_that_share_an_id(spark):
    """Rows of one id (or none) and one length are dealt over buckets; results stay the same."""
    passage = " ".join(f"p{i:03d}" for i in range(40))
    docs = [(None, f"{passage} own {i:04d}") for i in range(400)] + [(7, f"x{i:04d} " * 30) for i in range(400)] + [(i, "a b") for i in range(9)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert ordered(U.repeated_words(df, bucket_bytes=4096).collect()) == ordered(brute.repeats(docs))


def test_lines_whole_table(documents):
    df, docs = documents
    want = brute.repeated_lines(docs)
    assert ordered(L.line_report(df).collect()) == ordered(want) and any(r[2] for r in want)


def test_lines_edge(spark, edge, empty):
    df, docs = edge
    assert ordered(L.line_report(df).collect()) == ordered(brute.repeated_lines(docs))
    assert L.line_report(empty).count() == 0
    kept = L.dedup_lines(df)
    assert kept.columns == df.columns
    block = "\n".join(f"line {i}" for i in range(40))
    more = [(1, block), (2, "intro\n" + block + "\nend"), (2, "intro\n" + block + "\nend"), (None, block), (4, "\n\n\n"),
            (5, "\n\n\n"), (6, "\n".join(str(i % 7) for i in range(3000)))]
    df = spark.createDataFrame(more, "doc_id long, text string")
    assert ordered(L.line_report(df).collect()) == ordered(brute.repeated_lines(more))


def _repeated_pairs(docs):
    """Lines of every repeated run of two lines or more, by (id, text): all pairs of neighbouring lines."""
    seen, out = set(), {}
    for d, t in sorted({(d, t) for d, t in docs if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines, gone = t.split("\n"), set()
        for i, own in enumerate(zip(lines, lines[1:], strict=False)):
            if own in seen:
                gone |= {i, i + 1}
            elif any(x.strip(" ") for x in own):
                seen.add(own)
        out[d, t] = gone
    return out


def test_line_recall_and_copies(spark, documents):
    """At least nine of ten lines of all repeated runs go, nothing else does, and exact copies go whole."""
    df, docs = documents
    runs = {d: len(g) for (d, _), g in _repeated_pairs(docs).items()}
    found = {r["doc_id"]: r["n_removed"] for r in __spark_entry__.queries()["op4_line_dedup"](spark, brute.SF).collect()}
    assert sum(found.values()) >= 0.9 * sum(runs.values()) > 0
    assert all(found[d] <= n for d, n in runs.items())
    text, first = dict(docs), {}
    for d, t in sorted(docs):
        first.setdefault(t, d)
    copies = {d for d, t in docs if t and "\n" in t.strip("\n") and first[t] != d}
    kept = {r["doc_id"] for r in L.dedup_lines(df).collect()}
    assert copies and not copies & kept and all(len(text[d].split("\n")) == found[d] for d in copies)


def test_line_passages_edge(spark):
    """Passages inside other texts go with the lines around their chunks, copies whole; of one line
    over and over the first stays."""
    passage = "\n".join(f"line {i} of a passage" for i in range(12))
    docs = [(1, f"a\n{passage}\nb"), (2, f"c\nd\n{passage}"), (3, f"{passage}\ne"), (4, passage), (None, "x\ny"),
            (5, "x\ny\nx\ny\nx"), (6, "same\n" * 50 + "end"), (7, None), (8, ""), (9, "\n\n"), (10, "\n\n"),
            (11, "alone"), (12, "alone"), (12, "alone"), (13, "u\nv\n\n\n"), (14, "u\nv\n\n\n")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = L.line_report(df).collect()
    assert ordered(rows) == ordered(brute.repeated_lines(docs))
    lost = {r[0]: r[2] for r in rows}
    assert [lost[d] for d in (1, None, 7, 8, 9, 10, 11, 12, 13)] == [0] * 9 and [lost[d] for d in (2, 3, 4, 5)] == [12, 12, 12, 5]
    assert lost[6] >= 48
    kept = {r["doc_id"] for r in L.dedup_lines(df).collect()}
    assert kept == {d for d, _ in docs} - {4, 5, 14}


def test_line_shares():
    """Random texts over few lines, in which all kinds of overlaps happen."""
    import random
    r = random.Random(8)
    for _ in range(20):
        pool = [f"l{r.random()}" for _ in range(12)]
        docs = [(i, "\n".join(r.choices(pool, k=r.randint(1, 25)))) for i in range(12)]
        runs = _repeated_pairs(docs)
        for (d, t), row in zip(docs, brute.repeated_lines(docs), strict=True):
            assert row[2] <= len(runs[d, t])


def test_random_overlaps(spark):
    import random
    r = random.Random(9)
    pool = [f"l{i}" for i in range(15)] + [""]
    docs = [(i, "\n".join(r.choices(pool, k=r.randint(1, 30)))) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert ordered(L.line_report(df).collect()) == ordered(brute.repeated_lines(docs))


def test_lines_of_long_texts_and_repeated_rows(spark):
    """Work in proportion to the lines: two equal texts of 16,000 lines, 3,000 equal rows against 3,000 others."""
    import time
    long = "\n".join(f"line {i} {i * i}" for i in range(16_000))
    spark.createDataFrame([(1, "warm\nup")], "doc_id long, text string").transform(L.line_report).collect()
    began = time.time()
    rows = L.line_report(spark.createDataFrame([(1, long), (2, "x\n" + long)], "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["n_removed"] for r in rows} == {1: 0, 2: 16_000}
    block = "one\ntwo\nthree\nfour"
    df = spark.createDataFrame([(1, block)] * 3000 + [(k, f"{k}\n{block}\n{-k}") for k in range(2, 3002)], "doc_id long, text string")
    rows = L.line_report(df).collect()
    assert sum(r["n_removed"] for r in rows if r["doc_id"] == 1) == 0
    assert all(r["n_removed"] == 4 for r in rows if r["doc_id"] > 1) and len(rows) == 6000
    assert time.time() - began < 60


def test_lines_of_rows_that_differ_elsewhere(spark):
    """Rows equal in id and text but not in other columns share their fate."""
    block = "\n".join(f"line {i}" for i in range(30))
    rows = [(1, block, "a"), (1, block, "b"), (2, "x\n" + block, "a"), (2, "x\n" + block, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = L.dedup_lines(df).collect()
    assert sorted(r["source"] for r in kept if r["doc_id"] == 1) == ["a", "b"]
    want = {r[0]: r for r in brute.repeated_lines([r[:2] for r in rows])}
    assert all(brute.sha256(r["text"]) == want[r["doc_id"]][3] for r in kept)


def test_lines_shift_resistant():
    block = [f"line {i}" for i in range(200)]
    own = {tuple(block[a:b]) for a, b in brute.line_chunks("\n".join(block))[1]}
    lines, chunks = brute.line_chunks("\n".join(["new", *block]))
    assert len(own & {tuple(lines[a:b]) for a, b in chunks}) >= len(own) - 2


def test_simhash_whole_table(documents):
    df, docs = documents
    want = brute.near_groups(docs)
    assert ordered(S.near_duplicate_groups(df).collect()) == ordered(want)
    assert len({r[2] for r in want}) < len(want)


def test_simhash_edge(edge, empty):
    df, docs = edge
    assert ordered(S.near_duplicate_groups(df).collect()) == ordered(brute.near_groups(docs))
    assert S.near_duplicate_groups(empty).count() == 0
    kept = S.drop_near_duplicates(df)
    assert kept.columns == df.columns
    groups = dict((r[0], r[2]) for r in brute.near_groups([d for d in docs if d[0] is not None]))
    assert {r["doc_id"] for r in kept.collect()} == {None, *(k for k, v in groups.items() if k == v)}


def test_one_row_of_each_group_stays(spark):
    """Also where ids repeat or are missing: rows are told apart, not ids."""
    a, b, c = (" ".join(f"{k}{i}" for i in range(200)) for k in "abc")
    docs = [(1, a, "y"), (1, a, "y"), (1, a, "z"), (5, a, "y"), (5, b, "y"), (None, a, "y"), (None, c, "y"),
            (None, c, "y"), (7, b, "y")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    kept = [(r["doc_id"], r["text"]) for r in S.drop_near_duplicates(df).collect()]
    assert ordered(kept) == ordered([(1, a), (5, b), (None, c)])


def _closure(prints, pairs):
    parent = {x: x for x in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        parent[root(a)] = root(b)
    return [root(x) for x in sorted(prints)]


@pytest.mark.parametrize("parts", [
    [(list(range(0, 64, 2)), 1), (list(range(1, 64, 2)), 1)],
    [(list(range(20)), 1), (list(range(20, 40)), 0), (list(range(40, 64)), 0)],
    [(list(range(16)), 2), (list(range(16, 32)), 0), (list(range(32, 48)), -1), (list(range(48, 64)), -1)]])
def test_unequal_thresholds_lose_no_link(spark, parts):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    prints = set(seeds.tolist())
    for x in seeds.tolist():  # chains of neighbours, and one dense cluster
        for n in (1, 2, 3, 4, 5):
            x ^= sum(1 << int(b) for b in rng.choice(64, n, replace=False))
            prints.add(x)
    prints |= {int(seeds[0]) ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}
    own = np.array(sorted(prints), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in own.view(np.int64)], "fp long")
    got = [(a % (1 << 64), b % (1 << 64)) for a, b in S.links(df, parts).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in got)
    want = [(int(own[i]), int(own[j])) for i in range(len(own))
            for j in np.flatnonzero(np.bitwise_count(own[:i] ^ own[i]) <= 3)]
    groups = [_closure(prints, x) for x in (got, want)]
    assert len(set(groups[0])) == len(set(groups[1])) == len(set(zip(*groups, strict=True)))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.floats(0, 100), min_size=5, max_size=5), min_size=1, max_size=4), st.integers(0, 3))
def test_allocation_is_the_cheapest(costs, distance):
    import itertools
    total = distance - len(costs) + 1
    cost, chosen = S.allocate(costs, total)
    ways = [t for t in itertools.product(range(-1, 4), repeat=len(costs)) if sum(t) == total]
    assert sum(chosen) == total
    assert cost == pytest.approx(min(sum(c[t + 1] for c, t in zip(costs, way, strict=True)) for way in ways))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, x) for x in range(200, 260)] + [(7, 7), (9, 8), (8, 9)]
    got = {r["node"]: r["component"] for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[x] == 5 for x in range(200, 260))
    assert got[9] == got[8] == 8 and 7 not in got
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_line_dedup_shuffles_texts_once(spark):
    """Both joins of the texts read one exchange; a null text and repeated rows stay as they are."""
    from tidemark.llm.lines import line_report
    passage = "\n".join(f"line {i} of a shared passage" for i in range(12))
    rows = [(1, f"own start\n{passage}\nown end"), (2, f"other start\n{passage}\nother end"), (3, None), (4, ""), (None, None), (5, passage)]
    found = line_report(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = sorted(((r.doc_id, r.n_lines, r.n_removed) for r in found.collect()), key=str)
    assert [g for g in got if g[0] in (1, 3, 4, None)] == [(1, 14, 0), (3, 0, 0), (4, 1, 0), (None, 0, 0)]
    assert all(g[2] > 0 for g in got if g[0] in (2, 5))
    assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()
