import itertools

import brute
import numpy as np
import pytest
from brute import ordered
from hypothesis import given, settings
from pyspark.sql import functions as F
from hypothesis import strategies as st

from tidemark.llm import attribution as A
from tidemark.llm import packing as P
from tidemark.llm.tokens import encoder, vocabulary_path


def check_places(rows, capacity):
    """Every sequence is gapless from 0 and within the capacity."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packs_whole_table(documents, tokenizer):
    df, docs = documents
    rows = P.pack_sequences(df).collect()
    assert ordered((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == \
        ordered(brute.pieces(docs, tokenizer))
    lengths = np.array([r["length"] for r in rows])
    bound = P.bin_lower_bound(lengths, 1024)
    assert bound <= check_places(rows, 1024) <= bound * 1.02 + 1


def test_many_partitions_exchange(documents):
    df, _ = documents
    rows = P.pack_sequences(df, capacity=100, pieces_per_partition=40).collect()
    bins, bound = check_places(rows, 100), P.bin_lower_bound(np.array([r["length"] for r in rows]), 100)
    once = P.pack_sequences(df, capacity=100, pieces_per_partition=40, max_rounds=0).collect()
    assert bound <= bins <= check_places(once, 100)


def test_rows_that_share_an_id_spread(spark, tokenizer, monkeypatch):
    """A third of all rows has no id: its pieces are dealt over all partitions."""
    docs = [(None if i % 3 == 0 else i, f"some words {i % 50} " * (1 + i % 7)) for i in range(1500)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    seen, pack = [], P._pack_partitions

    def watched(pieces, *more):
        out = pack(pieces, *more)
        seen.append(out.groupBy("part").count().agg(F.min("count"), F.max("count"), F.count("*")).first())
        return out

    monkeypatch.setattr(P, "_pack_partitions", watched)
    rows = P.pack_sequences(df, capacity=200, pieces_per_partition=100).collect()
    assert ordered((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == \
        ordered(brute.pieces(docs, tokenizer, 200))
    check_places(rows, 200)
    assert seen[0][2] >= 15 and seen[0][1] < 3 * 100


def test_edge_documents(edge, empty, tokenizer):
    df, docs = edge
    rows = P.pack_sequences(df, with_ids=True).collect()
    assert ordered((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == \
        ordered(brute.pieces(docs, tokenizer))
    assert all(len(r["ids"]) == r["length"] for r in rows)
    check_places(rows, 1024)
    assert P.pack_sequences(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=7))
def test_bound_never_exceeds_the_optimum(sizes):
    def optimum(left, bins):
        if not left:
            return len(bins)
        best = len(sizes)
        for k in range(len(bins)):
            if bins[k] + left[0] <= 12:
                best = min(best, optimum(left[1:], [*bins[:k], bins[k] + left[0], *bins[k + 1:]]))
        return min(best, optimum(left[1:], [*bins, left[0]]))

    sizes = sorted(sizes, reverse=True)
    best = optimum(sizes, [])
    for fit in (P.best_fit_decreasing, P.best_fit_by_bin):
        bins, offsets = fit(np.array(sizes), 12)
        assert P.bin_lower_bound(np.array(sizes), 12) <= best <= bins.max() + 1
        for b in range(bins.max() + 1):
            own = sorted((o, n) for o, n, k in zip(offsets, sizes, bins, strict=True) if k == b)
            ends = [0, *itertools.accumulate(n for _, n in own)]
            assert [o for o, _ in own] == ends[:-1] and ends[-1] <= 12


def test_best_fit_takes_the_tightest_bin():
    bins, _ = P.best_fit_decreasing(np.array([7, 6, 4, 3]), 10)
    assert bins.tolist() == [0, 1, 1, 0]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aé' \n\t\r1日 .!<|endoftext>", max_size=40))
def test_ids_equal_those_of_the_public_tokenizer(text):
    known = encoder(vocabulary_path())
    assert known.ids(text) == known.slow.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("rule", A.RULES)
def test_counts_by_section(documents, tokenizer, rule):
    df, _ = documents
    rows = A.token_counts(df, rule=rule).collect()
    want = [x for r in df.select("doc_id", *A.FIELDS).collect()
            for x in brute.section_counts(r[0], A.FIELDS, r[1:], tokenizer, rule=rule)]
    assert ordered((r["doc_id"], r["field"], r["section"], r["n_tokens"], r["n_crossing"]) for r in rows) == ordered(want)
    assert any(r["n_crossing"] for r in rows)


def test_counts_of_edge_documents(spark, edge, empty, tokenizer):
    df, docs = edge
    rows = A.token_counts(df, ["text"]).collect()
    want = [x for d, t in docs for x in brute.section_counts(d, ["text"], [t], tokenizer)]
    assert ordered((r["doc_id"], r["field"], r["section"], r["n_tokens"], r["n_crossing"]) for r in rows) == ordered(want)
    assert A.token_counts(empty).count() == 0
    odd = spark.createDataFrame([(1, "é日\n", "\n\n  日本 x\r\n"), (2, None, None)], "doc_id long, source string, text string")
    want = [x for r in odd.collect() for x in brute.section_counts(r[0], A.FIELDS, r[1:], tokenizer)]
    got = A.token_counts(odd).collect()
    assert ordered((r["doc_id"], r["field"], r["section"], r["n_tokens"], r["n_crossing"]) for r in got) == ordered(want)
