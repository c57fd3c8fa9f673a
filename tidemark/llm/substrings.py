"""Substring dedup with difference-cover anchors.

Every text position p whose remainder p mod 21 lies in a difference cover is an anchor.
For two equal windows of 35 words, whatever their places, some shift below 21 moves both
window starts onto anchors, and the 15 words from there lie in both windows. So a window
can only repeat where it holds an anchor that repeats: anchors are hashed and counted
globally, the windows around those that repeat are hashed in full (the match extended to
its whole length), and these are counted globally in turn.

Documents are dealt over buckets of a bounded number of bytes. A bucket sends each
different hash once, as sorted hashes packed per range of hash values; a range holds a
bounded share of all. So a passage that every document holds makes at most one entry per
bucket, and no group grows with the number of its copies.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.store import staged
from tidemark.llm.words import SPACES, slices, span_hashes, text_bytes, word_spans

WINDOW = 35
#: A perfect difference set: every difference modulo 21 is one of two of its members.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
BUCKET_BYTES = 8 << 20
#: Rows of one id and length that fill more buckets than these are dealt by a number of their own.
HOT_BUCKETS = 2

_ANCHOR_BASE, _WINDOW_BASE, _CHECK_BASE = 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3
_PACKED = "range int, bucket int, n_twice int, hashes binary, checks binary"


def _words(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a bucket's texts, and the number of each text's first word."""
    body, offsets = text_bytes(table.column("text"))
    hashes, firsts, n = [np.zeros(0, np.uint64)], [], 0
    for i, j in slices(offsets):
        data, at = body[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        starts, ends, first = word_spans(data, at, SPACES)
        hashes.append(span_hashes(data, starts, ends))
        firsts.append(first[:-1] + n)
        n += len(starts)
    return np.concatenate(hashes), np.concatenate([*firsts, [n]]).astype(np.int64)


def _places(first: np.ndarray, span: int, least: int) -> np.ndarray:
    """Word numbers from which ``span`` words lie in one text of at least ``least`` words."""
    size = np.diff(first)
    inside = np.zeros(int(first[-1]) + 1, np.int32)
    fits = size >= max(span, least)
    np.add.at(inside, first[:-1][fits], 1)
    np.subtract.at(inside, first[1:][fits] - span + 1, 1)
    return np.flatnonzero(np.cumsum(inside[:-1]))


def _anchors(words: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    span = window - PERIOD + 1
    at = _places(first, span, window)
    own = at - first[np.searchsorted(first, at, "right") - 1]
    at = at[np.isin(own % PERIOD, COVER)]
    return at, span_hashes(words, at, at + span, _ANCHOR_BASE)


def _windows(words: np.ndarray, first: np.ndarray, window: int,
             anchors: np.ndarray, repeats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that hold an anchor that repeats: starts, hashes and 32 check bits."""
    shared = np.zeros(len(words) + 1, np.int64)
    shared[anchors[repeats] + 1] = 1
    shared = np.cumsum(shared)
    at = _places(first, window, window)
    at = at[shared[at + PERIOD] > shared[at]]
    return (at, span_hashes(words, at, at + window, _WINDOW_BASE),
            (span_hashes(words, at, at + window, _CHECK_BASE) >> np.uint64(32)).astype(np.uint32))


def _counts(hashes: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of one of each, counts, number of each entry's own)."""
    order = np.lexsort((checks, hashes))
    h, c = hashes[order], checks[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
    number = np.empty(len(h), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], np.diff(np.concatenate([np.flatnonzero(new), [len(h)]])), number


def _member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    if not len(of):
        return np.zeros(len(values), bool)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values


def _pack(bucket: int, ranges: int, hashes: np.ndarray, checks: np.ndarray) -> pa.Table:
    """A bucket's different hashes, by range; those it holds twice or more come first."""
    one, count, _ = _counts(hashes, checks)
    h, c, twice = hashes[one], checks[one], count > 1
    where = ((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    order = np.lexsort((~twice, where))
    h, c, twice, where = h[order], c[order], twice[order], where[order]
    edge = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]])) if len(h) else np.zeros(0, int)
    ends = np.concatenate([edge[1:], [len(h)]])
    parts = list(zip(edge.tolist(), ends.tolist(), strict=True)) if len(h) else []
    return pa.table({
        "range": pa.array([int(where[s]) for s, _ in parts], pa.int32()),
        "bucket": pa.array([bucket] * len(parts), pa.int32()),
        "n_twice": pa.array([int(twice[s:e].sum()) for s, e in parts], pa.int32()),
        "hashes": pa.array([h[s:e].tobytes() for s, e in parts], pa.binary()),
        "checks": pa.array([c[s:e].tobytes() if c.any() else b"" for s, e in parts], pa.binary())})


def _joined(column: pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    raw = column.to_pylist()
    one = np.frombuffer(b"".join(raw), kind)
    return one, np.array([len(x) // np.dtype(kind).itemsize for x in raw], np.int64)


def _settle(packed: DataFrame, repeated: bool) -> DataFrame:
    """For each bucket, those hashes it holds once that others hold too (or that no other holds)."""
    def settle(table: pa.Table) -> pa.Table:
        hashes, size = _joined(table.column("hashes"), "<u8")
        checks, some = _joined(table.column("checks"), "<u4")
        if not some.sum():
            checks = np.zeros(len(hashes), np.uint32)
        twice = np.array(table.column("n_twice").to_pylist(), np.int64)
        begin = np.cumsum(size) - size
        known = np.arange(len(hashes)) - np.repeat(begin, size) < np.repeat(twice, size)
        _, count, number = _counts(hashes, checks)
        told = ~known & ((count[number] > 1) == repeated)
        rows = [(b, hashes[s:s + n][told[s:s + n]]) for b, s, n in
                zip(table.column("bucket").to_pylist(), begin.tolist(), size.tolist(), strict=True)]
        rows = [(b, x.tobytes()) for b, x in rows if len(x)]
        return pa.table({"bucket": pa.array([b for b, _ in rows], pa.int32()),
                         "settled": pa.array([x for _, x in rows], pa.binary())})

    return packed.groupBy("range").applyInArrow(settle, "bucket int, settled binary")


def _known(hashes: np.ndarray, checks: np.ndarray, settled: np.ndarray, repeated: bool) -> np.ndarray:
    """Which entries repeat: twice in the bucket, or told so (or not told otherwise)."""
    _, count, number = _counts(hashes, checks)
    return (count[number] > 1) | (_member(hashes, np.sort(settled)) == repeated)


def _candidates(docs: pa.Table, told: np.ndarray, window: int):
    words, first = _words(docs)
    at, hashes = _anchors(words, first, window)
    return first, _windows(words, first, window, at, _known(hashes, np.zeros(len(hashes), np.uint32), told, True))


def repeated_words(docs: DataFrame, window: int = WINDOW, bucket_bytes: int = BUCKET_BYTES,
                   with_text: bool = False) -> DataFrame:
    """Remove the words of every window of ``window`` words that starts in two places or more.

    Returns doc_id, n_words, n_removed, kept_sha256 (and kept_text, if asked for), a row for
    each row of ``docs``, whatever its doc_id; null and empty texts have no words. Windows
    are judged on the input; equality is that of 96 bits of hash over whole windows.
    """
    if window < PERIOD:
        raise ValueError(f"a window holds at least {PERIOD} words")
    n = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, -(-n // bucket_bytes))
    dealt = [F.col("doc_id"), F.octet_length("text")]
    together = docs.groupBy(*dealt).agg(F.sum(F.octet_length("text")).alias("n")).agg(F.max("n")).first()[0] or 0
    rows = docs.select("doc_id", "text")
    if together > HOT_BUCKETS * bucket_bytes:
        # Many rows of one id (or none) and one length: stored with a number, by which they are dealt, too.
        rows = staged(rows.withColumn("number", F.monotonically_increasing_id()), "rows")
        dealt.append(F.col("number"))
    rows = rows.select(F.pmod(F.xxhash64(*dealt), F.lit(buckets)).cast("int").alias("bucket"), "doc_id", "text")

    def anchors(table: pa.Table) -> pa.Table:
        words, first = _words(table)
        _, hashes = _anchors(words, first, window)
        return _pack(table.column("bucket")[0].as_py(), buckets, hashes, np.zeros(len(hashes), np.uint32))

    def windows(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({f.name: pa.array([], pa.binary() if f.name in ("hashes", "checks") else pa.int32())
                             for f in T._parse_datatype_string(_PACKED)})
        settled, _ = _joined(told.column("settled"), "<u8")
        _, (_, hashes, checks) = _candidates(table, settled, window)
        return _pack(table.column("bucket")[0].as_py(), buckets, hashes, checks)

    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
                          + [T.StructField("kept_text", T.StringType())] * with_text)

    def remove(table: pa.Table, told: pa.Table) -> pa.Table:
        kinds = np.array(told.column("windows").to_pylist(), bool)
        settled = [_joined(told.filter(pa.array(kinds == k)).column("settled"), "<u8")[0] for k in (False, True)]
        first, (at, hashes, checks) = _candidates(table, settled[0], window)
        at = at[_known(hashes, checks, settled[1], False)]
        gone = np.zeros(int(first[-1]) + 1, np.int32)
        np.add.at(gone, at, 1)
        np.subtract.at(gone, at + window, 1)
        gone = np.cumsum(gone[:-1]) > 0
        body, offsets = text_bytes(table.column("text"))
        removed, digest, text = [], [], []
        for i in range(len(first) - 1):
            own = body[offsets[i]:offsets[i + 1]].tobytes().split()
            lost = gone[first[i]:first[i + 1]]
            n_lost = int(lost.sum())
            if n_lost:
                own = [w for w, x in zip(own, lost.tolist(), strict=True) if not x]
            kept = b" ".join(own)
            removed.append(n_lost)
            digest.append(hashlib.sha256(kept).hexdigest())
            if with_text:
                text.append(kept.decode())
        out = [table.column("doc_id"), pa.array(np.diff(first)), pa.array(removed, pa.int64()),
               pa.array(digest, pa.string())]
        return pa.table(dict(zip(schema.names, out + [pa.array(text, pa.string())] * with_text, strict=True)))

    shared = _settle(rows.groupBy("bucket").applyInArrow(anchors, _PACKED), True)
    full = rows.groupBy("bucket").cogroup(shared.groupBy("bucket")).applyInArrow(windows, _PACKED)
    told = shared.withColumn("windows", F.lit(False)).union(_settle(full, False).withColumn("windows", F.lit(True)))
    return rows.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(remove, schema)
