"""Benchmark decontamination with a generalised suffix automaton.

The words of all benchmark items form one automaton of their substrings. Training words
are streamed through it; the length of the longest match that ends at each word tells
which windows of items occur there. Only runs of words whose neighbouring pairs occur in
some item can match anything, so whole batches are cut down to such runs first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.store import carried, map_arrow, staged, unpacked
from tidemark.llm.words import (LOWER, NOT_ALNUM, slices, span_hashes, text_bytes, word_spans)

WINDOW = 10
#: Benchmark words in one automaton; more are scanned as several, one after another.
SHARD_WORDS = 2_000_000
MAX_COVERAGE = 0.5

SPANS = "array<struct<first:int,end:int>>"


@dataclass
class Automaton:
    """Suffix automaton of several word sequences; state 0 is the empty match."""

    window: int
    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    #: Items with the window of a state; items shorter than a window, by their own state.
    items: dict[int, set[str]] = field(default_factory=dict)
    short: dict[tuple[int, int], set[str]] = field(default_factory=dict)
    short_lengths: dict[int, list[int]] = field(default_factory=dict)

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of state q for its strings of up to length[p] + 1."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def add(self, words: list[int]) -> None:
        last = 0
        for c in words:
            q = self.next[last].get(c)
            if q is not None:  # this prefix occurred before
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
                continue
            new, p = self._state(self.length[last] + 1, 0, {}), last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
            last = new

    def step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        """The longest match that ends with ``word``, from the one that ended before it."""
        while word not in self.next[state]:
            if not state:
                return 0, 0
            state = self.link[state]
            matched = self.length[state]
        return self.next[state][word], matched + 1

    def window_state(self, state: int) -> int:
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def mark(self, item: str, words: list[int]) -> None:
        """Note the item at the states of its windows; after all items were added."""
        state = matched = 0
        for c in words:
            state, matched = self.step(state, matched, c)
            if matched >= self.window:
                self.items.setdefault(self.window_state(state), set()).add(item)
        if 0 < len(words) < self.window:
            while self.length[self.link[state]] >= len(words):
                state = self.link[state]
            self.short.setdefault((state, len(words)), set()).add(item)
            if len(words) not in self.short_lengths.setdefault(state, []):
                self.short_lengths[state].append(len(words))

    def scan(self, words: list[int]) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, end, items) of each place where windows occur in ``words``."""
        state = matched = 0
        by_state = self.short_lengths
        for i, c in enumerate(words):
            state, matched = self.step(state, matched, c)
            if matched >= self.window:
                yield i + 1 - self.window, i + 1, self.items[self.window_state(state)]
            s = state if by_state else 0
            while s:
                for n in by_state.get(s, ()):
                    if n <= matched:
                        yield i + 1 - n, i + 1, self.short[s, n]
                s = self.link[s]


@dataclass
class Index:
    """What a task needs to scan texts: words, pairs of words and the automaton."""

    automaton: Automaton
    ids: dict[bytes, int]
    hashes: np.ndarray  # sorted, of the words in ids
    pairs: np.ndarray  # sorted: number of a word's hash * words + number of the next one's
    least: int  # words in the shortest window


def normalised(text: str | None) -> list[bytes]:
    """The words of one text: A-Z lower-cased, runs of digits, a-z and non-ASCII bytes."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return LOWER[np.where(NOT_ALNUM[LOWER[raw]], 0x20, raw)].tobytes().split(b" ") if len(raw) else []


def build_index(items: list[tuple[str, str | None]], window: int = WINDOW) -> Index:
    ids: dict[bytes, int] = {}
    texts = [(item, [ids.setdefault(w, len(ids)) for w in normalised(text) if w]) for item, text in items]
    automaton = Automaton(window)
    for _, words in texts:
        automaton.add(words)
    for item, words in texts:
        automaton.mark(item, words)
    body = np.frombuffer(b"".join(ids), np.uint8)
    ends = np.cumsum([len(w) for w in ids], dtype=np.int64)
    hashes = span_hashes(body, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends)
    order = np.argsort(hashes)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    pairs = [rank[words[:-1]] * len(ids) + rank[words[1:]] for _, words in texts if len(words) > 1]
    return Index(automaton, ids, hashes[order], np.unique(np.concatenate([np.zeros(0, np.int64), *pairs])),
                 min([min(len(words), window) for _, words in texts if words], default=0))


def candidate_runs(index: Index, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of words, at least a window long, in which each pair of neighbours occurs in an item."""
    n = len(hashes)
    if not n or not index.least:
        return
    at = np.minimum(np.searchsorted(index.hashes, hashes), len(index.hashes) - 1)
    known = index.hashes[at] == hashes
    linked = known[:-1] & known[1:]
    linked[first[(first > 0) & (first < n)] - 1] = False
    both = np.flatnonzero(linked)
    code = at[both] * len(index.hashes) + at[both + 1]
    if len(index.pairs):
        place = np.minimum(np.searchsorted(index.pairs, code), len(index.pairs) - 1)
        linked[both] = index.pairs[place] == code
    else:
        linked[:] = False
    edge = np.diff(np.concatenate([[0], linked.view(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
    if index.least == 1:  # single words match too
        alone = known & ~np.concatenate([linked, [False]]) & ~np.concatenate([[False], linked])
        begin, end = np.concatenate([begin, np.flatnonzero(alone)]), np.concatenate([end, np.flatnonzero(alone) + 1])
        order = np.argsort(begin)
        begin, end = begin[order], end[order]
    long = end - begin >= index.least
    yield from zip(begin[long].tolist(), end[long].tolist(), strict=True)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def scan_texts(column: pa.Array, index: Index) -> Iterator[tuple[int, list[tuple[int, int]], list[tuple[int, int]], set[str]]]:
    """For each text: number of words, hit word spans, their byte spans, items found."""
    body, offsets = text_bytes(column)
    for i, j in slices(offsets):
        data, at = LOWER[body[offsets[i]:offsets[j]]], offsets[i:j + 1] - offsets[i]
        starts, ends, first = word_spans(data, at, NOT_ALNUM)
        hashes = span_hashes(data, starts, ends)
        spans: dict[int, list[tuple[int, int]]] = {}
        found: dict[int, set[str]] = {}
        raw = data.tobytes()
        for begin, end in candidate_runs(index, hashes, first):
            words = [index.ids.get(raw[s:e], -1) for s, e in zip(starts[begin:end], ends[begin:end], strict=True)]
            doc = int(np.searchsorted(first, begin, "right")) - 1
            for s, e, items in index.automaton.scan(words):
                spans.setdefault(doc, []).append((begin + s, begin + e))
                found.setdefault(doc, set()).update(items)
        for k in range(j - i):
            hit = merged(spans.get(k, []))
            bytes_hit = [(int(starts[s] - at[k]), int(ends[e - 1] - at[k])) for s, e in hit]
            yield (int(first[k + 1] - first[k]), [(s - int(first[k]), e - int(first[k])) for s, e in hit],
                   bytes_hit, found.get(k, set()))


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    raw, out, at = text.encode(), [], 0
    for s, e in spans:
        out.append(raw[at:s])
        at = e
    return b"".join([*out, raw[at:]]).decode()


_RESULT = T.StructType([T.StructField("n_words", T.LongType()),
                        T.StructField("spans", T.ArrayType(T.StructType(
                            [T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
                        T.StructField("byte_spans", T.ArrayType(T.StructType(
                            [T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
                        T.StructField("items", T.ArrayType(T.StringType()))])


def _scan(rows: DataFrame, index_of) -> DataFrame:
    """Adds the columns of ``_RESULT`` to rows that have a column ``text``."""
    schema = T.StructType([*rows.schema, *_RESULT])
    where = rows.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_of.value
        pair = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            n, spans, raw, items = zip(*scan_texts(batch.column(where), index), strict=True) \
                if batch.num_rows else ([], [], [], [])
            as_rows = [[[{"first": s, "end": e} for s, e in x] for x in column] for column in (spans, raw)]
            out = [pa.array(n, pa.int64()), pa.array(as_rows[0], pair), pa.array(as_rows[1], pair),
                   pa.array([sorted(x) for x in items], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=schema.names)

    return map_arrow(rows, scan, schema)


def benchmark_windows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                      shard_words: int = SHARD_WORDS, keep_text: bool = True) -> DataFrame:
    """Where windows of benchmark items occur in texts.

    ``docs`` has a column ``text``; added are n_words, spans (words hit: first and end,
    merged), byte_spans (the same in UTF-8 bytes) and items (sorted ids). ``benchmark``
    has item_id and text; an item of fewer words than a window is one window, one without
    words none; a null item_id is the empty string. The benchmark is counted first and
    split into shards of about ``shard_words`` words, so that no task holds more; several
    shards are scanned one after another over a stored table.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    words = items.agg(F.coalesce(F.sum(F.length("text") / 2), F.lit(0.0))).first()[0]
    shards = max(1, int(-(-words // shard_words)))
    out = docs
    for shard in range(shards):
        own = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(shards)) == shard)
        index = spark.sparkContext.broadcast(build_index([tuple(r) for r in own.collect()], window))
        if not shard:
            out = _scan(out, index)
            continue
        before = staged(out.withColumns({f"_{c}": F.col(c) for c in _RESULT.names}).drop(*_RESULT.names), "scanned")
        out = _scan(before, index)
        for c in ("spans", "byte_spans", "items"):
            both = F.array_sort(F.array_distinct(F.concat(f"_{c}", c)))
            out = out.withColumn(c, both if c == "items" else _merged_column(both))
        out = out.drop(*[f"_{c}" for c in _RESULT.names])
    return out if keep_text else out.drop("text")


def _merged_column(spans):
    """Sorted spans, those that overlap joined."""
    def join(done, x):
        last = F.element_at(done, -1)
        return (F.when(F.size(done) == 0, F.array(x))
                .when(x["first"] <= last["end"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(
                    F.struct(last["first"].alias("first"), F.greatest(last["end"], x["end"]).alias("end")))))
                .otherwise(F.concat(done, F.array(x))))
    return F.aggregate(spans, F.array().cast(SPANS), join)


def _hit_words():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + (x["end"] - x["first"]))


def window_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256 and contaminated."""
    rows = benchmark_windows(docs.select("doc_id", "text"), benchmark, window, keep_text=False)
    return rows.select("doc_id", "n_words", _hit_words().alias("n_hit"),
                       F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                       (F.size("spans") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """Documents without the passages of benchmark items, all columns kept.

    Every hit span goes out of ``text`` (``n_chars`` follows, where there is one); a
    document of which windows cover more than ``max_coverage`` of the words goes whole.
    Null and empty texts hold no words and stay.
    """
    rows = benchmark_windows(carried(docs, text=F.col("text")), benchmark, window)
    rows = rows.filter(_hit_words() <= F.lit(max_coverage) * F.col("n_words"))
    schema = T.StructType([*rows.drop("n_words", "spans", "items", "byte_spans").schema])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(2).to_pylist()
            text = [without_spans(t, [(x["first"], x["end"]) for x in s]) if s else t
                    for t, s in zip(batch.column(1).to_pylist(), spans, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], names=["row", "text"])

    rows = map_arrow(rows.select("row", "text", "byte_spans"), cut, schema)
    replaced = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        replaced["n_chars"] = F.when(F.col("text") == F.col("row.text"), F.col("row.n_chars")) \
            .otherwise(F.length("text").cast(kind))
    return unpacked(rows, docs.columns, **replaced)
