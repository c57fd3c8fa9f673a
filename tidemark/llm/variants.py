"""Spelling variant grouping: words one edit apart, found through pivotal bigrams.

Every word's bigrams are ordered by rarity; the rarest three occurrences are its prefix (of each
bigram there, its first and last place), and two disjoint ones of them, chosen by dynamic
programming, its pivots. One edit
leaves one of two disjoint pivots as it was, so of two words an edit apart one's pivot stands in
the other's prefix: at the same distance from the start if the edit comes after it, from the end
if it comes before. Index and probes carry that position limit in their key, with a hash of what
must be equal there: all before (or behind) the pivot, and one half of the rest.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import map_arrow, staged

MIN_LENGTH, MIN_USES = 7, 2
#: One in so many (document, run) pairs loses a code point, chosen by its CRC-32.
CLASSES = 31
#: A form has at least so many times the uses of the word it replaces.
FORM_RATIO = 10
#: One edit breaks at most two bigrams, so three hold one that it leaves, and two disjoint ones.
PREFIX_GRAMS = 3
HELD_WORDS = 500_000
SENT_BYTES = 1 << 24

_RUNS = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_PRIME, _BASE = (1 << 61) - 1, 0x1F0A_96E3_5B77_C9D1


def noisy_words(doc_id: str, text: str, min_length: int = MIN_LENGTH) -> Counter:
    """Uses of the runs of a text, some without a code point, of ``min_length`` code points or more."""
    start, out = zlib.crc32(f"{doc_id}:".encode()), Counter()
    for run, n in Counter(_RUNS.findall(text.translate(_LOWER))).items():
        if len(run) < min_length:
            continue
        h = zlib.crc32(run.encode(), start)
        if not h % CLASSES:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < min_length:
                continue
        out[run] += n
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def sent() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                          names=["word", "n"])

    for batch in batches:
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held.update(noisy_words(doc_id, text))
            if len(held) >= HELD_WORDS:
                yield sent()
                held = Counter()
    if held:
        yield sent()


def word_counts(docs: DataFrame, min_uses: int = MIN_USES) -> DataFrame:
    """word, n of all words with ``min_uses`` or more; counts are added up in each task first."""
    rows = docs.filter("text is not null").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    return map_arrow(rows, _counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") >= min_uses)


class Grams:
    """Rarity of the bigrams of an alphabet: at most the square of its 90 letters."""

    def __init__(self, counts: dict[str, int]):
        self.order = {g: k for k, g in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}
        first, second = Counter(), Counter()
        for g, n in counts.items():
            first[g[0]] += n
            second[g[1]] += n
        self.after = {g: log(n / first[g[0]]) for g, n in counts.items()}
        self.before = {g: log(n / second[g[1]]) for g, n in counts.items()}

    def prefix(self, word: str) -> tuple[list[int], list[int]]:
        """First and last places of each of the rarest bigrams, of which the word has three or more
        occurrences; at most three bigrams. What is equal up to a first place has its first place there too."""
        order = [self.order[word[i:i + 2]] for i in range(len(word) - 1)]
        last = sorted(order)[min(PREFIX_GRAMS, len(order)) - 1]
        rare = [i for i, o in enumerate(order) if o <= last]
        return sorted({order[i]: i for i in reversed(rare)}.values()), sorted({order[i]: i for i in rare}.values())

    def pivots(self, word: str) -> tuple[int, int]:
        """Two disjoint bigrams of the prefix with the fewest words expected behind their keys.

        Dynamic programming over the places: the best first pivot that ends before each second one.
        A key's list is estimated as the chance of its letters under the bigram counts.
        """
        firsts, lasts = self.prefix(word)
        n, up, down = len(word), [0.0], [0.0]
        for i in range(n - 1):
            up.append(up[-1] + self.after[word[i:i + 2]])
            down.append(down[-1] + self.before[word[n - 2 - i:n - i]])
        found, best, at = None, None, 0
        for b in lasts:
            while at < len(firsts) and firsts[at] <= b - 2:
                cost = exp(up[firsts[at] + 1])
                if best is None or cost < best[0]:
                    best = (cost, firsts[at])
                at += 1
            if best is not None:
                cost = best[0] + exp(down[n - 1 - b])
                if found is None or cost < found[0]:
                    found = (cost, best[1], b)
        return found[1], found[2]


class _Spans:
    """Hashes of the parts of a word, each in constant time."""

    def __init__(self, word: str):
        run, power = [0], [1]
        for c in word:
            run.append((run[-1] * _BASE + ord(c)) % _PRIME)
            power.append(power[-1] * _BASE % _PRIME)
        self.run, self.power = run, power

    def of(self, i: int, j: int) -> int:
        return (self.run[j] - self.run[i] * self.power[j - i]) % _PRIME


def _key(*parts: int) -> int:
    h = 0x9E37_79B9_7F4A_7C15
    for p in parts:
        h = (h ^ p) * 0xFF51_AFD7_ED55_8CCD & 0xFFFF_FFFF_FFFF_FFFF
        h ^= h >> 32
    return h - (1 << 63)


def index_keys(word: str, grams: Grams) -> set[int]:
    """Keys under which a word is listed: four for each bigram of its prefix at most."""
    n, s, out = len(word), _Spans(word), set()
    firsts, lasts = grams.prefix(word)
    for j in firsts:
        end = j + 2
        half = end + (n - end) // 2
        out.add(_key(1, n, j, s.of(0, half)))                      # as it is up to the half of what follows
        out.add(_key(2, n, j, s.of(0, end), s.of(half, n)))        # up to the bigram, and behind that half
    for j in lasts:
        half, back = j // 2, n - j
        out.add(_key(3, n, back, s.of(j, n), s.of(0, half)))       # from the bigram on, and up to the half before it
        out.add(_key(4, n, back, s.of(half, n)))                   # from that half on
    return out


def probe_keys(word: str, grams: Grams) -> set[int]:
    """Keys under which the words one edit away from a word are listed that hold one of its pivots."""
    n, s, out = len(word), _Spans(word), set()
    p, q = grams.pivots(word)
    for m in (n - 1, n, n + 1):  # the other word's length
        end, rest = p + 2, m - p - 2
        if rest >= 0:            # the edit comes after the first pivot
            half, tail = rest // 2, rest - rest // 2
            if end + half <= n:
                out.add(_key(1, m, p, s.of(0, end + half)))
            if tail <= n - end:
                out.add(_key(2, m, p, s.of(0, end), s.of(n - tail, n)))
        back, rest = n - q, m - (n - q)
        if rest >= 0:            # the edit comes before the second one
            half = rest // 2
            if half <= q:
                out.add(_key(3, m, back, s.of(q, n), s.of(0, half)))
            if rest - half <= q:
                out.add(_key(4, m, back, s.of(n - back - (rest - half), n)))
    return out


def _keyed(words: DataFrame, grams: Grams, keys: Callable[[str, Grams], set[int]]) -> DataFrame:
    handle = words.sparkSession.sparkContext.broadcast(grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = handle.value
        for batch in batches:
            rows, found, size = [], [], 0
            for i, word in enumerate(batch.column(0).to_pylist()):
                own = keys(word, grams)
                rows += [i] * len(own)
                found += own
                size += len(own) * (len(word) + 16)
                if size > SENT_BYTES or i + 1 == batch.num_rows:
                    at = pa.array(rows, pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), batch.column(0).take(at),
                                                      batch.column(1).take(at)], names=["key", "word", "n"])
                    rows, found, size = [], [], 0

    return map_arrow(words.select("word", "n"), run, "key long, word string, n long")


def near_words(words: DataFrame) -> DataFrame:
    """word, n, other, n_other for every two words (columns word, n; distinct) exactly one edit apart, both ways."""
    pairs = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(2)))
    counts = words.select(F.explode(pairs).alias("gram")).groupBy("gram").count().collect()
    grams = Grams({r["gram"]: r["count"] for r in counts})
    listed = _keyed(words, grams, index_keys).withColumnsRenamed({"word": "other", "n": "n_other"})
    met = _keyed(words, grams, probe_keys).join(listed, "key").filter(
        (F.col("word") != F.col("other")) & (F.levenshtein("word", "other", 1) == 1))
    met = met.select("word", "n", "other", "n_other")
    back = met.select(F.col("other").alias("word"), F.col("n_other").alias("n"),
                      F.col("word").alias("other"), F.col("n").alias("n_other"))
    return met.unionByName(back).distinct()


def _roots(forms: DataFrame, longest: int) -> DataFrame:
    """word, root: the last form that is reached from each word that has one, by doubling the steps.

    Uses grow tenfold with each form, so chains end, and ``longest`` bounds their length.
    """
    reach, steps = forms.select("word", F.col("form").alias("root")), 1
    while steps < longest:
        on = reach.select(F.col("word").alias("root"), F.col("root").alias("next"))
        reach = staged(reach.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root")), "variant-roots")
        steps *= 2
    return reach


def spelling_variants(docs: DataFrame, min_uses: int = MIN_USES, ratio: int = FORM_RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the documents.

    A word is a run of Latin letters (A-Z lower-cased) of 7 code points or more with ``min_uses``
    or more in all texts. ``form`` is the most frequent word one edit away (ties: the smallest) if
    it has ``ratio`` times as many uses, else null; ``root`` is the last of the forms from there on.
    A null text has no words, a null doc_id counts as empty text in the checksum; repeated rows
    count each. Tables without words give no rows. Runs of any length are words like others.
    """
    words = staged(word_counts(docs, min_uses), "variant-words")
    near = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_other")).alias("uses"), "other")).alias("most"))
    own = staged(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        *[F.when(-F.col("most.uses") >= F.lit(ratio) * F.col("n"), c).alias(a)
          for c, a in ((F.col("most.other"), "form"), (-F.col("most.uses"), "form_n"))]), "variant-forms")
    most = words.agg(F.max("n")).first()[0] or 0
    longest = 0
    while most >= min_uses * ratio ** (longest + 1):
        longest += 1
    roots = _roots(own.filter("form is not null").select("word", "form"), longest)
    return own.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
