"""Language identification with a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on a bounded sample of
labelled texts. It reads every byte of every text, in windows read side by side from both
ends, labels every position, and the mean of a document's position probabilities decides.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.store import carried, map_arrow, unpacked
from tidemark.llm.words import slices, text_bytes

UNKNOWN = "und"
#: Bound of the training sample: texts for each language, texts in all (each of more languages than
#: their quotient gets fewer, one at least), excerpts of each text.
TEXTS_PER_LANGUAGE, TEXTS = 500, 25_000
EXCERPTS, EXCERPT_CHARS = 3, 200
#: Units a direction for up to eight languages; more languages get more.
HIDDEN = 12
#: Bytes of a window; the state starts anew in each, so that windows run side by side.
WINDOW, TRAIN_WINDOW = 128, 64
WINDOWS_AT_ONCE = 2048
STEPS, BATCH, RATE = 250, 128, 0.02
#: How many times as likely as the second language the first one of a kept document is.
MIN_ODDS = 1.2

Weights = dict[str, np.ndarray]


@dataclass
class Model:
    languages: list[str]
    weights: Weights


def _units(languages: int) -> int:
    return max(HIDDEN, 4 * ceil(log2(max(languages, 1))))


def _start(languages: int, seed: int) -> Weights:
    rng, n = np.random.default_rng(seed), _units(languages)
    out: Weights = {}
    for d in "fb":  # forward and backward
        out[f"x{d}"] = rng.normal(0, 0.3, (256, 3 * n)).astype(np.float32)
        out[f"u{d}"] = rng.normal(0, n ** -0.5, (n, 3 * n)).astype(np.float32)
        out[f"v{d}"] = rng.normal(0, n ** -0.5, (n, languages)).astype(np.float32)
    out["c"] = np.zeros(languages, np.float32)
    return out


def _cell(w: Weights, d: str, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step of the gated unit on bytes ``x``: new state, gates, candidate and its recurrent part.

    The first two thirds of the columns are the update and reset gates, written as tanh of half the sum.
    """
    a, b, n = w[f"x{d}"][x], h @ w[f"u{d}"], h.shape[1]
    gates = np.tanh(a[:, :2 * n] + b[:, :2 * n])
    gates *= 0.5
    gates += 0.5
    inner = b[:, 2 * n:]
    candidate = np.tanh(a[:, 2 * n:] + gates[:, n:] * inner)
    return h + gates[:, :n] * (candidate - h), gates, candidate, inner


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=-1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=-1, keepdims=True)
    return logits


def gradients(w: Weights, x: np.ndarray, label: np.ndarray) -> tuple[float, Weights]:
    """Mean loss over all positions of windows ``x`` (time, window) and its gradients."""
    (steps, n), units = x.shape, len(w["uf"])
    trail: dict[str, list] = {}
    states: dict[str, np.ndarray] = {}
    for d, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
        h, trail[d], states[d] = np.zeros((n, units), np.float32), [], np.empty((steps, n, units), np.float32)
        for t in order:
            before = h
            h, gates, candidate, inner = _cell(w, d, x[t], before)
            trail[d].append((t, before, gates, candidate, inner))
            states[d][t] = h
    p = _softmax(states["f"] @ w["vf"] + states["b"] @ w["vb"] + w["c"])
    rows = np.arange(n)
    loss = float(-np.log(np.maximum(p[:, rows, label], 1e-9)).mean())
    p[:, rows, label] -= 1
    p /= steps * n
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    grad["c"] = p.sum((0, 1))
    for d in "fb":
        grad[f"v{d}"] = np.tensordot(states[d], p, ([0, 1], [0, 1]))
        u, dh = w[f"u{d}"], np.zeros((n, units), np.float32)
        for t, before, gates, candidate, inner in reversed(trail[d]):
            dh = dh + p[t] @ w[f"v{d}"].T
            z, r = gates[:, :units], gates[:, units:]
            d_candidate = dh * z * (1 - candidate ** 2)
            # a gate is 0.5 + 0.5 * tanh(s), so its slope in s is 2 * gate * (1 - gate)
            d_sum = np.concatenate([dh * (candidate - before) * 2 * z * (1 - z),
                                    d_candidate * inner * 2 * r * (1 - r), d_candidate], axis=1)
            np.add.at(grad[f"x{d}"], x[t], d_sum)
            d_sum[:, 2 * units:] *= r
            grad[f"u{d}"] += before.T @ d_sum
            dh = dh * (1 - z) + d_sum @ u.T
    return loss, grad


def train(texts: list[tuple[str, str]], steps: int | None = None, seed: int = 7) -> Model:
    """Fit the network to (language, excerpt) pairs; languages are drawn equally often. Beyond eight
    languages the steps grow with the logarithm of their number."""
    languages = sorted({lang for lang, _ in texts})
    if not languages:
        return Model([], {})
    steps = steps or ceil(STEPS * max(1.0, log2(len(languages)) / 3))
    number = {lang: k for k, lang in enumerate(languages)}
    rng = np.random.default_rng(seed)
    windows: list[list[bytes]] = [[] for _ in languages]
    for lang, text in texts:
        raw = text.encode()
        raw = raw * (-(-TRAIN_WINDOW // max(len(raw), 1))) if raw else b" " * TRAIN_WINDOW
        windows[number[lang]] += [raw[i:i + TRAIN_WINDOW] for i in
                                  range(0, len(raw) - TRAIN_WINDOW + 1, TRAIN_WINDOW)]
    tables = [np.frombuffer(b"".join(x), np.uint8).reshape(-1, TRAIN_WINDOW) for x in windows]
    w = _start(len(languages), seed)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        label = rng.integers(0, len(languages), BATCH)
        x = np.stack([tables[k][rng.integers(0, len(tables[k]))] for k in label], axis=1)
        _, grad = gradients(w, x, label)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grad.items():  # Adam
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            w[k] = w[k] - np.float32(rate) * (first[k] / (1 - 0.9 ** step)) / (
                np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model(languages, {k: v.astype(np.float32) for k, v in w.items()})


def _window_probabilities(w: Weights, x: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sum of the position probabilities of each window; ``x`` is (time, window), ``size`` its bytes."""
    (steps, n), units = x.shape, len(w["uf"])
    forward, h = np.empty((steps, n, units), np.float32), np.zeros((n, units), np.float32)
    for t in range(steps):
        forward[t] = h = _cell(w, "f", x[t], h)[0]
    total, h = np.zeros((n, len(w["c"])), np.float32), np.zeros((n, units), np.float32)
    full = int(size.min(initial=steps))
    for t in range(steps - 1, -1, -1):
        h = _cell(w, "b", x[t], h)[0]
        p = _softmax(forward[t] @ w["vf"] + h @ w["vb"] + w["c"])
        if t >= full:  # behind the end of some windows
            inside = (t < size)[:, None]
            h *= inside
            p *= inside
        total += p
    return total


def document_probabilities(model: Model, body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean position probabilities of each text; zeros for one without bytes."""
    length = np.diff(offsets)
    count = -(-length // WINDOW)
    doc = np.repeat(np.arange(len(length)), count)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    begin = offsets[:-1][doc] + number * WINDOW
    size = np.minimum(WINDOW, offsets[1:][doc] - begin)
    order = np.argsort(-size, kind="stable")  # short windows together
    out = np.zeros((len(length), len(model.languages)))
    for at in range(0, len(order), WINDOWS_AT_ONCE):
        own = order[at:at + WINDOWS_AT_ONCE]
        steps = int(size[own].max())
        place = np.minimum(begin[own] + np.arange(steps)[:, None], len(body) - 1)
        np.add.at(out, doc[own], _window_probabilities(model.weights, body[place], size[own]))
    return out / np.maximum(length, 1)[:, None]


def _held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, per_language: int = TEXTS_PER_LANGUAGE, texts: int = TEXTS) -> list[tuple[str, str]]:
    """Excerpts of at most ``per_language`` texts of each language (``texts`` in all, but one of each
    language at least), none of them held out.

    Texts with a letter are chosen by a hash of id and text, so rows that share an id are chosen one by
    one, and rows equal in both count once. Different texts are counted first for every language, and
    only those whose hash is low enough for about three times the number wanted are ranked, so that no
    task ranks a whole language. Rows without an id, a language or a text are not learned from.
    """
    rows = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~_held_out(F.col("doc_id"))
                       & F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("h", F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 33))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()
    if not counts:
        return []
    per_language = max(1, min(per_language, texts // len(counts)))
    # A literal map, made of the languages' counts. Few enough rows for the rank are always all taken.
    low = json.dumps({r["lang"]: min(1 << 31, -(-(3 * per_language + 60) * (1 << 31) // max(r["n"], 1))) for r in counts})
    below = F.try_element_at(F.from_json(F.lit(low), "map<string,bigint>"), "lang")
    room = F.greatest(F.length("text") - EXCERPT_CHARS, F.lit(0)) + 1
    excerpts = F.array(*[F.substring("text", (F.pmod(F.xxhash64("doc_id", F.lit(k)), room) + 1).cast("int"),
                                     F.lit(EXCERPT_CHARS)) for k in range(EXCERPTS)])
    rows = rows.filter(F.col("h") < below).select("lang", "h", excerpts.alias("excerpts")).dropDuplicates(["lang", "h"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "excerpts"))
    found = rows.withColumn("rank", rank).filter(F.col("rank") <= per_language).orderBy("h", "lang", "excerpts").collect()
    return [(r["lang"], x) for r in found for x in r["excerpts"] if x]


def predict(rows: DataFrame, model: Model) -> DataFrame:
    """Adds lang_pred, score and odds (of the first to the second language) to rows that have a column
    ``text``, of which every byte is read. A null text or one without a letter gets ``und``, 0 and 0."""
    handle = rows.sparkSession.sparkContext.broadcast(model)
    rows = rows.withColumn("has_letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    where, letter = rows.columns.index("text"), rows.columns.index("has_letter")
    kept = [i for i in range(len(rows.columns)) if i != letter]
    schema = T.StructType([*rows.drop("has_letter").schema, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("odds", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = handle.value
        for batch in batches:
            lang, score, odds = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            use = np.flatnonzero(batch.column(letter).to_numpy(zero_copy_only=False).astype(bool))
            if len(use) and model.languages:
                body, offsets = text_bytes(batch.column(where).take(pa.array(use)))
                for i, j in slices(offsets):
                    p = document_probabilities(model, body[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                    for k, best in zip(use[i:j].tolist(), p.argmax(axis=1).tolist(), strict=True):
                        lang[k] = model.languages[best]
                    score[use[i:j]] = np.clip(p.max(axis=1), 0.0, 1.0)
                    second = np.sort(p, axis=1)[:, -2] if p.shape[1] > 1 else np.zeros(j - i)
                    odds[use[i:j]] = p.max(axis=1) / np.maximum(second, 1e-9)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], pa.array(lang, pa.string()),
                                              pa.array(score), pa.array(odds)], names=schema.names)

    return map_arrow(rows, run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred and score.

    The model is fitted to documents of which crc32(doc_id) mod 5 is not 0; ``und`` (score 0) stands
    for a null text, one without a letter, and any text where nothing could be learned. A
    null doc_id is neither held out nor learned from.
    """
    model = train(training_sample(docs))
    return predict(docs.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "text"), model).drop("text", "odds")


def keep_identified(docs: DataFrame, min_odds: float = MIN_ODDS) -> DataFrame:
    """Documents whose language is ``min_odds`` times as likely as the second one or more, all columns kept.

    Null texts and those without a letter go, and all where no row has a language to learn from.
    The threshold is relative, so it means the same for any number of languages. Rows that share an
    id, or have none, are judged each by its own text.
    """
    model = train(training_sample(docs))
    rows = predict(carried(docs, text=F.col("text")), model)
    return unpacked(rows.filter((F.col("lang_pred") != UNKNOWN) & (F.col("odds") >= min_odds)), docs.columns)
