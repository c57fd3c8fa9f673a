"""Token counts by field and section, from one encoding of each whole document.

The fields of a document are joined and encoded once; each token's character span is then
joined with the spans of the sections (lines) of the fields. A token that crosses a
boundary goes to one section by an explicit rule, so the counts of a document add up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.store import map_arrow
from tidemark.llm.tokens import Encoder, encoder, vocabulary_path

FIELDS, SEPARATOR = ("source", "text"), " "
#: Where a token that crosses a boundary counts: in the section with most of its characters (the
#: earlier one of equals), the first, or the last one that it touches.
RULES = ("largest", "first", "last")


def section_starts(values: Sequence[str], separator: str) -> tuple[list[int], list[int], list[int]]:
    """(field, number in the field, first character) of each section of the joined fields.

    A line holds the line end that closes it, the last line of a field the separator after it.
    """
    field, number, start, at = [], [], [], 0
    for f, value in enumerate(values):
        own = at
        for k, line in enumerate(value.split("\n")):
            field.append(f)
            number.append(k)
            start.append(own)
            own += len(line) + 1
        at += len(value) + len(separator)
    return field, number, start


def token_spans(text: str, ids: list[int], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end of each token; a token that holds a part of a character holds it."""
    raw = np.frombuffer(text.encode(), np.uint8)
    ends = np.cumsum(sizes[ids]) if ids else np.zeros(0, np.int64)
    if len(raw) == len(text):
        return ends - sizes[ids] if ids else ends, ends
    character = np.cumsum((raw & 0xC0) != 0x80) - 1  # of each byte
    return character[ends - sizes[ids]], character[ends - 1] + 1


def allocate(starts: np.ndarray, ends: np.ndarray, sections: np.ndarray,
             rule: str = RULES[0]) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token, and whether the token crosses a boundary; sections by their
    first characters (those of no length never get a token)."""
    first = np.searchsorted(sections, starts, "right") - 1
    last = np.searchsorted(sections, np.maximum(ends - 1, starts), "right") - 1
    crosses = first != last
    if rule == "last":
        return last, crosses
    chosen = first.copy()
    if rule == "largest":
        for i in np.flatnonzero(crosses):
            bounds = np.concatenate([[starts[i]], sections[first[i] + 1:last[i] + 1], [ends[i]]])
            chosen[i] = first[i] + int(np.argmax(np.diff(bounds)))
    return chosen, crosses


def token_counts(docs: DataFrame, fields: Sequence[str] = FIELDS, separator: str = SEPARATOR,
                 rule: str = RULES[0], path: str | None = None) -> DataFrame:
    """A row per section: doc_id, field, section (from 0), start, end, n_tokens, n_crossing.

    start and end are characters of the joined fields, n_crossing counts the tokens of the
    section that cross one of its boundaries. A null field is empty and makes one section;
    repeated rows, null ids and empty documents (of no tokens) come out like any others.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    path, names = path or vocabulary_path(), list(fields)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("field", T.StringType()),
                           T.StructField("section", T.IntegerType()),
                           *[T.StructField(n, T.LongType()) for n in ("start", "end", "n_tokens", "n_crossing")]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Encoder = encoder(path)
        sizes = np.array([len(x) for x in known.token_bytes])
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                row, field, number, start, end, tokens, crossing = [], [], [], [], [], [], []
                for i, values in enumerate(zip(*[part.column(k + 1).to_pylist() for k in range(len(names))],
                                               strict=True)):
                    values = [v or "" for v in values]
                    text = separator.join(values)
                    own_field, own_number, own_start = section_starts(values, separator)
                    spans = token_spans(text, known.ids(text), sizes)
                    chosen, crosses = allocate(*spans, np.array(own_start), rule)
                    n = len(own_start)
                    row += [i] * n
                    field += [names[f] for f in own_field]
                    number += own_number
                    start += own_start
                    end += [*own_start[1:], len(text)]
                    tokens.append(np.bincount(chosen, minlength=n))
                    crossing.append(np.bincount(chosen[crosses], minlength=n))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int64())), pa.array(field, pa.string()),
                     pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(end, pa.int64()),
                     *[pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for x in (tokens, crossing)]],
                    names=schema.names)

    return map_arrow(docs.select("doc_id", *[F.col(f).cast("string") for f in names]), count, schema)
