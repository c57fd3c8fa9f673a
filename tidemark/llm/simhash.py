"""SimHash near-duplicates by the generalised pigeonhole principle.

Two fingerprints that differ in at most d bits must, for any split of the bits into parts
with thresholds t_1, ..., t_m and sum(t) = d - m + 1, differ in at most t_i bits in some
part i (t_i = -1: the part is never probed). Correlated bits are grouped into one part,
so that the others stay selective; the thresholds are allocated by dynamic programming on
the candidate counts estimated for each part, then all fingerprints are probed and every
candidate is verified.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components
from tidemark.llm.store import carried, map_arrow, row_hash, staged, unpacked
from tidemark.llm.words import LOWER, SPACES, slices, text_bytes, word_spans

BITS = 64
SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
#: Cost of one probe row (shuffle and sort) against one comparison of two fingerprints.
ROW_COST = 200.0
PARTS = (2, 3, 4, 5, 6)
#: Members of a bucket that are compared pair by pair; larger buckets are searched breadth-first.
SMALL_BUCKET = 32

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


#: Shingles hashed at a time, so that a long text needs little more than its own bytes.
SHINGLES_AT_ONCE = 1 << 16


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set."""
    octets = hashes.view(np.uint8).reshape(-1, 8)
    return np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BYTE_BITS for k in range(8)])


def majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the 64-bit hashes."""
    return _majority(bit_counts(hashes), len(hashes)) if len(hashes) else 0


def _majority(ones: np.ndarray, n: int) -> int:
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def text_fingerprints(column: pa.Array, size: int = SHINGLE_WORDS) -> Iterator[int]:
    import xxhash
    body, offsets = text_bytes(column)
    digest = xxhash.xxh64_intdigest
    for i, j in slices(offsets):
        data, at = LOWER[body[offsets[i]:offsets[j]]], offsets[i:j + 1] - offsets[i]
        starts, ends, first = word_spans(data, at, SPACES)
        # Words in a row with one space between them: a shingle is one slice of bytes.
        place = np.concatenate([[0], np.cumsum(ends - starts + 1)])
        joined, filled = np.full(int(place[-1]), 0x20, np.uint8), np.ones(int(place[-1]), bool)
        filled[place[1:] - 1] = False
        joined[filled] = data[~SPACES[data]]
        raw = joined.tobytes()
        del data, joined, filled
        for k in range(j - i):
            lo, hi = int(first[k]), int(first[k + 1])
            if hi - lo < size:
                yield majority(np.array([digest(raw[int(place[lo]):int(place[hi]) - 1], SEED)] if hi > lo else [], np.uint64))
                continue
            ones, n = np.zeros(64, np.int64), hi - lo - size + 1
            for since in range(lo, lo + n, SHINGLES_AT_ONCE):
                upto = min(since + SHINGLES_AT_ONCE, lo + n)
                begin, stop = place[since:upto].tolist(), (place[since + size:upto + size] - 1).tolist()
                hashes = [digest(raw[s:e], SEED) for s, e in zip(begin, stop, strict=True)]
                ones += bit_counts(np.array(hashes, np.uint64))
            yield _majority(ones, n)


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and the 64-bit fingerprint ``fp`` (as a signed long) of each whole text.

    Words are cut at white space, A-Z lower-cased; shingles of ``size`` words, repeats
    included; fewer words make one shingle, none (also null) the fingerprint zero.
    """
    schema = T.StructType([docs.schema["doc_id"], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.fromiter(text_fingerprints(batch.column(1), size), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=schema.names)

    return map_arrow(docs.select("doc_id", "text"), run, schema)


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 counts of bits set together (all rows)."""
    schema = "cell int, n long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            own = np.ascontiguousarray(batch.column(0).to_numpy()).view(np.uint8).reshape(-1, 8)
            for at in range(0, len(own), 1 << 16):
                bits = np.unpackbits(own[at:at + (1 << 16)], axis=1, bitorder="little").astype(np.float32)
                total += (bits.T @ bits).astype(np.int64)
            rows += len(own)
        cells = np.arange(-1, BITS * BITS, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(np.concatenate([[rows], total.ravel()]))],
                                         names=["cell", "n"])

    sums = {r["cell"]: r["n"] for r in
            fps.select("fp").mapInArrow(count, schema).groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    return sums.get(-1, 0), np.array([sums.get(i, 0) for i in range(BITS * BITS)]).reshape(BITS, BITS)


def group_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Parts of about equal width: each seed bit draws the bits it correlates with most."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    correlation = np.abs(together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    left, out = list(range(BITS)), []
    for k in range(parts):
        width = len(left) // (parts - k)
        own = [max(left, key=lambda b: correlation[b, left].sum())]
        rest = [b for b in left if b != own[0]]
        while len(own) < width:
            best = max(rest, key=lambda b: correlation[b, own].mean())
            own.append(best)
            rest.remove(best)
        out.append(sorted(own))
        left = rest
    return out


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def equal_pairs(fps: DataFrame, masks: list[int]) -> list[float]:
    """For each mask, the pairs of fingerprints that agree under it, counted over all rows."""
    keys = F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                     for i, m in enumerate(masks)])
    counts = fps.select(F.inline(keys)).groupBy("part", "key").agg(F.count("*").cast("double").alias("n"))
    found = {r["part"]: r["pairs"] for r in
             counts.groupBy("part").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs")).collect()}
    return [found.get(i, 0.0) for i in range(len(masks))]


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Cheapest thresholds with sum ``total``: costs[i][t + 1] is part i at threshold t >= -1."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for done, (cost, chosen) in best.items():
            for t, own in enumerate(part, -1):
                if done + t not in step or cost + own < step[done + t][0]:
                    step[done + t] = (cost + own, [*chosen, t])
        best = step
    return best[total]


def choose_parts(fps: DataFrame, distance: int = MAX_DISTANCE) -> list[tuple[list[int], int]]:
    """Parts (their bits) and thresholds with the least estimated work.

    Pairs that agree in a part are counted over all fingerprints; pairs at 1, 2, ... bits
    in it are estimated from those by the odds that two fingerprints differ in each bit.
    """
    n, together = bit_statistics(fps)
    p = np.diag(together) / max(n, 1)
    differ = np.clip(2 * p * (1 - p), 1e-9, 0.5)
    odds = differ / (1 - differ)
    splits = [group_bits(n, together, m) for m in PARTS if distance - m + 1 >= -m]
    pairs = iter(equal_pairs(fps, [_mask(bits) for split in splits for bits in split]))
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for split in splits:
        costs = []
        for bits in split:
            equal, ratio = next(pairs), np.ones(1)
            for b in bits:  # elementary symmetric sums of the odds
                ratio = np.convolve(ratio, [1.0, odds[b]])[:distance + 1]
            rows = [math.comb(len(bits), t) for t in range(distance + 1)]
            costs.append([0.0] + [ROW_COST * max(n, 1) * sum(rows[:t + 1]) + equal * ratio[:t + 1].sum()
                                  for t in range(distance + 1)])
        cost, thresholds = allocate(costs, distance - len(split) + 1)
        if best is None or cost < best[0]:
            best = cost, list(zip(split, thresholds, strict=True))
    return best[1]


def _flips(bits: list[int], threshold: int) -> list[int]:
    """All patterns of 1 to ``threshold`` of the bits."""
    out, last = [], [(0, 0)]
    for _ in range(threshold):
        last = [(m | 1 << bits[i], i + 1) for m, at in last for i in range(at, len(bits))]
        out += [m for m, _ in last]
    return out


def _probes(part: int, bits: list[int], threshold: int) -> Column:
    """(part, key, probe) of a fingerprint: its own bits in the part, and all within the threshold."""
    own = F.col("fp").bitwiseAND(F.lit(_signed(_mask(bits))))
    flips = F.lit([0, *map(_signed, _flips(bits, threshold))]).cast("array<bigint>")
    return F.transform(flips, lambda flip: F.struct(
        F.lit(part).alias("part"), own.bitwiseXOR(flip).alias("key"), (flip != 0).cast("int").alias("probe")))


def bucket_links(key: np.ndarray, probe: np.ndarray, fp: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect, within each bucket (a run of equal keys), all fingerprints joined by
    chains of close pairs of an index row with any other row; at most a few times as many
    links as rows. Rows are sorted by key and probe, index rows (probe 0) first."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.concatenate([edge, [len(key)]]))
    own = np.repeat(size, size)
    rank = np.arange(len(key)) - np.repeat(edge, size)
    small = own <= SMALL_BUCKET
    for step in range(1, min(SMALL_BUCKET, int(size.max(initial=1)))):
        a = np.flatnonzero(small & (rank + step < own) & (probe == 0))
        near = np.bitwise_count(fp[a] ^ fp[a + step]) <= distance
        out.append((fp[a[near]], fp[a[near] + step]))
    for e, n in zip(edge[size > SMALL_BUCKET].tolist(), size[size > SMALL_BUCKET].tolist(), strict=True):
        members, index = fp[e:e + n], int((probe[e:e + n] == 0).sum())
        waiting = np.arange(n)  # not yet reached
        while index and len(waiting) and waiting[0] < index:
            queue, waiting = [waiting[0]], waiting[1:]
            while queue and len(waiting):
                x = queue.pop()
                near = np.bitwise_count(members[waiting] ^ members[x]) <= distance
                if x >= index:  # two probe rows are no candidates
                    near &= waiting < index
                got = waiting[near]
                if len(got):
                    out.append((np.full(len(got), members[x]), members[got]))
                    queue.extend(got.tolist())
                    waiting = waiting[~near]
    a, b = (np.concatenate([x[i] for x in out]) if out else np.zeros(0, np.uint64) for i in (0, 1))
    apart = a != b
    return np.unique(np.stack([np.minimum(a, b)[apart], np.maximum(a, b)[apart]], axis=1), axis=0)


def links(fps: DataFrame, parts: list[tuple[list[int], int]], distance: int = MAX_DISTANCE) -> DataFrame:
    """Verified links (a, b) between fingerprints of at most ``distance`` differing bits, enough
    to connect all that are linked; ``fps`` holds each fingerprint once."""
    keys = F.concat(*[_probes(i, bits, t) for i, (bits, t) in enumerate(parts) if t >= 0])
    rows = fps.select("fp", F.inline(keys))
    schema = "a long, b long"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: tuple[np.ndarray, ...] | None = None

        def found(columns: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            part, key, probe, fp = columns
            # (part, key) as one number: parts are told apart by a hash, keys within a part are exact
            mixed = key.view(np.uint64) ^ (part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            pairs = bucket_links(mixed, probe, fp.view(np.uint64), distance)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, i].view(np.int64).copy()) for i in (0, 1)],
                                              names=["a", "b"])

        for batch in batches:
            own = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            if rest is not None:
                own = tuple(np.concatenate(x) for x in zip(rest, own, strict=True))
            if not len(own[0]):
                continue
            last = np.flatnonzero((own[0] != own[0][-1]) | (own[1] != own[1][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0  # the last bucket may go on
            if cut:
                yield found(tuple(x[:cut] for x in own))
            rest = tuple(x[cut:] for x in own)
        if rest is not None and len(rest[0]):
            yield found(rest)

    n = max(1, int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (rows.select("part", "key", "probe", "fp").repartition(n, "part", "key")
            .sortWithinPartitions("part", "key", "probe", "fp").mapInArrow(compare, schema))


def near_duplicate_groups(docs: DataFrame, size: int = SHINGLE_WORDS,
                          distance: int = MAX_DISTANCE) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id
    reachable over links of at most ``distance`` differing bits.

    Documents of equal fingerprints form a class first, so copies are never paired; links run
    between classes. Empty and null texts have fingerprint zero and link like any other; a
    null doc_id gets its group's smallest id, repeated rows come out as often as they came in.
    """
    own = staged(fingerprints(docs, size), "fingerprints")
    classes = staged(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    parts = choose_parts(classes, distance)
    group = components(links(classes, parts, distance))
    labelled = classes.join(group, classes["fp"] == group["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = staged(labelled.join(least, "component").select(F.col("fp").alias("class"), "component_id"), "ids")
    return own.join(ids, own["fp"] == ids["class"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """One document of each group, all columns kept: that with the smallest doc_id (null ids last),
    of rows equal in it that with the smallest row hash."""
    # Stored with their numbers, so that a retry sees the same ones.
    rows = staged(carried(docs, number=F.monotonically_increasing_id()), "rows")
    doc_id = F.col("row.doc_id")
    keyed = rows.select(F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("id"), row_hash(docs).alias("hash"),
                                 "number").alias("doc_id"), F.col("row.text").alias("text"))
    keep = near_duplicate_groups(keyed, size, distance).filter(
        F.col("doc_id.number") == F.col("component_id.number")).select(F.col("doc_id.number").alias("keep"))
    return unpacked(rows.join(keep, F.col("number") == F.col("keep"), "left_semi"), docs.columns)
