"""Best-fit packing with certified bin counts.

Documents become token sequences, longer ones are cut, and the pieces are packed into
sequences of a fixed capacity. Pieces are dealt over partitions of a bounded number of
pieces; each partition is packed best-fit decreasing, and a lower bound from
dual-feasible functions certifies its bin count (where it does not, best fit bin by bin
is tried too and the better packing kept). Partitions above their bound give up
the pieces of their bins that are not full; these are dealt anew over partitions, so
that partitions exchange documents, and packed again, as long as that saves bins.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.store import map_arrow, staged
from tidemark.llm.tokens import END_ID, encoder, vocabulary_path

CAPACITY = 1024
PIECES_PER_PARTITION = 50_000
MAX_ROUNDS = 6


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids: the first takes the remainder."""
    head = n % capacity
    return ([head] if head else []) + [capacity] * (n // capacity)


def encode_pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None,
                  with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids, if asked for).

    A null text is an empty one; every document ends with id 2, so none is empty.
    """
    path = path or vocabulary_path()
    schema = T.StructType([docs.schema["doc_id"], T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())]
                          + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path).ids
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, text in enumerate(part.column(1)):
                    own = ids_of(text.as_py() or "")
                    own.append(END_ID)
                    raw = np.array(own, "<u4")
                    s = 0
                    for k, n in enumerate(cut_lengths(len(own), capacity)):
                        row.append(i)
                        piece.append(k)
                        start.append(s)
                        length.append(n)
                        crc.append(zlib.crc32(raw[s:s + n]))
                        if with_ids:
                            ids.append(raw[s:s + n].astype(np.int32))
                        s += n
                out = [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    out.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return map_arrow(docs.select("doc_id", "text"), encode, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece, pieces given by falling length.

    Open bins hang at their free space; bit r of ``free`` says that some bin has r left,
    so the tightest bin that takes a piece is the lowest bit from its length on.
    """
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    free, made = 0, 0
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        fits = free >> n
        if fits:
            left = n + (fits & -fits).bit_length() - 1
            b = waiting[left].pop()
            if not waiting[left]:
                free &= ~(1 << left)
        else:
            left, b = capacity, made
            made += 1
        bins[i], offsets[i] = b, capacity - left
        left -= n
        if left:
            waiting[left].append(b)
            free |= 1 << left
    return bins, offsets


def best_fit_by_bin(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece, pieces given by falling length, one bin after another.

    A bin starts with the longest piece left; then it takes the piece, or else the two
    pieces, that fill it exactly, or else the longest that fits. Bit n of ``have`` says that
    a piece of length n is left, bit capacity - n of ``back`` the same, so that one shift
    lines up all pairs of a given sum.
    """
    count = np.bincount(lengths, minlength=capacity + 1)
    # Pieces of one length stand together; the next one of each length to be used:
    follow = (len(lengths) - np.cumsum(count)).tolist()
    count = count.tolist()
    have = sum(1 << n for n in range(1, capacity + 1) if count[n])
    back = sum(1 << (capacity - n) for n in range(1, capacity + 1) if count[n])
    bins, offsets, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    while have:
        left, chosen = capacity, [have.bit_length() - 1]
        while chosen:
            for n in chosen:
                bins[follow[n]], offsets[follow[n]] = made, capacity - left
                follow[n] += 1
                count[n] -= 1
                left -= n
                if not count[n]:
                    have &= ~(1 << n)
                    back &= ~(1 << (capacity - n))
            fits = have & ((2 << left) - 1)
            if not left or not fits:
                break
            if fits >> left & 1:
                chosen = [left]
                continue
            pairs = fits & (back >> (capacity - left))
            half = left // 2
            if left == 2 * half and count[half] < 2:
                pairs &= ~(1 << half)
            a = (pairs or fits).bit_length() - 1
            chosen = [a, left - a] if pairs else [a]
        made += 1
    return bins, offsets


def bin_lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Fewest bins that any packing needs, by two families of dual-feasible functions.

    f_t counts pieces over capacity - t as whole bins, drops those under t and keeps the
    rest at their size, for every t up to half the capacity (t = 0: the volume). u_k
    rounds sizes down to k-ths, unless (k + 1) * size is a whole number of bins.
    """
    if not len(lengths):
        return 0
    have = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    count, volume = np.concatenate([[0], np.cumsum(have)]), np.concatenate([[0], np.cumsum(have * size)])
    t = np.arange(0, capacity // 2 + 1)
    whole = count[-1] - count[capacity - t + 1]
    best = int((whole - (-(volume[capacity - t + 1] - volume[t]) // capacity)).max())
    for k in range(1, 101):
        scaled = (k + 1) * size
        exact = scaled % capacity == 0
        rounded = (have * (scaled // capacity))[~exact].sum()  # k-ths of a bin
        kept = (have * size)[exact].sum()  # capacity-ths of a bin
        best = max(best, -int(-(rounded * capacity + kept * k) // (k * capacity)))
    return best


def _pack_partitions(pieces: DataFrame, partitions: int, salt: int, capacity: int) -> DataFrame:
    keys = [f.name for f in pieces.schema]
    schema = T.StructType([*pieces.schema, *(T.StructField(n, T.LongType()) for n in
                           ("part", "bin", "offset", "part_bins", "part_bound", "part_open")),
                           T.StructField("full", T.BooleanType())])

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = table.column("length").to_numpy()
        bound = bin_lower_bound(lengths, capacity)
        bins, offsets = best_fit_decreasing(lengths, capacity)
        if bins.max() + 1 > bound:  # not certified: the other order of best fit may save bins
            other = best_fit_by_bin(lengths, capacity)
            if other[0].max() < bins.max():
                bins, offsets = other
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        n, closed = len(fill), fill[bins] == capacity
        more = [bins, offsets, *(np.full(len(bins), v) for v in
                (n, bound, int((fill < capacity).sum()))), closed]
        out = [table.column(c) for c in [*keys, "part"]] + [pa.array(v) for v in more]
        return pa.table(dict(zip(schema.names, out, strict=True)))

    part = F.pmod(F.xxhash64(F.lit(salt), "_number"), F.lit(partitions))
    return pieces.withColumn("part", part).groupBy("part").applyInArrow(pack, schema)


def pack_sequences(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None,
                   pieces_per_partition: int = PIECES_PER_PARTITION, max_rounds: int = MAX_ROUNDS,
                   with_ids: bool = False) -> DataFrame:
    """Pack every document into sequences of at most ``capacity`` ids.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset (ids, if asked for), and ``certified``: its partition uses as few bins as any
    packing of its pieces could. Partitions exchange pieces until a round saves no bin,
    ``max_rounds`` at most. Null text: empty; null doc_id and repeated rows: packed
    like any others; empty table: no rows; other columns are ignored.
    """
    # Dealt by a number stored with them, so that rows with one id (or none) spread, too.
    pieces = encode_pieces(docs, capacity, path, with_ids)
    shown = pieces.columns
    pieces = staged(pieces.withColumn("_number", F.monotonically_increasing_id()), "pieces")
    names, done = pieces.columns, []

    def deal(rows: DataFrame, n: int, turn: int) -> DataFrame:
        packed = _pack_partitions(rows, max(1, -(-n // pieces_per_partition)), turn, capacity)
        number = F.lit(turn << 57) + F.col("part") * F.lit(1 << 24) + F.col("bin")
        return staged(packed.withColumn("sequence_id", number), "packed")

    def bins(rows: DataFrame, column: str) -> int:
        each = rows.groupBy("part").agg(F.max(column).alias("n"))
        return each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]

    current = deal(pieces, pieces.count(), 0)
    for turn in range(1, max_rounds + 1):
        give = (F.col("part_bins") > F.col("part_bound")) & ~F.col("full")
        pool = current.filter(give)
        n, parts = pool.agg(F.count("*"), F.count_distinct("part")).first()
        if not n or parts == 1:
            break  # all certified, or no partition to exchange with
        again = deal(pool.select(*names), n, turn)
        if bins(again, "part_bins") >= bins(pool, "part_open"):
            break
        done.append(current.filter(~give))
        current = again
    for rows in done:
        current = current.unionByName(rows)
    return current.select(*shown, "sequence_id", "offset",
                          (F.col("part_bins") == F.col("part_bound")).alias("certified"))
