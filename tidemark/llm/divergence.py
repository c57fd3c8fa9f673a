"""Source divergence audit: how far the word use of each source stands from its language's others.

Every (language, source) group is a sparse vector of (term id, count), cut into blocks of
terms. Groups are dealt into tiles; a task holds one block of one unordered pair of tiles and
merges the sorted id arrays of every unordered pair of groups there: shared terms, terms of one
side and terms of neither are priced both ways in exact integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import map_arrow, staged

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
#: Terms of a block and groups of a tile (on average): a task holds at most two tiles of one block.
BLOCK_TERMS, TILE_GROUPS = 8192, 16
#: Counts a task gathers before it sends them on.
HELD_COUNTS = 500_000

#: Bytes of terms, A-Z lower-cased; all others become spaces.
_TERM_BYTES = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 0x20 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Runs of letters A-Z, a-z and non-ASCII characters, only A-Z lower-cased, as UTF-8."""
    return (text or "").encode().translate(_TERM_BYTES).split(b" ")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    uses: dict[tuple[str, str], Counter] = {}
    docs: dict[tuple[str, str], Counter] = {}
    held = 0

    def sent() -> pa.RecordBatch:
        keys = [k for k, c in uses.items() for _ in range(len(c))]
        terms = pa.array([t for c in uses.values() for t in c], pa.binary()).cast(pa.string())
        own = [pa.array([k[i] for k in keys], pa.string()) for i in (0, 1)]
        n = pa.array([n for c in uses.values() for n in c.values()], pa.int64())
        d = pa.array([docs[k][t] for k, c in uses.items() for t in c], pa.int64())
        return pa.RecordBatch.from_arrays([*own, terms, n, d], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found = Counter(terms_of(text))
            found.pop(b"", None)
            if not found:
                continue
            key = (lang, source)
            if key not in uses:
                uses[key], docs[key] = Counter(), Counter()
            before = len(uses[key])
            uses[key].update(found)
            docs[key].update(found.keys())
            held += len(uses[key]) - before
            if held >= HELD_COUNTS:
                yield sent()
                uses, docs, held = {}, {}, 0
    if held:
        yield sent()


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term, n (uses in the group), n_lang, lead (one row of each term of a language).

    Only terms in at least ``min_docs`` rows of their language. Counts are added up in each task
    before the one exchange by (lang, term), where both the group's and the language's sums are taken.
    """
    raw = map_arrow(docs.select("lang", "source", "text"), _counted,
                    "lang string, source string, term string, n long, docs long")
    sums = raw.repartition("lang", "term").groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    return sums.select("lang", "source", "term", "n", F.sum("n").over(term).alias("n_lang"),
                       F.sum("docs").over(term).alias("d"),
                       (F.row_number().over(term.orderBy("source")) == 1).alias("lead")) \
        .filter(F.col("d") >= min_docs).drop("d")


def prices(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), exactly, by long division (totals below 9e15)."""
    rest, out = counts.astype(np.int64) + 1, np.zeros(len(counts), np.int64)
    for _ in range(3):  # SCALE is 1000 ** 3
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def gallop(ids: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both sorted arrays of the ids they share: the shorter one's ids are searched in
    the longer one, each from where the one before was found."""
    if len(ids) > len(others):
        there, here = gallop(others, ids)
        return here, there
    at = np.searchsorted(others, ids)
    hit = at < len(others)
    hit[hit] = others[at[hit]] == ids[hit]
    return np.flatnonzero(hit), at[hit]


def _pair_task(rows: pd.DataFrame) -> pd.DataFrame:
    """All pairs of groups of one block and one pair of tiles: what their terms in the block add."""
    totals = {r.source: (r.tile, int(r.n_group) + int(r.n_terms), int(r.n_terms))
              for r in rows[rows["ids"].isna()].drop_duplicates("source").itertuples()}
    held = {r.source: (np.asarray(r.ids, np.int64), np.asarray(r.counts, np.int64))
            for r in rows[rows["ids"].notna()].drop_duplicates("source").itertuples()}
    none = np.zeros(0, np.int64)
    sources = sorted(totals)
    vectors = []
    for s in sources:
        tile, total, n_terms = totals[s]
        ids, counts = held.get(s, (none, none))
        vectors.append((tile, ids, prices(counts, max(total, 1)), prices(np.zeros(1, np.int64), max(total, 1))))
    lang, a, b = rows["lang"].iloc[0], rows["a"].iloc[0], rows["b"].iloc[0]
    out = []
    for i, (tile, ids, p, p0) in enumerate(vectors):
        for j in range(i + 1, len(vectors)):
            other, there, q, q0 = vectors[j]
            if a != b and tile == other:
                continue
            x, y = gallop(ids, there)
            own, its = np.ones(len(ids), bool), np.ones(len(there), bool)
            own[x], its[y] = False, False
            out.append((lang, sources[i], sources[j],
                        int(gaps(p[x], q[y]).sum() + gaps(p[own], q0).sum() + gaps(p0, q[its]).sum()),
                        int(gaps(q[y], p[x]).sum() + gaps(q0, p[own]).sum() + gaps(q[its], p0).sum()),
                        len(ids) + len(there) - len(x),
                        int(gaps(p0, q0)[0]), int(gaps(q0, p0)[0]), totals[sources[i]][2]))
    return pd.DataFrame(out, columns=["lang", "s", "t", "st", "ts", "present", "st0", "ts0", "n_terms"])


def _ranked(rows: DataFrame) -> Column:
    return F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).cast("int")


def _price(n: Column, total: Column) -> Column:
    wide = F.expr("cast(1000000000 as decimal(10,0))") * (n + 1).cast("decimal(20,0)")
    return F.call_function("div", wide, total.cast("decimal(20,0)")) + 1


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: what sets each (lang, source) group apart.

    Part ``pair``: each other source of the language, with the summed divergence over all kept
    terms of the language (0 without any). Part ``term``: the group's ``top_terms`` terms that it
    uses more than the language does. Null text, lang or source count as empty; empty texts have
    no terms, but their group is listed; repeated rows count each. An empty table has no rows.
    Equal values are ranked by item in UTF-8 order.
    """
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = staged(kept_counts(docs, min_docs), "divergence-counts")
    groups = docs.select("lang", "source").distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    groups = groups.join(sums, ["lang", "source"], "left").withColumn("n_group", F.coalesce("n_group", F.lit(0)))
    langs = kept.groupBy("lang").agg(F.sum(F.col("lead").cast("long")).alias("n_terms"), F.sum("n").alias("n_all"))
    sizes = groups.groupBy("lang").agg(F.count("*").alias("n_groups")).join(langs, "lang", "left").select(
        "lang", F.coalesce("n_terms", F.lit(0)).alias("n_terms"), F.coalesce("n_all", F.lit(0)).alias("n_all"),
        F.greatest(F.lit(1), F.ceil(F.col("n_terms") / BLOCK_TERMS)).alias("blocks"),
        F.ceil(F.col("n_groups") / TILE_GROUPS).alias("tiles"))
    groups = staged(groups.join(sizes, "lang").withColumn(
        "tile", F.pmod(F.xxhash64("source"), "tiles")), "divergence-groups")
    known = kept.join(groups, ["lang", "source"])

    # Sorted (id, count) arrays by block. Ids are dense within a block, by term.
    blocks = known.withColumn("block", F.pmod(F.xxhash64("term"), "blocks"))
    ids = (F.dense_rank().over(Window.partitionBy("lang", "block").orderBy("term")) - 1).alias("id")
    arrays = blocks.select("lang", "source", "block", "tile", "tiles", "n", ids) \
        .groupBy("lang", "source", "block", "tile", "tiles").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("v")) \
        .select("lang", "source", "block", "tile", "tiles", F.lit(None).cast("long").alias("n_group"),
                F.lit(None).cast("long").alias("n_terms"), F.col("v.id").alias("ids"), F.col("v.n").alias("counts"))
    # Every group is known to every block of its language, also where it has no term there.
    roster = groups.select("lang", "source", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
                           "tile", "tiles", "n_group", "n_terms", F.lit(None).cast("array<int>").alias("ids"),
                           F.lit(None).cast("array<long>").alias("counts"))
    tasks = arrays.unionByName(roster).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))) \
        .select("lang", "block", F.least("tile", "with").alias("a"), F.greatest("tile", "with").alias("b"),
                "source", "tile", "n_group", "n_terms", "ids", "counts")
    found = tasks.groupBy("lang", "block", "a", "b").applyInPandas(
        _pair_task, "lang string, s string, t string, st long, ts long, present long, st0 long, ts0 long, n_terms long")
    pairs = found.select("lang", F.inline(F.array(
        F.struct(F.col("s").alias("source"), F.col("t").alias("item"), F.col("st").alias("v"), F.col("st0").alias("v0"),
                 "present", "n_terms"),
        F.struct(F.col("t").alias("source"), F.col("s").alias("item"), F.col("ts").alias("v"), F.col("ts0").alias("v0"),
                 "present", "n_terms")))).groupBy("lang", "source", "item").agg(
        (F.sum("v") + (F.max("n_terms") - F.sum("present")) * F.max("v0")).alias("value"))

    p, q = _price(F.col("n"), F.col("n_group") + F.col("n_terms")), _price(F.col("n_lang"), F.col("n_all") + F.col("n_terms"))
    terms = known.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q") \
        .select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    out = [rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", _ranked(rows).alias("rank"))
           for part, rows in (("pair", pairs), ("term", terms))]
    return out[0].unionByName(out[1].filter(F.col("rank") <= top_terms))
