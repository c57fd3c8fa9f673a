"""Correlations of every pair of many series, whole and over sliding windows, from a long table.

The input has one row per (day, series). Pairs are rows, not columns, so any number of series
works; sums of x, y, xy, x², y² over the days on which both are known give the coefficients.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.aggregates import pair_corr, pair_count
from tidemark.operators.sliding import with_halo
from tidemark.operators.windows import global_row_index

BUCKET_ROWS = 1024
#: Rows of one block of ``corr_all_pairs`` (12 bytes each, two blocks a task), and series of it whose sums are made at once.
BLOCK_ROWS, BLOCK_SERIES = 4_000_000, 1024


def unpivot_series(df: DataFrame, day: str, series: dict[str, str], name: str = "series", value: str = "value") -> DataFrame:
    """Wide -> long: one row per day and named column, NULLs kept."""
    rows = [F.struct(F.lit(n).alias(name), F.col(c).cast("double").alias(value)) for n, c in series.items()]
    return df.select(day, F.inline(F.array(*rows)))


def series_pairs(long: DataFrame, day: str, name: str, value: str, lefts: Column | None = None, rights: Column | None = None,
                 left_name: str = "left", right_name: str = "right", keep: Sequence[str] = ()) -> DataFrame:
    """(left, right, day, x, y) for each two series with a row on the same day.

    ``lefts`` and ``rights`` are conditions on the rows that stand on either side; without them every
    unordered pair of different series is made once. One row of a series a day is expected.
    """
    a = long if lefts is None else long.filter(lefts)
    b = long if rights is None else long.filter(rights)
    a = a.select(F.col(day).alias("_day"), *keep, F.col(name).alias(left_name), F.col(value).cast("double").alias("x"))
    b = b.select(F.col(day).alias("_day"), F.col(name).alias(right_name), F.col(value).cast("double").alias("y"))
    pairs = a.join(b, "_day")
    if lefts is None and rights is None:
        pairs = pairs.filter(F.col(left_name) < F.col(right_name))
    return pairs.withColumnRenamed("_day", day)


def corr_pairs(long: DataFrame, day: str, name: str, value: str, lefts: Column | None = None, rights: Column | None = None,
               min_obs: int = 3, left_name: str = "left", right_name: str = "right") -> DataFrame:
    """(left, right, correlation, n_obs): the matrix of all pairs, as rows of one aggregate."""
    pairs = series_pairs(long, day, name, value, lefts, rights, left_name, right_name)
    return pairs.groupBy(left_name, right_name).agg(pair_corr("x", "y", min_obs).alias("correlation"),
                                                    pair_count("x", "y").alias("n_obs"))


def corr_all_pairs(long: DataFrame, day: str, name: str, value: str, min_obs: int = 3, left_name: str = "left",
                   right_name: str = "right") -> DataFrame:
    """The rows of ``corr_pairs`` for every two series with ``min_obs`` (1 at least) common observations,
    without a row per pair and day: ``day`` is a date.

    Series are dealt into blocks by a hash, and every two blocks meet in one task, where the sums of
    their pairs are products of matrices (series by days). A series is shuffled once per block, so
    there are no more blocks than memory and 36 tasks ask for. A task holds two blocks and the sums of
    ``BLOCK_SERIES`` series of either at a time. Values are taken about their series' mean; a pair one
    of whose sides nearly stands still is computed again from its own values.
    """
    rows = long.filter(F.col(day).isNotNull() & F.col(name).isNotNull() & F.col(value).isNotNull()).select(
        F.col(name).alias("name"), F.unix_date(F.col(day)).alias("d"), F.col(value).cast("double").alias("x"))
    size = rows.groupBy("name").agg(F.count("*").alias("n")).agg(F.count("*").alias("series"), F.sum("n").alias("n")).first()
    blocks = max(-(-(size["n"] or 0) // BLOCK_ROWS), min(8, -(-size["series"] // 128)), 1)
    packed = rows.groupBy("name").agg(F.collect_list(F.struct("d", "x")).alias("s")).select(
        "name", F.pmod(F.xxhash64("name"), F.lit(blocks)).cast("int").alias("block"), F.col("s.d").alias("d"), F.col("s.x").alias("x"))
    dealt = packed.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")).select(
        F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "name", "d", "x")
    tile = F.col("lo") * blocks - F.expr("lo * (lo - 1) div 2").cast("int") + F.col("hi") - F.col("lo")
    tiles = dealt.repartitionById(blocks * (blocks + 1) // 2, tile)
    kind = rows.schema["name"].dataType.simpleString()
    out = tiles.mapInArrow(_tile_correlations(min_obs, BLOCK_SERIES), f"a {kind}, b {kind}, correlation double, n_obs bigint")
    return out.select(F.least("a", "b").alias(left_name), F.greatest("a", "b").alias(right_name), "correlation", "n_obs")


def _tile_correlations(min_obs: int, series_at_once: int, day_columns: int = 512, pairs_at_once: int = 1 << 16):
    """The function of one task of ``corr_all_pairs``: all pairs of the two blocks it was given."""

    def correlate(batches):
        import numpy as np
        import pyarrow as pa

        names, series, sides = [], [], []
        kind = None
        for batch in batches:
            kind = batch.column("name").type
            names.append(batch.column("name"))
            sides.append(np.array(batch.column("block")) == np.array(batch.column("lo")))
            d, x = batch.column("d"), batch.column("x")
            for i in range(batch.num_rows):
                ds, xs = d[i].values.to_numpy(), x[i].values.to_numpy()
                order = np.argsort(ds, kind="stable")
                series.append((ds[order], xs[order]))
            diagonal = batch.column("lo")[0].as_py() == batch.column("hi")[0].as_py()
        if not series:
            return
        names, left = pa.concat_arrays(names), np.concatenate(sides)
        lefts = np.flatnonzero(left)
        rights = lefts if diagonal else np.flatnonzero(~left)
        if not len(lefts) or not len(rights):
            return
        means = []
        for _, xs in series:
            good = xs[np.isfinite(xs)]
            means.append(good.mean() if len(good) else 0.0)
        still = np.array([len(xs) > 0 and bool((xs == xs[0]).all()) for _, xs in series])
        odd = not all(np.isfinite(xs).all() for _, xs in series)

        def matrices(rows, days):
            """Per series and day: rows, values, squares and values that are no finite numbers."""
            cells, xs, width = [], [], len(days)
            for k, i in enumerate(rows):
                ds, v = series[i]
                a, b = np.searchsorted(ds, days[0]), np.searchsorted(ds, days[-1], side="right")
                cells.append(np.searchsorted(days, ds[a:b]) + k * width)
                xs.append(v[a:b] - means[i])
            cells, xs = np.concatenate(cells), np.concatenate(xs)
            fine = np.isfinite(xs)
            xs = np.where(fine, xs, 0.0)
            return [np.bincount(cells, w, len(rows) * width).reshape(len(rows), width).astype(float)
                    for w in (None, xs, xs * xs, *([(~fine).astype(float)] if odd else []))]

        def exact(i, j):
            """The coefficient from the pair's own values."""
            (da, xa), (db, xb) = series[i], series[j]
            since, until = np.searchsorted(db, da), np.searchsorted(db, da, side="right")
            found = until - since
            x = np.repeat(xa, found)
            y = xb[np.repeat(since - np.cumsum(found) + found, found) + np.arange(found.sum())]
            if (x == x[0]).all() or (y == y[0]).all():
                return None
            x, y = x - x.mean(), y - y.mean()
            below = np.sqrt((x * x).mean()) * np.sqrt((y * y).mean())
            return (x * y).mean() / below if below else None

        def of(lefts, rights, same):
            """The rows of the pairs of some series with some others, or of every two of the ``same``."""
            days = np.unique(np.concatenate([series[i][0] for i in {*lefts, *rights}]))
            n, sx, sy, sxy, sxx, syy, bad = (np.zeros((len(lefts), len(rights))) for _ in range(7))
            for since in range(0, len(days), day_columns):
                span = days[since:since + day_columns]
                a = matrices(lefts, span)
                b = a if same else matrices(rights, span)
                n += a[0] @ b[0].T
                sx += a[1] @ b[0].T
                sy += a[0] @ b[1].T
                sxy += a[1] @ b[1].T
                sxx += a[2] @ b[0].T
                syy += a[0] @ b[2].T
                if odd:
                    bad += a[3] @ b[0].T + a[0] @ b[3].T
            step = max(1, pairs_at_once // len(rights))
            for top in range(0, len(lefts), step):
                part = slice(top, top + step)
                wanted = n[part] >= max(min_obs, 1)
                if same:
                    wanted &= lefts[part][:, None] < rights[None, :]
                i, j = np.nonzero(wanted)
                at = i + top
                count = n[at, j]
                vx, vy = sxx[at, j] - sx[at, j] ** 2 / count, syy[at, j] - sy[at, j] ** 2 / count
                with np.errstate(invalid="ignore", divide="ignore"):
                    c = (sxy[at, j] - sx[at, j] * sy[at, j] / count) / (np.sqrt(vx) * np.sqrt(vy))
                none = still[lefts[at]] | still[rights[j]]
                unsure = ~none & ~((vx > 1e-4 * sxx[at, j]) & (vy > 1e-4 * syy[at, j]))
                broken = bad[at, j] > 0
                for k in np.flatnonzero(unsure & ~broken):
                    found = exact(lefts[at[k]], rights[j[k]])
                    none[k], c[k] = found is None, 0.0 if found is None else found
                c[broken], none[broken] = np.nan, False
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(lefts[at])).cast(kind), names.take(pa.array(rights[j])).cast(kind),
                     pa.array(c, mask=none), pa.array(count.astype("int64"))], ["a", "b", "correlation", "n_obs"])

        for i in range(0, len(lefts), series_at_once):
            for j in range(i if diagonal else 0, len(rights), series_at_once):
                yield from of(lefts[i:i + series_at_once], rights[j:j + series_at_once], diagonal and i == j)

    return correlate


def rolling_corr_pairs(long: DataFrame, day: str, name: str, value: str, windows: Sequence[int] = (30, 60, 90),
                       lefts: Column | None = None, rights: Column | None = None, min_obs: int = 3,
                       left_name: str = "left", right_name: str = "right", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(left, right, day, corr_n, n_obs_n): correlation of each pair over the last ``n`` days of the table.

    A window is ``n`` positions among all days of ``long``, whether or not the pair has rows there; a
    row comes out for each day on which both series have one (its value may be NULL). NULL below
    ``min_obs`` complete days or where one side does not vary. Sums slide at a constant cost per row:
    each is a running sum of its bucket of days less the one that stood ``n`` positions earlier, taken
    about the bucket's means. That a side varies is known exactly, from its last change.
    """
    windows = list(windows)
    days = global_row_index(long.select(day).distinct(), day, index="_pos")
    pairs = series_pairs(long.join(days, day), day, name, value, lefts, rights, left_name, right_name, ["_pos"])
    dealt = with_halo(pairs, "_pos", max(windows) - 1, bucket_rows)
    pair = Window.partitionBy(left_name, right_name, "_bkt")
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    x, y = F.when(both, F.col("x")), F.when(both, F.col("y"))
    rows = dealt.select(left_name, right_name, day, "_pos", "_bkt", "_halo", x.alias("x"), y.alias("y"),
                        F.avg(x).over(pair).alias("_mx"), F.avg(y).over(pair).alias("_my"))
    dx, dy = F.col("x") - F.col("_mx"), F.col("y") - F.col("_my")
    order = pair.orderBy("_pos")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)

    # Position of the last complete row whose value the one after it did not repeat.
    def before_change(c: str) -> Column:
        last = F.last(F.when(F.col("x").isNotNull(), F.struct(F.col(c).alias("v"), F.col("_pos").alias("p"))), ignorenulls=True).over(earlier)
        return F.when(F.col("x").isNotNull() & last.isNotNull() & (last["v"] != F.col(c)), last["p"])

    terms = {"x": dx, "y": dy, "xy": dx * dy, "xx": dx * dx, "yy": dy * dy, "n": F.when(F.col("x").isNotNull(), 1)}
    rows = rows.select("*", *[F.coalesce(t, F.lit(0)).cast("long" if k == "n" else "double").alias(f"_{k}") for k, t in terms.items()],
                       before_change("x").alias("_cx"), before_change("y").alias("_cy"))
    now = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = [F.sum(f"_{k}").over(now).alias(f"_s{k}") for k in terms]
    sums += [F.max(c).over(now).alias(f"_v{c[-1]}") for c in ("_cx", "_cy")]
    for n in windows:
        gone = order.rangeBetween(Window.unboundedPreceding, -n)
        sums += [F.coalesce(F.sum(f"_{k}").over(gone), F.lit(0)).alias(f"_g{k}_{n}") for k in terms]
    rows = rows.select(left_name, right_name, day, "_pos", "_halo", *sums).filter(~F.col("_halo"))
    out = []
    for n in windows:
        s = {k: F.col(f"_s{k}") - F.col(f"_g{k}_{n}") for k in terms}
        varies = (F.col("_vx") > F.col("_pos") - n) & (F.col("_vy") > F.col("_pos") - n)
        top = s["n"] * s["xy"] - s["x"] * s["y"]
        below = (s["n"] * s["xx"] - s["x"] * s["x"]) * (s["n"] * s["yy"] - s["y"] * s["y"])
        out += [F.when((s["n"] >= min_obs) & varies & (below > 0),
                       F.greatest(F.lit(-1.0), F.least(F.lit(1.0), top / F.sqrt(F.when(below > 0, below))))).alias(f"corr_{n}"),
                s["n"].alias(f"n_obs_{n}")]
    return rows.select(left_name, right_name, day, *out)
