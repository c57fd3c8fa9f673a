"""Rolling correlations of all pairs against numpy on each window."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators.rolling import corr_pairs, rolling_corr_pairs, unpivot_series


def day(n):
    return dt.date(2019, 12, 1) + dt.timedelta(days=n)


def brute(cells, names, days, width, least):
    out = {}
    for a in names:
        for b in names:
            if a >= b:
                continue
            for i, d in enumerate(days):
                if (a, d) not in cells or (b, d) not in cells:
                    continue
                rows = [(cells.get((a, e)), cells.get((b, e))) for e in days[max(0, i - width + 1):i + 1]]
                rows = [r for r in rows if None not in r]
                x, y = np.array(rows).reshape(-1, 2).T
                flat = not len(rows) or np.ptp(x) == 0 or np.ptp(y) == 0
                out[a, b, d] = (None if len(rows) < least or flat else float(np.corrcoef(x, y)[0, 1]), len(rows))
    return out


def test_sparse_and_flat_series_in_small_buckets(spark):
    """Missing rows and NULLs, flat runs, large values, windows across buckets and years."""
    r, cells = random.Random(5), {}
    for name in "abcde":
        v = 1e9 if name == "e" else 5.0
        for n in range(120):
            if r.random() < 0.8:
                v += 0 if name == "d" and n % 40 < 25 else r.gauss(0, 1)
                cells[name, day(n)] = None if r.random() < 0.1 else v
    rows = [(*k, v) for k, v in cells.items()]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "s string, d date, v double")
    days = sorted({d for _, d in cells})
    out = rolling_corr_pairs(df, "d", "s", "v", (5, 30), bucket_rows=32)
    got = {(x["left"], x["right"], x["d"]): x for x in out.collect()}
    for width in (5, 30):
        want = brute(cells, "abcde", days, width, 3)
        assert set(got) == set(want)
        for k, (c, n) in want.items():
            g = got[k]
            assert g[f"n_obs_{width}"] == n
            assert (g[f"corr_{width}"] is None) == (c is None), (k, width, g, c)
            assert c is None or abs(g[f"corr_{width}"] - c) < 1e-6
    whole = {(x["left"], x["right"]): x for x in corr_pairs(df, "d", "s", "v").collect()}
    for (a, b), x in whole.items():
        both = np.array([(cells[a, d], cells[b, d]) for d in days if cells.get((a, d)) is not None and cells.get((b, d)) is not None])
        assert x["n_obs"] == len(both) and abs(x["correlation"] - np.corrcoef(both.T)[0, 1]) < 1e-6


def test_sides_and_empty(spark):
    wide = spark.createDataFrame([(day(n), float(n), float(n * n), None) for n in range(6)], "d date, x double, y double, z double")
    long = unpivot_series(wide, "d", {"x": "x", "y": "y", "z": "z"})
    out = rolling_corr_pairs(long, "d", "series", "value", (4,), F.col("series") == "x", F.col("series") != "x").collect()
    assert {(r["left"], r["right"]) for r in out} == {("x", "y"), ("x", "z")} and len(out) == 12
    assert all(r["corr_4"] is None and r["n_obs_4"] == 0 for r in out if r["right"] == "z")
    assert rolling_corr_pairs(long.limit(0), "d", "series", "value").collect() == []
    n = 40  # many series stay rows: the plan has one aggregate whatever their number
    many = spark.range(n * 30).select((F.col("id") % n).cast("string").alias("s"), F.date_add(F.lit(day(0)), (F.col("id") / n).cast("int")).alias("d"),
                                      F.rand(3).alias("v"))
    assert corr_pairs(many, "d", "s", "v").count() == n * (n - 1) // 2


def test_all_pairs_in_blocks_equal_pairs_by_day(spark, monkeypatch):
    """Blocks of few series: NULLs, repeated rows, still and nearly still series, NaN, large values; no
    row per pair and day is shuffled."""
    from tidemark.operators import rolling
    monkeypatch.setattr(rolling, "BLOCK_SERIES", 4)
    r, rows = random.Random(8), []
    for k in range(14):
        for n in range(90):
            if r.random() < 0.7:
                v = {0: 2.5, 1: 1e5 + r.gauss(0, 1), 2: 1.0 if n < 80 else 3.0, 3: float("nan") if n == 40 else r.gauss(0, 1)}.get(k, r.gauss(0, 1))
                rows += [(f"s{k}", day(n), None if r.random() < 0.1 else v)] * (2 if k == 5 and n % 9 == 0 else 1)
    rows += [("late", day(1000 + n), r.gauss(0, 1)) for n in range(20)] + [("s4", None, 1.0), (None, day(3), 1.0)]
    long = spark.createDataFrame(rows, "name string, day date, v double")
    key = lambda f: {(q["left"], q["right"]): (q["n_obs"], q["correlation"]) for q in f.collect()}
    want = key(corr_pairs(long, "day", "name", "v", min_obs=30).filter("n_obs >= 30"))
    found = rolling.corr_all_pairs(long, "day", "name", "v", 30)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    got = key(found)
    assert got.keys() == want.keys() and len(got) > 60
    for k, (n, c) in want.items():
        assert got[k][0] == n
        if c is None or c != c:
            assert repr(got[k][1]) == repr(c), k
        else:
            assert abs(got[k][1] - c) < 1e-9, k
    assert rolling.corr_all_pairs(long.limit(0), "day", "name", "v").count() == 0


def test_a_series_goes_to_few_blocks(spark, monkeypatch):
    """Many series are dealt into 8 blocks, however few of them are summed at once; pairs are those by day."""
    from tidemark.operators import rolling
    from tidemark.operators.rolling import corr_pairs
    n = 1100
    long = spark.range(n * 12).select(F.concat(F.lit("s"), (F.col("id") % n).cast("string")).alias("name"),
                                      F.date_add(F.lit(day(0)), (F.col("id") / n).cast("int")).alias("day"),
                                      F.when(F.col("id") % 13 > 0, F.rand(3)).alias("v")).repartition(4).cache()
    dealt, own = [], type(long).repartitionById
    monkeypatch.setattr(rolling, "BLOCK_SERIES", 50)
    monkeypatch.setattr(type(long), "repartitionById", lambda df, k, c: dealt.append((df, k)) or own(df, k, c))
    got = rolling.corr_all_pairs(long, "day", "name", "v", 10)
    (rows, tiles), = dealt
    assert tiles == 36 and rows.count() == 8 * n
    want = corr_pairs(long, "day", "name", "v", min_obs=10).filter("n_obs >= 10")
    both = got.withColumnRenamed("correlation", "c").join(want.withColumnRenamed("n_obs", "n"), ["left", "right"], "full")
    bad = both.filter("not coalesce(n = n_obs and abs(c - correlation) < 1e-9, false)")
    assert bad.count() == 0 and got.count() > 100_000
    long.unpersist()
