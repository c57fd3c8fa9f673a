"""Property tests: technicals and shares against a brute-force Python model
of the reference rules (R5-R8), on random small series."""

import math
import statistics

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.windows import share_of_total, with_technicals

prices = st.lists(st.one_of(st.none(), st.floats(min_value=1, max_value=500, allow_nan=False).map(
    lambda x: round(x, 2))), min_size=1, max_size=40)


def brute_technicals(closes):
    out = []
    changes = []
    for i, c in enumerate(closes):
        prev = closes[i - 1] if i > 0 else None
        ch = None if (c is None or prev is None) else c - prev
        changes.append(ch)
        ret = None if ch is None or prev == 0 else ch / prev

        def avg(xs):
            xs = [x for x in xs if x is not None]
            return sum(xs) / len(xs) if xs else None

        ma = {n: avg(closes[max(0, i - n + 1):i + 1]) for n in (20, 50, 200)}
        frame = changes[max(0, i - 13):i + 1]
        gain = sum((x if x is not None and x > 0 else 0) for x in frame) / len(frame)
        loss = sum((abs(x) if x is not None and x < 0 else 0) for x in frame) / len(frame)
        rsi = None if loss == 0 else 100 - 100 / (1 + gain / loss)
        w20 = [x for x in closes[max(0, i - 19):i + 1] if x is not None]
        sd = statistics.stdev(w20) if len(w20) >= 2 else None
        mid = avg(closes[max(0, i - 19):i + 1])
        up = None if sd is None or mid is None else mid + 2 * sd
        out.append((ch, ret, ma[20], ma[50], ma[200], rsi, mid, up))
    return out


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@settings(max_examples=15, deadline=None)
@given(st.lists(prices, min_size=1, max_size=3))
def test_technicals_match_brute_force(spark, series):
    rows = [(f"T{k}", i, c) for k, s in enumerate(series) for i, c in enumerate(s)]
    df = spark.createDataFrame(rows, "ticker string, t int, close double")
    got = {(r.ticker, r.t): r for r in with_technicals(df, "close", "ticker", "t").collect()}
    for k, s in enumerate(series):
        for i, want in enumerate(brute_technicals(s)):
            r = got[(f"T{k}", i)]
            have = (r.daily_change, r.daily_return, r.ma_20, r.ma_50, r.ma_200, r.rsi_14, r.bb_middle, r.bb_upper)
            assert all(close(a, b) for a, b in zip(have, want)), (k, i, have, want)
            assert r.rsi_14 is None or 0 <= r.rsi_14 <= 100


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.floats(min_value=0, max_value=1e6, allow_nan=False)),
                min_size=1, max_size=60))
def test_share_of_total_sums_and_ranges(spark, rows):
    df = spark.createDataFrame(rows, "d int, v double")
    out = share_of_total(df, "v", "d")
    for r in out.groupBy("d").agg(F.sum("share_pct").alias("s"), F.sum("v").alias("t")).collect():
        if r.t == 0:
            assert r.s is None
        else:
            assert math.isclose(r.s, 100.0, rel_tol=1e-9)
    assert out.filter((F.col("share_pct") < 0) | (F.col("share_pct") > 100 + 1e-9)).count() == 0
