"""Halo buckets and constant-cost frames against plain windows, also on a hot series."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.sliding import series_frames, series_positions, sliding_technicals
from tidemark.operators.windows import with_technicals

COLUMNS = ["daily_change", "daily_return", "ma_20", "ma_50", "ma_200", "rsi_14", "bb_middle", "bb_upper", "bb_lower"]


@pytest.fixture(scope="module")
def prices(spark):
    """HOT has a third of all rows over 30 years; prices in cents, some NULL, some flat runs."""
    r, rows = random.Random(7), []
    for k, n in [("HOT", 1500)] + [(f"K{i}", 100) for i in range(28)] + [("FLAT", 60), ("ONE", 1), (None, 40)]:
        day, p = dt.date(1990, 1, 1), 100.0
        for _ in range(n):
            day += dt.timedelta(days=r.randint(1, 9))
            p = p if k == "FLAT" else round(p * (0.95 + r.random() / 10), r.choice((0, 2, 4)))
            rows.append((k, day, None if r.random() < 0.02 else p))
    return spark.createDataFrame(rows, "ticker string, price_date date, close_price double").cache()


def test_positions(prices):
    w = Window.partitionBy("ticker").orderBy("price_date")
    bad = series_positions(prices, "ticker", "price_date").withColumn("want", F.row_number().over(w) - 1).filter("_pos != want")
    assert bad.count() == 0
    assert series_positions(prices, "ticker", "price_date").count() == prices.count()


@pytest.mark.parametrize("bucket_rows", [200, 256, 2048])
def test_technicals_equal_frames(prices, bucket_rows):
    want = {(r["ticker"], r["price_date"]): r for r in with_technicals(prices).collect()}
    got = sliding_technicals(prices, bucket_rows=bucket_rows).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r["ticker"], r["price_date"]]
        for c in COLUMNS:
            a, b = r[c], w[c]
            # frames square doubles: a flat run has a deviation of 0 here and of nearly 0 there
            assert (a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-7, abs_tol=2e-5)), (c, r, w)


def test_general_frames(prices):
    out = series_frames(prices, "ticker", "price_date", 30, lambda frame: [
        F.max("close_price").over(frame(30)).alias("high"), F.lag("close_price", 5).over(frame(None)).alias("ago")], bucket_rows=64)
    w = Window.partitionBy("ticker").orderBy("price_date")
    want = prices.select("*", F.max("close_price").over(w.rowsBetween(-29, 0)).alias("high"), F.lag("close_price", 5).over(w).alias("ago"))
    assert out.exceptAll(want).count() == 0 and out.count() == want.count()
    with pytest.raises(ValueError):
        series_frames(prices, "ticker", "price_date", 3, lambda frame: [F.max("close_price").over(frame(4))])


def test_hot_series_is_many_window_groups(prices):
    """No window over rows is partitioned by the series alone: the hot series is spread over its buckets."""
    plan = sliding_technicals(prices, bucket_rows=200)._jdf.queryExecution().optimizedPlan().toString()
    specs = [p.split(")")[0] for p in plan.split("windowspecdefinition(")[1:]]
    assert specs and all("_bkt" in s or "_bucket" in s for s in specs)
    dealt = sliding_technicals(prices, bucket_rows=200)
    assert dealt.filter("ticker = 'HOT'").count() == 1500


def test_positions_share_the_exchange_of_their_join(spark):
    """Rows are dealt once for numbering and offsets; NULL series and days have positions too."""
    from tidemark.operators.sliding import series_positions
    rows = [(t, None if n == 0 else f"{2000 + n // 3}-01-0{n % 3 + 1}", n) for t in ("a", "b", None) for n in range(9)]
    df = spark.createDataFrame(rows, "t string, d string, n int").selectExpr("t", "to_date(d) as d", "n")
    own = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = series_positions(df, "t", "d")
        assert all(r["n"] == r["_pos"] for r in found.collect()) and found.columns == ["t", "d", "n", "_pos"]
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
        assert sum(" Exchange hashpartitioning" in line for line in plan.split("\n")) == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", own)
