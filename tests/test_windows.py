"""Window operators: dedup, returns, indicators, shares and global-order frames."""

import contextlib
import io
import math
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.indicators import bollinger, moving_average, rsi
from tidemark.operators import windows as W


def test_dedup_latest_is_deterministic_on_ties(spark):
    df = spark.createDataFrame([("A", 1, "f1", 10.0), ("A", 1, "f2", 11.0), ("A", 2, "f1", 9.0),
                                ("B", 5, "f1", 1.0)], "k string, t int, f string, v double")
    out = W.dedup_latest(df, "k", [F.col("t").desc_nulls_first(), F.col("f").desc_nulls_first()])
    assert sorted(tuple(r) for r in out.collect()) == [("A", 2, "f1", 9.0), ("B", 5, "f1", 1.0)]
    tie = W.dedup_latest(df.filter("t = 1"), "k", [F.col("t").desc(), F.col("f").desc()])
    assert tie.first().f == "f2"
    again = W.dedup_latest(out, "k", [F.col("t").desc_nulls_first()])
    assert sorted(again.collect()) == sorted(out.collect())


def test_latest_per_key_null_date_wins(spark):
    df = spark.createDataFrame([("A", "2024-01-02"), ("A", None)], "k string, d string") \
        .withColumn("d", F.to_date("d"))
    assert W.latest_per_key(df, "k", "d").first().d is None


def test_returns_first_row_and_zero_prev(spark):
    df = spark.createDataFrame([("A", 1, 0.0), ("A", 2, 5.0), ("A", 3, 10.0), ("B", 1, 3.0)],
                               "k string, t int, v double")
    out = {(r.k, r.t): r for r in W.with_returns(df, "v", "k", "t").collect()}
    assert out[("A", 1)].daily_return is None and out[("A", 1)].daily_change is None
    assert out[("A", 2)].daily_return is None and out[("A", 2)].daily_change == 5.0
    assert out[("A", 3)].daily_return == 1.0 and out[("B", 1)].prev_value is None


def test_moving_average_partial_frame_and_nulls(spark):
    df = spark.createDataFrame([("A", 1, 1.0), ("A", 2, None), ("A", 3, 3.0), ("A", 4, 5.0)],
                               "k string, t int, v double")
    got = [r.m for r in df.select("t", moving_average("v", "k", "t", 2).alias("m")).orderBy("t").collect()]
    assert got == [1.0, 1.0, 3.0, 4.0]


def test_rsi_rules(spark):
    gains = [("up", i, float(i)) for i in range(1, 6)]
    losses = [("down", i, float(10 - i)) for i in range(1, 6)]
    flat = [("flat", i, 1.0) for i in range(1, 6)]
    df = spark.createDataFrame(gains + losses + flat, "k string, t int, v double")
    r = W.with_returns(df, "v", "k", "t").select("k", "t", rsi("daily_change", "k", "t", 14).alias("rsi"))
    last = {x.k: x.rsi for x in r.filter("t = 5").collect()}
    assert last["up"] is None and last["down"] == 0.0 and last["flat"] is None


def test_bollinger_one_row_null_and_ordering(spark):
    random.seed(1)
    data = [("A", i, 100 + random.random() * 10) for i in range(40)]
    df = spark.createDataFrame(data, "k string, t int, v double")
    m, u, lo = bollinger("v", "k", "t", 20, 2)
    out = df.select("t", m.alias("m"), u.alias("u"), lo.alias("lo")).orderBy("t").collect()
    assert out[0].u is None and out[0].lo is None and out[0].m == data[0][2]
    assert all(r.lo <= r.m <= r.u for r in out[1:])


def test_share_of_total_sums_to_100(spark):
    df = spark.createDataFrame([("d1", "a", 1.0), ("d1", "b", 3.0), ("d2", "a", 0.0), ("d3", "a", 2.0)],
                               "d string, k string, v double")
    out = W.share_of_total(df, "v", "d")
    sums = {r.d: r.s for r in out.groupBy("d").agg(F.sum("share_pct").alias("s")).collect()}
    assert math.isclose(sums["d1"], 100.0) and sums["d2"] is None and math.isclose(sums["d3"], 100.0)


def test_global_lag_equals_window_lag(spark):
    random.seed(2)
    days = spark.range(0, 900).select(F.date_add(F.to_date(F.lit("2019-12-25")), F.col("id").cast("int")).alias("d"),
                                      (F.rand(3) * 10).alias("x"))
    ours = W.lag_k(days, "x", 5, "d", out="prev")
    ref = days.withColumn("prev_ref", F.lag("x", 5).over(Window.orderBy("d")))
    joined = ours.join(ref, "d")
    assert joined.count() == 900
    assert joined.filter(~F.col("prev").eqNullSafe(F.col("prev_ref"))).count() == 0


def test_global_frames_equal_plain_window(spark):
    days = spark.range(0, 700).select(F.date_add(F.to_date(F.lit("2020-01-01")), F.col("id").cast("int")).alias("d"),
                                      (F.rand(5) * 10).alias("x"))
    ours = W.global_frames(days, "d", 30, lambda f: [F.sum("x").over(f(30)).alias("s30"),
                                                     F.sum("x").over(f(7)).alias("s7")], bucket_rows=64)
    w = Window.orderBy("d")
    ref = days.select("d", F.sum("x").over(w.rowsBetween(-29, 0)).alias("r30"),
                      F.sum("x").over(w.rowsBetween(-6, 0)).alias("r7"))
    j = ours.join(ref, "d").collect()
    assert len(j) == 700
    assert all(math.isclose(r.s30, r.r30, rel_tol=1e-9) and math.isclose(r.s7, r.r7, rel_tol=1e-9) for r in j)


def test_forward_fill_global_equals_plain(spark):
    df = spark.range(0, 800).select(
        F.date_add(F.to_date(F.lit("2018-06-01")), F.col("id").cast("int")).alias("d"),
        F.when(F.rand(7) < 0.1, F.col("id").cast("double")).alias("x"))
    ours = W.forward_fill_global(df, "d", ["x"])
    ref = df.select("d", F.last("x", ignorenulls=True).over(
        Window.orderBy("d").rowsBetween(Window.unboundedPreceding, 0)).alias("r"))
    j = ours.join(ref, "d")
    assert j.count() == 800 and j.filter(~F.col("x").eqNullSafe(F.col("r"))).count() == 0


def test_technicals_single_exchange_for_all_indicators(spark):
    df = spark.createDataFrame([("A", i, float(i % 7)) for i in range(50)], "ticker string, t int, close double")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        W.with_technicals(df, "close", "ticker", "t").explain()
    assert buf.getvalue().count("Exchange hashpartitioning") <= 1


def test_prefix_moving_averages_match_frames(spark):
    random.seed(4)
    data = [("A" if i % 3 else "B", i, None if i % 11 == 0 else random.random() * 100) for i in range(400)]
    df = spark.createDataFrame(data, "k string, t int, v double")
    ours = W.prefix_moving_averages(df, "v", "k", "t", [5, 50])
    ref = df.select("k", "t", moving_average("v", "k", "t", 5).alias("r5"),
                    moving_average("v", "k", "t", 50).alias("r50"))
    for r in ours.join(ref, ["k", "t"]).collect():
        for a, b in ((r.ma_5, r.r5), (r.ma_50, r.r50)):
            assert (a is None and b is None) or math.isclose(a, b, rel_tol=1e-12)


def test_dedup_plans_partial_group_limit_before_shuffle(spark):
    df = spark.createDataFrame([("A", 1, 1.0), ("A", 2, 2.0), ("B", 1, 3.0)], "k string, t int, v double")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        W.dedup_latest(df, "k", [F.col("t").desc_nulls_first()]).explain()
    plan = buf.getvalue()
    assert plan.count("WindowGroupLimit") == 2
    # the partial limit sits below the exchange
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_share_of_total_uses_aggregate_not_window(spark):
    df = spark.createDataFrame([("d1", 1.0), ("d1", 3.0)], "d string, v double")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        W.share_of_total(df, "v", "d").explain()
    assert "Window" not in buf.getvalue() and "HashAggregate" in buf.getvalue()


def test_rows_without_order_come_last(spark):
    rows = [(None, 99.0)] + [(f"2023-12-{d:02d}", float(d)) for d in (30, 31)] + [("2024-01-01", None)]
    df = spark.createDataFrame(rows, "d string, v double").withColumn("d", F.to_date("d"))
    got = {str(r.d): r.v_lag1 for r in W.lag_k(df, "v", 1, "d").collect()}
    assert got == {"2023-12-30": None, "2023-12-31": 30.0, "2024-01-01": 31.0, "None": None}
    filled = {str(r.d): r.v for r in W.forward_fill_global(df, "d", ["v"]).collect()}
    assert filled == {"2023-12-30": 30.0, "2023-12-31": 31.0, "2024-01-01": 31.0, "None": 99.0}


def test_frames_wider_than_a_bucket(spark):
    df = spark.range(50).select(F.date_add(F.to_date(F.lit("2024-01-01")), F.col("id").cast("int")).alias("d"),
                                F.col("id").cast("double").alias("v"))
    got = W.global_frames(df, "d", 10, lambda frame: [F.sum("v").over(frame(10)).alias("s")], bucket_rows=4)
    assert [r.s for r in got.orderBy("d").collect()] == [float(sum(range(max(0, i - 9), i + 1))) for i in range(50)]
