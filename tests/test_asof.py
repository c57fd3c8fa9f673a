"""As-of alignment against plain Python and DuckDB's ASOF join."""

import datetime as dt
import random

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join, carry_forward, series_days


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def test_ties_nulls_buckets_and_staleness(spark):
    left = [("a", 0), ("a", 40), ("a", 41), ("b", 10), (None, 70), ("c", 5), ("a", None), ("a", 40)]
    right = [("a", 40, 1.0), ("a", 40, 2.0), ("a", 3, 9.0), ("b", 11, 5.0), (None, 1, 7.0), ("a", None, 3.0), ("b", 10, None)]
    lf = spark.createDataFrame([(k, None if n is None else day(n), i) for i, (k, n) in enumerate(left)], "k string, d date, i int")
    rt = spark.createDataFrame([(k, None if n is None else day(n), v) for k, n, v in right], "k string, d date, v double")

    def want(k, n, strict, limit):
        if n is None:
            return None, None
        seen = [(m, (v is not None, v or 0), v) for r, m, v in right
                if r == k and m is not None and (m < n if strict else m <= n)]
        if not seen or (limit is not None and n - max(seen)[0] > limit):
            return None, None
        return day(max(seen)[0]), max(seen)[2]

    for strict in (False, True):
        for limit in (None, 30):
            for bucket in (None, F.lit(0), F.date_trunc("week", F.col("_t"))):
                out = asof_join(lf, rt, "k", "d", ["v"], strict=strict, max_age_days=limit, bucket=bucket)
                assert out.columns == ["k", "d", "i", "as_of", "v"]
                got = {r["i"]: (r["as_of"], r["v"]) for r in out.collect()}
                assert got == {i: want(k, n, strict, limit) for i, (k, n) in enumerate(left)}


def test_hot_series_over_years_equals_asof(spark):
    """One series with a third of all rows, timestamps, values missing on most days."""
    r = random.Random(2)
    keys = ["HOT"] * 3 + [f"K{i}" for i in range(6)]
    at = lambda: dt.datetime(2015, 1, 1) + dt.timedelta(minutes=r.randrange(3_000_000))
    lp = pd.DataFrame([(r.choice(keys), at()) for _ in range(6000)], columns=["k", "t"]).drop_duplicates()
    rp = pd.DataFrame([(r.choice(keys), at(), r.random()) for _ in range(1500)], columns=["k", "t", "v"]).drop_duplicates(["k", "t"])
    out = asof_join(spark.createDataFrame(lp), spark.createDataFrame(rp), "k", "t", ["v"])
    want = duckdb.sql("SELECT l.k, l.t, r.t AS as_of, r.v FROM lp l ASOF LEFT JOIN rp r ON l.k = r.k AND l.t >= r.t").df()
    got = out.toPandas()[["k", "t", "as_of", "v"]]
    order = lambda x: x.sort_values(["k", "t"]).reset_index(drop=True).astype({"t": "datetime64[us]", "as_of": "datetime64[us]"})
    pd.testing.assert_frame_equal(order(got), order(want), check_dtype=False)
    plan = asof_join(spark.createDataFrame(lp), spark.createDataFrame(rp), "k", "t", ["v"])._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_k0" in plan and "_b#" in plan and "Join Cross" not in plan


def test_monthly_series_on_trading_days(spark):
    obs = spark.createDataFrame([("cpi", day(0), 1.0), ("cpi", day(31), None), ("cpi", day(60), 3.0), ("gdp", day(20), 9.0)],
                                "series string, at date, v double")
    days = spark.createDataFrame([(day(n),) for n in (1, 2, 2, 45, 61, 90)], "date_day date")
    rows = {(r["series"], r["date_day"]): (r["v"], r["as_of"], r["age_days"])
            for r in carry_forward(obs, "series", "at", "v", last_day=F.lit(day(70)), days=days, max_age_days=40).collect()}
    assert rows == {("cpi", day(1)): (1.0, day(0), 1), ("cpi", day(2)): (1.0, day(0), 2), ("cpi", day(45)): (None, None, None),
                    ("cpi", day(61)): (3.0, day(60), 1), ("gdp", day(45)): (9.0, day(20), 25), ("gdp", day(61)): (None, None, None)}
    assert series_days(obs, "series", "at").count() == 61 + 41
    assert carry_forward(obs.limit(0), "series", "at", "v").collect() == []
