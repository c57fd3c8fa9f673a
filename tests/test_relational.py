"""Relational operators: pivots, breadth, statistics, best/worst, spines, reports."""

import datetime as dt
import math
import statistics

from pyspark.sql import functions as F

from tidemark.operators import relational as R
from tidemark.plans import reports as RP


def test_pivot_long_fixed_list_absent_name_is_null(spark):
    df = spark.createDataFrame([("d1", "DFF", 1.0), ("d1", "DGS2", 2.0), ("d2", "DFF", 3.0)],
                               "d string, s string, v double")
    out = R.pivot_long(df, "d", "s", "v", {"DFF": "ff", "DGS2": "t2", "GDPC1": "gdp"})
    got = {r.d: (r.ff, r.t2, r.gdp) for r in out.collect()}
    assert got == {"d1": (1.0, 2.0, None), "d2": (3.0, None, None)}


def test_breadth_duplicate_seed_counts_twice(spark):
    t = spark.createDataFrame([("d1", "A", 0.1), ("d1", "B", -0.1), ("d1", "X", 0.5), ("d2", "A", None)],
                              "d string, ticker string, r double")
    seed = spark.createDataFrame([("A",), ("A",), ("B",)], "ticker string")
    got = {r.d: (r.advancers, r.decliners) for r in R.breadth(t, "r", "d", seed, "ticker").collect()}
    assert got == {"d1": (2, 1), "d2": (0, 0)}


def test_asset_stats_rules(spark):
    rows = [("a", "2024-01-01", None, None), ("a", "2024-01-02", 10.0, None), ("a", "2024-01-03", 11.0, 0.1),
            ("a", "2024-01-04", 12.1, 0.1), ("z", "2024-01-01", 0.0, None), ("z", "2024-01-02", 5.0, None),
            ("s", "2024-01-01", 3.0, 0.2)]
    df = spark.createDataFrame(rows, "id string, d string, close double, ret double").withColumn("d", F.to_date("d"))
    got = {r.id: r for r in R.asset_stats(df, "id", "d", "close", "ret").collect()}
    a = got["a"]
    assert a.num_days == 4 and a.latest_close == 12.1 and math.isclose(a.cumulative_return, 0.21)
    assert math.isclose(a.volatility, statistics.pstdev([0.1, 0.1]), abs_tol=1e-12)
    assert got["z"].cumulative_return is None and got["z"].volatility is None
    assert got["s"].cumulative_return is None and got["s"].avg_daily_return == 0.2


def test_best_worst_ties_zero_and_null(spark):
    rows = [("g", "2024-01-01", None), ("g", "2024-01-02", 0.5), ("g", "2024-01-03", 0.5),
            ("g", "2024-01-04", -0.2), ("g", "2024-01-05", 0.0), ("n", "2024-01-01", None),
            ("n", "2024-01-02", None)]
    df = spark.createDataFrame(rows, "g string, d string, v double").withColumn("d", F.to_date("d"))
    got = {r.g: r for r in R.best_worst(df, "g", "d", "v").collect()}
    assert got["g"].best_day.date == dt.date(2024, 1, 2) and got["g"].worst_day.date == dt.date(2024, 1, 4)
    assert got["n"].best_day.date == dt.date(2024, 1, 1) and got["n"].best_day["return"] is None
    z = spark.createDataFrame([("g", "2024-01-01", 0.0), ("g", "2024-01-02", -0.1)],
                              "g string, d string, v double").withColumn("d", F.to_date("d"))
    assert R.best_worst(z, "g", "d", "v").first().best_day.date == dt.date(2024, 1, 1)
    assert R.best_worst(z, "g", "d", "v", zero_is_missing=True).first().best_day.date == dt.date(2024, 1, 2)


def test_nested_series_is_date_ordered(spark):
    df = spark.createDataFrame([("s", "2024-01-03", 1.0), ("s", "2024-01-01", 2.0)],
                               "s string, d string, v double").withColumn("d", F.to_date("d"))
    arr = R.nested_series(df, "s", "d", ["v"]).first().daily_series
    assert [x.d for x in arr] == [dt.date(2024, 1, 1), dt.date(2024, 1, 3)]


def test_date_spine_excludes_end(spark):
    assert R.date_spine(spark, "2024-01-01", "2024-01-04").count() == 3
    assert R.date_spine(spark, "2024-01-01", "2024-01-04", inclusive=True).count() == 4
    b = spark.createDataFrame([("2024-02-27", "2024-03-01")], "s string, e string") \
        .select(F.to_date("s").alias("s"), F.to_date("e").alias("e"))
    assert R.spine_between(b, "s", "e", inclusive=False).count() == 3


def test_corr_matrix_skips_absent_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.5), (3.0, 5.0)], "x double, y double")
    out = R.corr_matrix(df, {"X": "x"}, {"Y": "y", "Z": "z"})
    rows = out.collect()
    assert len(rows) == 1 and rows[0].macro_indicator == "Y" and rows[0].n_obs == 3


def test_ilike_escape(spark):
    df = spark.createDataFrame([("50% off",), ("500 off",)], "t string")
    assert df.filter(R.ilike_contains("t", "0%")).count() == 2
    assert df.filter(R.ilike_contains("t", "0%", escape=True)).count() == 1


def test_corr_wide_duplicate_key_fails(spark):
    df = spark.createDataFrame([("SP500", "VIX", 0.1, 5), ("SP500", "VIX", 0.2, 5)],
                               "asset string, macro_indicator string, correlation double, n_obs long")
    try:
        RP.corr_wide(df, ["VIX"]).collect()
        raise AssertionError("expected failure")
    except Exception as e:  # noqa: BLE001
        assert "duplicate" in str(e)


def test_sector_report_fragment_and_window(spark):
    rows = [("Information Technology", "2024-03-01", 0.01, 2), ("Information Technology", "2024-03-20", 0.03, 2),
            ("Energy", "2024-03-20", 0.5, 1), ("Information Technology", "2023-01-01", 0.9, 2)]
    df = spark.createDataFrame(rows, "gics_sector string, price_date string, avg_daily_return double, "
                                     "num_constituents long").withColumn("price_date", F.to_date("price_date"))
    r = RP.sector_report(df, "TECH", "1M", as_of="2024-03-25").first()
    assert r.sector == "Information Technology" and r.num_days == 2
    assert r.best_day.date == dt.date(2024, 3, 20) and math.isclose(r.avg_daily_return, 0.02)
    assert [x.price_date for x in r.daily_series] == [dt.date(2024, 3, 1), dt.date(2024, 3, 20)]
