"""Edge rules of the scalar and aggregate expressions (literal frames)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.functions.aggregates import pair_corr, pair_count


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_safe_divide_zero_is_null_and_scale_first(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 4.0), (None, 1.0)], "a double, b double")
    out = rows(df.select(S.safe_divide("a", "b"), S.safe_divide(F.lit(100) * F.col("a"), "b")))
    assert out == [(None, None), (0.5, 50.0), (None, None)]


def test_safe_divide_decimal_multiplies_first(spark):
    df = spark.createDataFrame([(2, 3)], "a int, b int").select(
        F.col("a").cast("decimal(38,0)").alias("a"), F.col("b").cast("decimal(38,0)").alias("b"))
    v = df.select(S.safe_divide(F.lit(100) * F.col("a"), "b")).first()[0]
    assert str(v) == "66.666667"


def test_sentinels_and_nan(spark):
    df = spark.createDataFrame([(".",), ("",), (None,), ("1.5",)], "v string")
    assert [r[0] for r in df.select(S.sentinel_to_null("v")).collect()] == [None, None, None, 1.5]
    df2 = spark.createDataFrame([("NaN",), ("abc",), ("2",)], "v string")
    assert [r[0] for r in df2.select(S.nan_to_null("v")).collect()] == [None, None, 2.0]


def test_trunc_int_truncates_toward_zero(spark):
    df = spark.createDataFrame([(2.7,), (-2.7,), (None,)], "v double")
    assert [r[0] for r in df.select(S.trunc_int("v")).collect()] == [2, -2, None]


def test_epoch_to_utc_date(spark):
    df = spark.createDataFrame([(0,), (86399,), (86400,), (1704067200,)], "s long")
    got = [r[0] for r in df.select(S.epoch_to_date("s")).collect()]
    assert got == [dt.date(1970, 1, 1), dt.date(1970, 1, 1), dt.date(1970, 1, 2), dt.date(2024, 1, 1)]
    ms = spark.createDataFrame([(1704067199999,)], "m long").select(S.epoch_ms_to_date("m")).first()[0]
    assert ms == dt.date(2023, 12, 31)


def test_period_days(spark):
    df = spark.createDataFrame([("1w",), ("3M",), ("YTD",), ("bogus",)], "p string")
    assert [r[0] for r in df.select(S.period_days("p")).collect()] == [7, 90, 365, 30]
    assert S.period_days_value("6m") == 180


def test_corr_interpretation(spark):
    df = spark.createDataFrame([(0.65,), (-0.3,), (0.1,), (0.0,), (None,)], "c double")
    got = [r[0] for r in df.select(S.corr_interpretation("c")).collect()]
    assert got == ["strong positive correlation", "moderate negative correlation",
                   "weak positive correlation", "weak negative correlation",
                   "insufficient overlapping data to compute"]


def test_regime_labels_null_rules(spark):
    df = spark.createDataFrame([(2.0, 1.0, 25.0), (1.0, 2.0, 20.0), (1.0, None, None), (None, 1.0, 19.9)],
                               "cur double, prev double, vix double")
    got = rows(df.select(S.rate_regime("cur", "prev"), S.vol_regime("vix")))
    assert got == [("Hiking", "High Vol"), ("Cutting", "High Vol"), ("Holding", "Low Vol"),
                   ("Holding", "Low Vol")]


def test_score_band_edges(spark):
    df = spark.createDataFrame([(0,), (24,), (25,), (45,), (54,), (55,), (75,), (100,), (None,)], "v int")
    got = [r[0] for r in df.select(S.score_band("v")).collect()]
    assert got == ["Extreme Fear", "Extreme Fear", "Fear", "Neutral", "Neutral", "Greed",
                   "Extreme Greed", "Extreme Greed", None]


def test_inversion_label(spark):
    df = spark.createDataFrame([(-0.1,), (0.0,), (None,)], "s double")
    assert [r[0] for r in df.select(S.inversion_label("s")).collect()] == ["Inverted", "Normal", "Normal"]


def test_pair_corr_rules(spark):
    data = [(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 6.3, 5.0), (4.0, None, 5.0), (None, 1.0, None)]
    df = spark.createDataFrame(data, "a double, b double, k double")
    r = df.agg(pair_corr("a", "b").alias("ab"), pair_count("a", "b").alias("n"),
               pair_corr("a", "k").alias("constant"),
               pair_corr("a", "b", min_obs=4).alias("too_few")).first()
    expected = df.filter("a is not null and b is not null").agg(F.corr("a", "b")).first()[0]
    assert math.isclose(r.ab, expected, rel_tol=1e-12)
    assert r.n == 3 and r.constant is None and r.too_few is None


def test_strict_cast_raises_under_ansi(spark):
    df = spark.createDataFrame([("abc",)], "v string")
    with pytest.raises(Exception):
        df.select(S.sentinel_to_null("v")).collect()
