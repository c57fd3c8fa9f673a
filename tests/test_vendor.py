"""Vendor payload normalisation, dashboard matrices, JSON rows, inflation regime."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tidemark.plans import extras as X
from tidemark.plans import reports as RP
from tidemark.sources import vendor as V


def test_flatten_observations_with_sentinels(spark):
    payload = {"observations": [{"date": "2024-01-01", "value": "5.33"}, {"date": "2024-01-02", "value": "."},
                                {"date": "2024-01-03", "value": ""}]}
    df = spark.createDataFrame([("DFF", json.dumps(payload))], "series_id string, p string") \
        .select("series_id", F.parse_json("p").alias("payload"))
    series = spark.createDataFrame([("DFF", "Fed funds")], "series_id string, series_name string")
    got = sorted((r.date, r.value, r.series_name) for r in V.flatten_observations(df, series).collect())
    assert got == [("2024-01-01", 5.33, "Fed funds"), ("2024-01-02", None, "Fed funds"),
                   ("2024-01-03", None, "Fed funds")]


def test_readings_window_inclusive(spark):
    df = spark.createDataFrame([("1704067200", "40", "Fear"), ("1704326400", "60", "Greed"),
                                ("1704412800", "70", "Greed")], "timestamp string, value string, value_classification string")
    got = [r.date for r in V.readings_to_daily(df, "2024-01-01", "2024-01-04").collect()]
    assert got == [dt.date(2024, 1, 1), dt.date(2024, 1, 4)]


def test_downsample_and_align(spark):
    day = 1704067200000
    prices = spark.createDataFrame([("btc", day + 10, 1.0, 0), ("btc", day + 20, 2.0, 1), ("btc", day + 20, 3.0, 2),
                                    ("btc", day + 86_400_000, 4.0, 3)], "k string, ts long, price double, pos long")
    caps = spark.createDataFrame([("btc", day + 20, 100.0, 0), ("btc", day + 20, 200.0, 1)],
                                 "k string, ts long, cap double, pos long")
    vols = spark.createDataFrame([("btc", day + 10, 5.0, 0)], "k string, ts long, vol double, pos long")
    out = {str(r.date): r for r in V.align_series(prices, "k", "ts", "price", [caps, vols], ["cap", "vol"]).collect()}
    assert out["2024-01-01"].price == 2.0 and out["2024-01-01"].cap == 200.0 and out["2024-01-01"].vol is None
    assert out["2024-01-02"].price == 4.0 and out["2024-01-02"].cap is None


def test_stamp_topn_normalise(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 5.0), ("c", 5.0)], "id string, mc double")
    assert [r.id for r in V.top_n_by(df, "mc", 2, tie="id").collect()] == ["b", "c"]
    assert V.stamp(df, "2024-01-05").first().date == "2024-01-05"
    raw = spark.createDataFrame([(1.0, 2.0)], "Open double, `Adj Close` double")
    assert V.normalise_ohlcv(raw, {"Open": "open", "Adj Close": "adj_close"}).columns == ["open", "adj_close"]


def test_sector_matrix_and_json_rows(spark):
    df = spark.createDataFrame([("Energy", "2024-01-02", 0.01), ("Energy", "2024-01-03", -0.02)],
                               "gics_sector string, price_date string, avg_daily_return double") \
        .withColumn("price_date", F.to_date("price_date"))
    m = RP.sector_matrix(df, ["2024-01-02", "2024-01-03"]).first()
    assert abs(m["2024-01-02"] - 1.0) < 1e-12 and abs(m["2024-01-03"] + 2.0) < 1e-12
    js = json.loads(RP.json_rows(df.withColumn("d", F.lit(1).cast("decimal(10,2)"))).first().json)
    assert js["price_date"] == "2024-01-02" and js["d"] == 1.0


def test_inflation_regime(spark):
    df = spark.createDataFrame([("2024-01-01", 300.0), ("2024-02-01", 301.0), ("2024-02-15", None),
                                ("2024-03-01", 301.0), ("2024-04-01", 300.5)], "observation_date string, cpi double") \
        .withColumn("observation_date", F.to_date("observation_date"))
    got = [r.inflation_regime for r in X.inflation_regime(df).orderBy("observation_date").collect()]
    assert got == ["Stable", "Rising", "Stable", "Falling"]
