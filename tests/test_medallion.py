"""End-to-end medallion run over small hand-made landings with known answers."""

import datetime as dt
import json
import math
import os

import pytest
from pyspark.sql import functions as F

from tidemark.plans.pipeline import Medallion
from tidemark.sources import landing as L


def _land(root, name, day, rows):
    os.makedirs(f"{root}/{name}", exist_ok=True)
    with open(f"{root}/{name}/{day}.json", "w") as f:
        json.dump(rows, f)


@pytest.fixture(scope="module")
def medallion(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="tidemark-land-")
    days = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    closes = {"^GSPC": [100, 110, 99, 99], "AAPL": [10, 11, 12, 11], "MSFT": [20, 19, 19, 21],
              "ZZZ": [5, 6, 7, 8]}
    prices = [{"ticker": t, "date": d, "close": float(c[i]), "open": None, "volume": 1}
              for t, c in closes.items() for i, d in enumerate(days)]
    _land(root, "stock-prices", "2024-01-04", prices)
    # a re-delivery of AAPL on 01-04 with a later load wins
    _land(root, "stock-prices-late", "2024-01-05", [{"ticker": "AAPL", "date": "2024-01-04", "close": 13.0}])
    macro = [{"series_id": "DFF", "date": d, "value": v} for d, v in zip(days, [5.0, 5.0, 5.25, None])]
    macro += [{"series_id": "VIXCLS", "date": d, "value": v} for d, v in zip(days, [19.0, 20.0, 25.0, 15.0])]
    macro += [{"series_id": "DGS10", "date": "2024-01-02", "value": 4.0},
              {"series_id": "DGS2", "date": "2024-01-02", "value": 4.5}]
    _land(root, "fred-series", "2024-01-04", macro)
    crypto = [{"coin_id": c, "symbol": s, "name": c, "date": d, "price_usd": p, "market_cap": m}
              for c, s, series in (("bitcoin", "btc", [(40000.0, 800), (42000.0, 600)]),
                                   ("ethereum", "eth", [(2000.0, 200), (2100.0, 400)]))
              for d, (p, m) in zip(["2024-01-01", "2024-01-02"], series)]
    _land(root, "crypto-prices", "2024-01-02", crypto)
    _land(root, "fear-greed", "2024-01-02", [{"date": "2024-01-02", "value": 30, "classification": "Fear"}])
    _land(root, "stock-fundamentals", "2024-01-02", [
        {"ticker": "AAPL", "date": "2024-01-01", "market_cap": 1.0e12, "industry": "old"},
        {"ticker": "AAPL", "date": "2024-01-02", "market_cap": 2.5, "industry": "new"}])
    first = L.read_landing(spark, f"{root}/stock-prices", "yahoo_finance").select(*L.BRONZE_COLUMNS)
    late = L.read_landing(spark, f"{root}/stock-prices-late", "yahoo_finance").select(*L.BRONZE_COLUMNS) \
        .withColumn("_loaded_at", F.col("_loaded_at") + F.expr("INTERVAL 1 HOUR"))
    bronze = {"raw_stock_prices": first.unionByName(late)}
    for sub, name in (("fred-series", "raw_fred_series"), ("crypto-prices", "raw_crypto_prices"),
                      ("fear-greed", "raw_fear_greed"), ("stock-fundamentals", "raw_stock_fundamentals")):
        bronze[name] = L.read_landing(spark, f"{root}/{sub}", sub).select(*L.BRONZE_COLUMNS)
    seeds = {"tickers": spark.createDataFrame([("AAPL", "Apple", "Technology"), ("MSFT", "Microsoft", "Technology"),
                                               ("NOPE", "Missing", "Unmapped")], "ticker string, company_name string, sector string"),
             "sectors": spark.createDataFrame([("Technology", "Information Technology", "Software, hardware")],
                                              "yahoo_sector string, gics_sector string, description string")}
    return Medallion(bronze, seeds)


def test_latest_load_wins(medallion):
    r = medallion.ref("stg_daily_prices").filter("ticker = 'AAPL' and price_date = date'2024-01-04'").first()
    assert r.close_price == 13.0


def test_snapshot_values(medallion):
    s = {str(r.snapshot_date): r for r in medallion.ref("daily_market_snapshot").collect()}
    assert sorted(s) == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    assert s["2024-01-01"].sp500_return is None and math.isclose(s["2024-01-02"].sp500_return, 0.1)
    assert (s["2024-01-02"].advancers, s["2024-01-02"].decliners) == (1, 1)
    assert (s["2024-01-01"].advancers, s["2024-01-01"].decliners) == (0, 0)
    assert (s["2024-01-03"].advancers, s["2024-01-03"].decliners) == (1, 0)
    assert float(s["2024-01-01"].btc_dominance) == 80.0 and float(s["2024-01-02"].btc_dominance) == 60.0
    assert math.isclose(s["2024-01-02"].btc_return, 0.05) and s["2024-01-03"].btc_price is None
    assert s["2024-01-02"].fng_classification == "Fear" and s["2024-01-03"].fng_value is None
    assert s["2024-01-02"].is_inverted is True and math.isclose(s["2024-01-02"].spread_10y_2y, -0.5)
    assert s["2024-01-04"].fed_funds_rate is None


def test_regime_and_correlation(medallion):
    reg = {(r.rate_regime, r.vol_regime): r.num_days for r in medallion.ref("regime_analysis").collect()}
    assert reg == {("Holding", "Low Vol"): 2, ("Holding", "High Vol"): 2}
    corr = {(r.asset, r.macro_indicator): r for r in medallion.ref("macro_asset_correlation").collect()}
    assert len(corr) == 10
    assert corr[("SP500", "VIX")].n_obs == 3 and corr[("SP500", "VIX")].correlation is not None
    assert corr[("BTC", "VIX")].n_obs == 1 and corr[("BTC", "VIX")].correlation is None


def test_dims_and_sector(medallion):
    dim = {r.ticker: r for r in medallion.ref("dim_tickers").collect()}
    assert dim["AAPL"].industry == "new" and str(dim["AAPL"].market_cap) == "3"
    assert dim["NOPE"].gics_sector is None and dim["NOPE"].industry is None
    sp = {str(r.price_date): r for r in medallion.ref("sector_performance").collect()}
    assert sp["2024-01-02"].num_constituents == 2 and math.isclose(sp["2024-01-02"].avg_daily_return, (0.1 - 0.05) / 2)
    ap = medallion.ref("asset_prices")
    coin = ap.filter("asset_type = 'crypto'").collect()
    assert len(coin) == 4 and all(r.ma_20 is None for r in coin)
    assert ap.filter("asset_id = 'AAPL' and ma_20 is not null").count() == 4


def test_full_build_job(spark, tmpdir_path):
    from tidemark.plans import jobs
    land = os.path.join(tmpdir_path, "landing")
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    prices = [{"ticker": t, "date": d, "close": float(10 + i + (t == "AAPL"))} for t in ("^GSPC", "AAPL", "MSFT")
              for i, d in enumerate(days)]
    _land(land, "stock-prices", "2024-01-03", prices)
    _land(land, "fred-series", "2024-01-03", [{"series_id": "VIXCLS", "date": d, "value": 18.0} for d in days])
    _land(land, "fear-greed", "2024-01-03", [{"date": d, "value": 50, "classification": "Neutral"} for d in days])
    wh = os.path.join(tmpdir_path, "wh")
    rep = jobs.run(spark, land, wh, gate=True, export_csv=os.path.join(tmpdir_path, "csv"))
    assert all(r.failures == 0 for r in rep.collect())
    from tidemark.operators.incremental import read_current
    snap = read_current(spark, jobs.layer_path(wh, "gold", "daily_market_snapshot"))
    assert snap.select("snapshot_date").distinct().count() == 3
    # a second run with nothing new keeps the table and ingests no file twice
    jobs.run(spark, land, wh)
    assert spark.read.parquet(jobs.layer_path(wh, "bronze", "raw_stock_prices")).count() == 9
    assert jobs.layer_path(wh, None, "x").endswith("/PUBLIC/x")
    csv_rows = spark.read.option("header", True).csv(os.path.join(tmpdir_path, "csv", "regime_analysis"))
    assert csv_rows.count() >= 1


def test_views_for_sql_users(spark, medallion):
    medallion.register_views(["daily_market_snapshot", "regime_analysis"], prefix="t_")
    n = spark.sql("SELECT count(*) AS n FROM t_daily_market_snapshot WHERE sp500_close IS NOT NULL").first().n
    assert n == 4
    assert spark.sql("SELECT sum(num_days) AS d FROM t_regime_analysis").first().d == 4


def _closes(spark, wh, table, column="close_price"):
    from tidemark.plans import jobs
    layer = "silver" if table.startswith(("stg", "prices")) else "gold"
    return {str(r.price_date): r[column] for r in spark.read.parquet(jobs.layer_path(wh, layer, table)).collect()}


def test_backfill_window_bounds_ingest_only(spark, tmpdir_path):
    """A windowed run takes the window's files, and builds over all that was ever loaded."""
    from tidemark.plans import jobs
    land = os.path.join(tmpdir_path, "landing")
    for day, close in (("2024-01-02", 10.0), ("2024-01-03", 11.0), ("2024-01-04", 12.0)):
        _land(land, "stock-prices", day, [{"ticker": "AAPL", "date": day, "close": close}])
    wh = os.path.join(tmpdir_path, "wh")
    jobs.run(spark, land, wh, start="2024-01-02", end="2024-01-03", checks=False)
    assert sorted(_closes(spark, wh, "stg_daily_prices")) == ["2024-01-02", "2024-01-03"]
    jobs.run(spark, land, wh, start="2024-01-04", end="2024-01-04", checks=False)
    ma = _closes(spark, wh, "prices_with_technicals", "ma_20")
    assert ma == {"2024-01-02": 10.0, "2024-01-03": 10.5, "2024-01-04": 11.0}
    from tidemark.sources.landing import file_date
    assert file_date("/x/date=2024-01-05/part-0.json") == "2024-01-05" == file_date("s/2024-01-05.json")
    assert file_date("/2024-01-05/x/notes.json") is None


def test_late_day_needs_full_refresh_or_lookback(spark, tmpdir_path):
    from tidemark.plans import jobs
    land, wh = os.path.join(tmpdir_path, "landing"), os.path.join(tmpdir_path, "wh")
    _land(land, "stock-prices", "2024-01-02", [{"ticker": "AAPL", "date": "2024-01-02", "close": 10.0}])
    jobs.run(spark, land, wh, checks=False)
    _land(land, "stock-prices", "2024-01-01", [{"ticker": "AAPL", "date": "2024-01-01", "close": 9.0}])

    def days():
        from tidemark.operators.incremental import read_current
        return sorted(str(r.snapshot_date) for r in
                      read_current(spark, jobs.layer_path(wh, "gold", "daily_market_snapshot")).collect())
    jobs.run(spark, land, wh, checks=False)
    assert days() == ["2024-01-02"]
    jobs.run(spark, land, wh, checks=False, lookback_days=5)
    assert days() == ["2024-01-01", "2024-01-02"]
    jobs.run(spark, land, wh, checks=False, full_refresh=True)
    assert days() == ["2024-01-01", "2024-01-02"]


def test_own_seeds_and_unreadable_bronze(spark, tmpdir_path):
    from tidemark.plans import jobs
    land, wh, seeds = (os.path.join(tmpdir_path, n) for n in ("landing", "wh", "seeds"))
    os.makedirs(seeds)
    for name, text in (("tickers", "ticker,company_name,sector\nZZZ,Zed,Tech\n"),
                       ("sectors", 'yahoo_sector,gics_sector,description\nTech,IT,"soft, hard"\n'),
                       ("series", "series_id,series_name,frequency,unit,category\nDFF,Fed,Daily,Percent,Rates\n")):
        with open(f"{seeds}/{name}.csv", "w") as f:
            f.write(text)
    _land(land, "stock-prices", "2024-01-02", [{"ticker": "ZZZ", "date": "2024-01-02", "close": 10.0}])
    report = jobs.run(spark, land, wh, seeds=seeds)
    assert report.count() == len(jobs.TESTS) == 43 and report.filter("failures > 0").count() == 0
    sp = spark.read.parquet(jobs.layer_path(wh, "gold", "sector_performance")).collect()
    assert [(r.gics_sector, r.num_constituents) for r in sp] == [("IT", 1)]
    fresh = spark.read.parquet(jobs.layer_path(wh, "gold", "freshness_report"))
    assert fresh.count() == 5 and fresh.filter("status = 'pass'").count() == 1
    bronze = jobs.layer_path(wh, "bronze", "raw_stock_prices")
    part = next(f for f in os.listdir(bronze) if f.endswith(".parquet"))
    with open(f"{bronze}/{part}", "wb") as f:
        f.write(b"broken")
    with pytest.raises(Exception):
        jobs.run(spark, land, wh, seeds=seeds)
