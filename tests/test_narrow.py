"""Staged tables in some of their columns: the rows of the whole ones, without shuffling the others."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import tail_state as TS
from tidemark.operators.frames import first_in_task
from tidemark.operators.windows import latest_per_key
from tidemark.plans import jobs as J
from tidemark.plans import medallion as M
from tidemark.plans import registry as R
from tidemark.plans.pipeline import BRONZE_TABLES, Medallion
from tidemark.sources.seeds import default_seed


def _bronze(spark, days=3, tickers=("A", "B", None)):
    """Loads of few keys with many ties in time, file and the first values; NULLs in every column."""
    r, rows = random.Random(5), []
    for ticker, day in itertools.product(tickers, [None, *range(days)]):
        for _ in range(12):
            some = lambda *v: r.choice([None, *v])
            rows.append((ticker, None if day is None else str(dt.date(2024, 1, 1) + dt.timedelta(days=day)), some(1.0, 2.0),
                         some(1.0, 2.0), some(1.0, 2.0), some(1.0, 2.0, 3.0), some(1.0, 2.0), some(5, 6), some(10, 20), some(1.5, 2.5),
                         some("x", "y"), r.randint(1, 2), some("f1", "f2")))
    df = spark.createDataFrame(rows, "ticker string, date string, open double, high double, low double, close double, adj_close double,"
                                     "volume long, market_cap long, pe_ratio double, industry string, seq long, file string")
    fields = [c for c in df.columns if c not in ("seq", "file")]
    return df.select(F.to_variant_object(F.struct(*fields)).alias("raw_data"), F.lit("s").alias("source"),
                     F.timestamp_seconds("seq").cast("timestamp_ntz").alias("_loaded_at"), F.col("file").alias("_file_name")).repartition(4)


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("columns", [("ticker", "price_date", "close_price"), ("price_date", "loaded_at"), ("low_price", "open_price"),
                                     ("ticker", "volume")])
def test_narrow_prices_are_columns_of_the_whole_ones(spark, columns):
    bronze = _bronze(spark)
    found = M.stg_daily_prices(bronze, columns=columns)
    assert found.columns == list(columns) and _rows(found) == _rows(M.stg_daily_prices(bronze).select(*columns))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert ("$.volume" in plan) == ("volume" in columns)


def test_narrow_table_serves_its_consumers(spark):
    bronze = {"raw_stock_prices": _bronze(spark), "raw_stock_fundamentals": _bronze(spark)}
    m, whole = Medallion(bronze, {}).narrow("stg_daily_prices", "ticker", "price_date", "close_price"), Medallion(bronze, {})
    stored = m.stored("stg_daily_prices")
    assert stored.columns == ["ticker", "price_date", "close_price"]
    t = m.ref("prices_with_technicals")
    assert set(whole.ref("prices_with_technicals").columns) - set(t.columns) == {
        "open_price", "high_price", "low_price", "adj_close_price", "volume"}
    assert _rows(t) == _rows(whole.ref("prices_with_technicals").select(*t.columns))
    with pytest.raises(ValueError):
        m.narrow("stg_daily_prices", "ticker")
    with pytest.raises(ValueError):
        m.narrow("stg_macro", "value")


def test_newest_fundamentals_drop_older_days_before_the_exchange(spark):
    bronze = _bronze(spark, 5, ("A", "B", "C", None))
    dated = bronze.filter(F.variant_get("raw_data", "$.date", "string").isNotNull()
                          | (F.variant_get("raw_data", "$.ticker", "string") == "C"))
    found = M.newest_fundamentals(dated)
    want = latest_per_key(M.stg_fundamentals(dated), "ticker", "snapshot_date")
    assert _rows(found) == _rows(want) and found.count() == 4 and found.filter("snapshot_date is null").count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString().split("\n")
    exchanges = [i for i, line in enumerate(plan) if "Exchange hashpartitioning" in line]
    assert "WindowGroupLimit" in plan[exchanges[-1] + 1] and "rank(" in plan[exchanges[-1] + 1] and "Partial" in plan[exchanges[-1] + 1]
    m = Medallion({"raw_stock_fundamentals": dated}, {
        "tickers": spark.createDataFrame([("A", "a", "s"), ("C", "c", "s"), ("D", "d", "s")], "ticker string, company_name string, sector string"),
        "sectors": spark.createDataFrame([("s", "g", "")], "yahoo_sector string, gics_sector string, description string")})
    got = m.ref("dim_tickers")
    assert _rows(got) == _rows(M.dim_tickers(m.seeds["tickers"], M.stg_fundamentals(dated), m.seeds["sectors"]))


def _medallion(spark, bronze):
    seeds = {"tickers": spark.createDataFrame([("A", "a", "s"), ("B", "b", "s"), ("D", "d", "s")],
                                              "ticker string, company_name string, sector string"),
             "sectors": spark.createDataFrame([("s", "g", "")], "yahoo_sector string, gics_sector string, description string"),
             "series": default_seed(spark, "series")}
    return Medallion(dict.fromkeys(BRONZE_TABLES, bronze), seeds)


@pytest.mark.parametrize("name", ["macro_overlay_carried", "sector_vs_index", "dq_report"])
def test_queries_stage_closes_alone(spark, monkeypatch, name):
    """They shuffle and store no price column that they do not read, and their rows are those over the whole tables."""
    made, bronze = [], _bronze(spark)
    monkeypatch.setattr(R, "_m", lambda s, d: made.append(_medallion(s, bronze)) or made[-1])
    found = R.REGISTRY[name].build(spark, "")
    assert made[0].ref("stg_daily_prices").columns == ["ticker", "price_date", "close_price"]
    assert "prices_with_technicals" not in made[0]._kept
    got = _rows(found)
    monkeypatch.setattr(Medallion, "narrow", lambda m, *a: m)
    assert got == _rows(R.REGISTRY[name].build(spark, "")) and len(got) == {"dq_report": len(J.TESTS)}.get(name, 4)


def test_technicals_of_loads_are_those_of_the_latest(spark, tmpdir_path):
    """One exchange, by ticker, dedups the loads and computes the frames; runs over them are a rebuild and copy no input."""
    bronze = _bronze(spark, 40, ("A", "B", "C"))
    bronze = bronze.filter(F.variant_get("raw_data", "$.date", "string").isNotNull())
    loads, want = M.price_loads(bronze), M.prices_with_technicals(M.stg_daily_prices(bronze))
    found = M.technicals_of_loads(loads)
    assert _rows(found.select(*want.columns)) == _rows(want) and want.count() == 120
    plan = found._jdf.queryExecution().executedPlan().toString()
    # beside the one of the rows of this test
    assert plan.count("Exchange") - plan.count("RoundRobin") == 1 and "Exchange hashpartitioning(ticker#" in plan
    for until in ("2023-12-31", "2024-01-05", "2024-01-31", "2100-01-01"):
        out = TS.append_technicals(loads.filter(F.col("price_date") <= F.lit(until).cast("date")), f"{tmpdir_path}/t",
                                   compute=M.technicals_of_loads, stored=True)
    assert _rows(out.select(*want.columns)) == _rows(want) and "loaded_at" not in out.columns


def test_first_in_task_across_batches(spark):
    rows = spark.range(0, 30_000, 1, 2).select((F.col("id") % 7000).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("j"),
                                               F.col("id").alias("v"))
    rows = rows.withColumn("k", F.when(F.col("k") > 0, F.col("k")))
    found = first_in_task(rows.coalesce(1), ["k", "j"], [F.col("v").desc()])
    want = rows.groupBy("k", "j").agg(F.max("v").alias("v"))
    assert found.columns == ["k", "j", "v"] and _rows(found) == _rows(want)
    assert first_in_task(rows.limit(0), ["k"], [F.col("v")]).count() == 0


def test_incremental_query_stores_no_staged_prices(spark, monkeypatch):
    made, bronze = [], _bronze(spark, 6)
    monkeypatch.setattr(R, "_m", lambda s, d: made.append(_medallion(s, bronze)) or made[-1])
    found = R.REGISTRY["incremental_technicals"].build(spark, "")
    assert not made[0]._kept and found.count() == 18 and found.columns == M.TECHNICAL_COLUMNS
