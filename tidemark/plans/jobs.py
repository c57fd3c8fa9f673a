"""End-to-end build: landing -> Bronze -> Silver -> Gold -> quality gate.

    python -m tidemark.plans.jobs --landing <dir> --warehouse <dir> [--start D --end D]
        [--seeds <dir>] [--full-refresh] [--lookback-days N]

Each layer is written under ``<warehouse>/<LAYER>/<table>``, each table once: later tables
and the checks read the stored ones. ``--start/--end`` bound which landing files are
ingested; the build always covers all of Bronze. The snapshot is maintained incrementally
(merge on snapshot_date).
"""

from __future__ import annotations

import argparse
import functools
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality as DQ
from tidemark.operators.incremental import merge_into
from tidemark.plans import medallion as M
from tidemark.plans.pipeline import Medallion
from tidemark.sources import landing as L
from tidemark.sources import seeds as SD
from tidemark.storage import has_data

LAYERS = {"bronze": ["raw_stock_prices", "raw_stock_fundamentals", "raw_fred_series", "raw_crypto_prices",
                     "raw_fear_greed"],
          "silver": ["stg_daily_prices", "stg_fundamentals", "stg_macro", "stg_crypto", "stg_fear_greed",
                     "prices_with_technicals", "macro_pivot", "yield_curve", "crypto_with_dominance",
                     "asset_daily_returns"],
          "gold": ["dim_tickers", "dim_sectors", "dim_macro_indicators", "daily_market_snapshot",
                   "regime_analysis", "sector_performance", "asset_prices", "macro_asset_correlation"]}


def layer_path(warehouse: str, layer: str | None, table: str, default: str = "PUBLIC") -> str:
    """``<warehouse>/<LAYER>/<table>``: a named layer is used as-is, upper-cased."""
    schema = default if layer is None else layer.strip().upper()
    return f"{warehouse.rstrip('/')}/{schema}/{table}"


#: Stored tables that are split into months of this column, so that reports on days read few files.
PARTITIONED = {"stg_daily_prices": "price_date", "prices_with_technicals": "price_date",
               "asset_daily_returns": "asset_date", "sector_performance": "price_date", "asset_prices": "price_date"}

#: The data tests of the build: table, test and its arguments.
TESTS = [
    ("stg_daily_prices", "unique_combo", ("ticker", "price_date")), ("stg_daily_prices", "not_null", "ticker"),
    ("stg_daily_prices", "not_null", "price_date"), ("stg_daily_prices", "range", ("close_price", 0, None)),
    ("stg_daily_prices", "future_dates", "price_date"),
    ("stg_fundamentals", "unique_combo", ("ticker", "snapshot_date")), ("stg_fundamentals", "not_null", "ticker"),
    ("stg_fundamentals", "not_null", "snapshot_date"), ("stg_fundamentals", "bounds", "market_cap"),
    ("stg_macro", "unique_combo", ("series_id", "observation_date")), ("stg_macro", "not_null", "series_id"),
    ("stg_macro", "not_null", "observation_date"),
    ("stg_crypto", "unique_combo", ("coin_id", "price_date")), ("stg_crypto", "not_null", "coin_id"),
    ("stg_crypto", "not_null", "price_date"), ("stg_crypto", "range", ("price_usd", 0, None)),
    ("stg_fear_greed", "unique", "reading_date"), ("stg_fear_greed", "not_null", "reading_date"),
    ("stg_fear_greed", "range", ("fng_value", 0, 100)),
    ("prices_with_technicals", "unique_combo", ("ticker", "price_date")),
    ("prices_with_technicals", "not_null", "ticker"), ("prices_with_technicals", "range", ("rsi_14", 0, 100)),
    ("crypto_with_dominance", "unique_combo", ("coin_id", "price_date")),
    ("crypto_with_dominance", "range", ("dominance_pct", 0, 100)),
    ("macro_pivot", "unique", "observation_date"), ("macro_pivot", "not_null", "observation_date"),
    ("yield_curve", "unique", "observation_date"), ("yield_curve", "not_null", "observation_date"),
    ("asset_daily_returns", "unique_combo", ("asset_type", "asset_id", "asset_date")),
    ("dim_tickers", "unique", "ticker"), ("dim_tickers", "not_null", "ticker"),
    ("dim_macro_indicators", "unique", "series_id"), ("dim_macro_indicators", "not_null", "series_id"),
    ("dim_sectors", "unique", "yahoo_sector"), ("dim_sectors", "not_null", "gics_sector"),
    ("daily_market_snapshot", "unique", "snapshot_date"), ("daily_market_snapshot", "not_null", "snapshot_date"),
    ("sector_performance", "unique_combo", ("gics_sector", "price_date")),
    ("regime_analysis", "not_null", "rate_regime"), ("regime_analysis", "not_null", "vol_regime"),
    ("asset_prices", "unique_combo", ("asset_type", "asset_id", "price_date")),
    ("macro_asset_correlation", "not_null", "asset"),
    ("macro_asset_correlation", "range", ("correlation", -1, 1)),
]

#: Bronze tables and the sources whose freshness is watched.
SOURCES = {"raw_stock_prices": "yahoo_finance", "raw_stock_fundamentals": "yahoo_fundamentals",
           "raw_fred_series": "fred", "raw_crypto_prices": "coingecko", "raw_fear_greed": "alternative_me"}


def _test_name(table: str, test: str, args) -> str:
    return f"{table}.{test}.{args if isinstance(args, str) else '+'.join(str(a) for a in args)}"


def row_tests(table: str, tests: Sequence[tuple] = TESTS, as_of: Column | None = None) -> dict[str, Column]:
    """Name and condition of failure of each test of a table that a row can fail by itself."""
    as_of = as_of if as_of is not None else F.current_date()
    bad = {"not_null": lambda c: F.col(c).isNull(), "range": lambda a: ~DQ.in_range(*a),
           "future_dates": lambda c: F.col(c) > as_of, "bounds": lambda c: DQ.out_of_bounds(c)}
    return {_test_name(t, test, args): bad[test](args) for t, test, args in tests if t == table and test in bad}


def quality_report(tables: Mapping[str, DataFrame] | Callable[[str], DataFrame], tests: Sequence[tuple] = TESTS,
                   as_of: Column | None = None, measured: Mapping[str, int] | None = None) -> DataFrame:
    """check_name and failures of every test. The row tests of a table are counted by one
    aggregate over it, or were ``measured`` while it was stored and read nothing here; key tests
    need one aggregate by key each, over the key's columns alone."""
    ref = tables if callable(tables) else tables.__getitem__
    measured = dict(measured or {})
    parts, done = [], []
    for table in dict.fromkeys(t for t, *_ in tests):
        rows = row_tests(table, tests, as_of)
        done += [(name, int(measured[name])) for name in rows if name in measured]
        rows = {name: bad for name, bad in rows.items() if name not in measured}
        for t, test, args in tests:
            if t == table and test in ("unique", "unique_combo"):
                keys = DQ.dq_unique(ref(table), args) if test == "unique" else DQ.dq_unique_combo(ref(table), list(args))
                parts.append(keys.agg(F.count("*").alias("failures")).select(
                    F.lit(_test_name(t, test, args)).alias("check_name"), "failures"))
        if rows:
            counts = ref(table).agg(*[F.count_if(bad).alias(f"n{i}") for i, bad in enumerate(rows.values())])
            parts.append(counts.select(F.explode(F.array(*[
                F.struct(F.lit(name).alias("check_name"), F.col(f"n{i}").alias("failures"))
                for i, name in enumerate(rows)])).alias("r")).select("r.check_name", "r.failures"))
    if done:
        spark = parts[0].sparkSession if parts else SparkSession.getActiveSession()
        parts.append(spark.createDataFrame(done, "check_name string, failures long"))
    return functools.reduce(DataFrame.unionByName, parts)


def freshness_report(bronze: Mapping[str, DataFrame], as_of: Column | None = None) -> DataFrame:
    """Age and status of every source's newest load."""
    return functools.reduce(DataFrame.unionByName, [
        DQ.dq_freshness(bronze[table], as_of=as_of, source=source) for table, source in SOURCES.items()])


def read_seeds(spark: SparkSession, folder: str | None) -> dict[str, DataFrame]:
    """Seed tables: ``<folder>/<name>.csv`` each, or the built-in ones where no folder is given."""
    if folder is None:
        return {n: SD.default_seed(spark, n) for n in SD.SEED_SCHEMAS}
    return {n: SD.read_seed(spark, f"{folder.rstrip('/')}/{n}.csv", n) for n in SD.SEED_SCHEMAS}


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """A Bronze table; one that no landing ever reached is empty, an unreadable one fails the run."""
    if not has_data(spark, path):
        return spark.createDataFrame([], "raw_data variant, source string, _loaded_at timestamp_ntz, _file_name string")
    return spark.read.parquet(path)


def store(df: DataFrame, path: str, day: str | None = None, tests: Mapping[str, Column] | None = None,
          measured: dict[str, int] | None = None) -> DataFrame:
    """Write a table whole and read it back, in months of ``day`` where one is given.

    The failures of ``tests`` (name -> condition) are counted by the tasks that write, after the
    last exchange, where a task that runs again counts once, and put into ``measured``.
    """
    schema, seen = df.schema, None
    if day:
        df = df.withColumn("_month", F.date_format(day, "yyyy-MM")).repartition(F.col("_month"))
    if tests:
        seen = Observation()
        df = df.observe(seen, *[F.count_if(bad).alias(f"n{i}") for i, bad in enumerate(tests.values())])
    out = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (out.partitionBy("_month") if day else out).parquet(path)
    if seen is not None and measured is not None:
        found = seen.get
        measured |= {name: found[f"n{i}"] for i, name in enumerate(tests)}
    return df.sparkSession.read.schema(schema).parquet(path).select(*schema.names)


def run(spark: SparkSession, landing: str, warehouse: str, start: str | None = None,
        end: str | None = None, gate: bool = True, export_csv: str | None = None, seeds: str | None = None,
        full_refresh: bool = False, lookback_days: int = 0, index_tickers: Mapping[str, str] = M.INDEX_TICKERS,
        btc_id: str = M.BTC_ID, checks: bool = True) -> DataFrame | None:
    """Ingest new landing files, rebuild Silver/Gold from all of Bronze, merge the snapshot, gate on checks.

    ``start`` and ``end`` bound the ingested files only. Returns the quality report (one row
    per check), which is stored beside the layers; without ``checks`` (and so without a gate) there is none.
    """
    bronze = {}
    for sub, table in L.SUBDIR_TO_TABLE.items():
        path = layer_path(warehouse, "bronze", table)
        L.ingest(spark, f"{landing.rstrip('/')}/{sub}", sub, path, start, end)
        bronze[table] = read_bronze(spark, path)
    m = Medallion(bronze, read_seeds(spark, seeds), index_tickers=index_tickers, btc_id=btc_id)

    def build(after):
        return M.daily_market_snapshot(m.ref("prices_with_technicals"), m.seeds["tickers"],
                                       m.ref("crypto_with_dominance"), m.ref("stg_fear_greed"),
                                       m.ref("macro_pivot"), None, m.index_tickers, m.btc_id, after=after)

    measured: dict[str, int] = {}
    for layer in ("silver", "gold"):
        for name in LAYERS[layer]:  # in the order of their parents
            path = layer_path(warehouse, layer, name)
            if name == "daily_market_snapshot":
                m.keep(name, merge_into(spark, path, build, "snapshot_date", lookback_days, full_refresh))
            else:
                m.keep(name, store(m.ref(name), path, PARTITIONED.get(name), row_tests(name) if checks else None, measured))
    if export_csv:
        for name in LAYERS["gold"]:
            m.ref(name).write.mode("overwrite").option("header", True).csv(f"{export_csv.rstrip('/')}/{name}")
    if not checks:
        return None
    report = store(quality_report(m.ref, measured=measured), layer_path(warehouse, "gold", "quality_report"))
    store(freshness_report(m.bronze), layer_path(warehouse, "gold", "freshness_report"))
    if gate:
        DQ.dq_gate(report)
    return report


def main(argv=None) -> None:
    p = argparse.ArgumentParser(description="landing -> bronze -> silver -> gold")
    p.add_argument("--landing", required=True)
    p.add_argument("--warehouse", required=True)
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--export-csv")
    p.add_argument("--seeds", help="folder of tickers.csv, sectors.csv and series.csv")
    p.add_argument("--full-refresh", action="store_true")
    p.add_argument("--lookback-days", type=int, default=0)
    p.add_argument("--no-gate", action="store_true")
    a = p.parse_args(argv)
    from tidemark.session import build_session
    spark = build_session("tidemark-build")
    run(spark, a.landing, a.warehouse, a.start, a.end, gate=not a.no_gate, export_csv=a.export_csv,
        seeds=a.seeds, full_refresh=a.full_refresh, lookback_days=a.lookback_days)


if __name__ == "__main__":
    main()
