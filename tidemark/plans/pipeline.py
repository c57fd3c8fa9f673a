"""Wiring of the medallion jobs over a set of Bronze tables and seeds.

``Medallion`` is a lazy name -> DataFrame registry with lineage: each table
is built from its parents on first access and memoised, so every consumer
of a table shares one plan. ``materialise`` writes a table to the shared
folder and re-reads it, cutting the lineage for tables with many consumers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import medallion as M
from tidemark.plans import standins as S
from tidemark.session import scratch_path, shared_dir
from tidemark.sources.landing import to_bronze
from tidemark.sources.seeds import default_seed
from tidemark.sources.vendor import daily_downsample
from tidemark.storage import complete, listing

#: Bytes of stored Bronze a task reads at most: VARIANT records compress to some 20 bytes and are ten
#: times that in memory, where the staging sorts them before the shuffle.
SCAN_BYTES = 16 << 20

#: Records of a stored Bronze file at most. A row group is read by one task, however large the input's were,
#: and the staging sorts what a task reads.
FILE_RECORDS = 1 << 19

BRONZE_TABLES = ["raw_stock_prices", "raw_stock_fundamentals", "raw_fred_series",
                 "raw_crypto_prices", "raw_fear_greed"]


class _Lazy(dict):
    """Mapping whose values may be zero-argument factories, resolved on first use."""

    def __getitem__(self, key):
        v = super().__getitem__(key)
        if callable(v) and not isinstance(v, DataFrame):
            v = v()
            super().__setitem__(key, v)
        return v


class Medallion:
    """Lazy registry of every dataset of the pipeline."""

    def __init__(self, bronze: Mapping[str, DataFrame | Callable[[], DataFrame]],
                 seeds: Mapping[str, DataFrame | Callable[[], DataFrame]],
                 index_tickers: Mapping[str, str] = M.INDEX_TICKERS, btc_id: str = M.BTC_ID,
                 macro_series: Mapping[str, str] = M.MACRO_SERIES):
        self.bronze = _Lazy(bronze)
        self.seeds = _Lazy(seeds)
        self.index_tickers = dict(index_tickers)
        self.btc_id = btc_id
        self.macro_series = dict(macro_series)
        self._memo: dict[str, DataFrame] = {}
        self._kept: set[str] = set()
        self._columns: dict[str, Sequence[str]] = {}
        self._builders: dict[str, Callable[[], DataFrame]] = {
            "stg_daily_prices": lambda: M.stg_daily_prices(
                self.bronze["raw_stock_prices"], columns=self._columns.get("stg_daily_prices")),
            "stg_fundamentals": lambda: M.stg_fundamentals(
                self.bronze["raw_stock_fundamentals"], columns=self._columns.get("stg_fundamentals")),
            "stg_macro": lambda: M.stg_macro(self.bronze["raw_fred_series"]),
            "stg_crypto": lambda: M.stg_crypto(self.bronze["raw_crypto_prices"]),
            "stg_fear_greed": lambda: M.stg_fear_greed(self.bronze["raw_fear_greed"]),
            "prices_with_technicals": lambda: M.prices_with_technicals(self.ref("stg_daily_prices")),
            "macro_pivot": lambda: M.macro_pivot(self.ref("stg_macro"), self.macro_series),
            "yield_curve": lambda: M.yield_curve(self.ref("macro_pivot")),
            "crypto_with_dominance": lambda: M.crypto_with_dominance(self.ref("stg_crypto")),
            "asset_daily_returns": lambda: M.asset_daily_returns(
                self.ref("prices_with_technicals"), self.ref("crypto_with_dominance")),
            "dim_tickers": lambda: M.dim_tickers(self.seeds["tickers"], self._newest_fundamentals(),
                                                 self.seeds["sectors"]),
            "dim_sectors": lambda: M.dim_sectors(self.seeds["sectors"]),
            "daily_market_snapshot": lambda: M.daily_market_snapshot(
                self.ref("prices_with_technicals"), self.seeds["tickers"],
                self.ref("crypto_with_dominance"), self.ref("stg_fear_greed"),
                self.ref("macro_pivot"), None, self.index_tickers, self.btc_id),
            "regime_analysis": lambda: M.regime_analysis(self.stored("daily_market_snapshot")),
            "sector_performance": lambda: M.sector_performance(
                self.ref("prices_with_technicals"), self.seeds["tickers"], self.ref("dim_tickers")),
            "asset_prices": lambda: M.asset_prices(self.ref("prices_with_technicals"),
                                                   self.ref("crypto_with_dominance")),
            "macro_asset_correlation": lambda: M.macro_asset_correlation(
                self.ref("daily_market_snapshot")),
        }
        if "series" in self.seeds:
            self._builders["dim_macro_indicators"] = lambda: M.dim_macro_indicators(self.seeds["series"])

    def ref(self, name: str) -> DataFrame:
        if name not in self._memo:
            self._memo[name] = self._builders[name]()
        return self._memo[name]

    def narrow(self, name: str, *columns: str) -> Medallion:
        """Stage ``name`` in these columns only, for consumers that read no others."""
        if name in self._memo or name not in ("stg_daily_prices", "stg_fundamentals"):
            raise ValueError(f"{name} is built already or not one of the tables that can be narrowed")
        self._columns[name] = columns
        return self

    def _newest_fundamentals(self) -> DataFrame:
        """What ``dim_tickers`` reads of the staged fundamentals: all of a stored table, else the newest days."""
        if "stg_fundamentals" in self._kept:
            return self.ref("stg_fundamentals")
        return M.newest_fundamentals(self.bronze["raw_stock_fundamentals"])

    def keep(self, name: str, stored: DataFrame) -> None:
        """Serve later refs of ``name`` from a stored table."""
        self._memo[name] = stored
        self._kept.add(name)

    def stored(self, name: str) -> DataFrame:
        """``name`` as a stored table, for a consumer whose plan reads it more than once."""
        df = self.ref(name)
        return df if name in self._kept else self.materialise(df.sparkSession, name)

    def stored_columns(self, name: str, *columns: str) -> DataFrame:
        """Some columns of ``name`` as a stored table; later refs of ``name`` are not served from it."""
        df = self.ref(name).select(*columns)
        if name in self._kept:
            return df
        path = scratch_path(df.sparkSession, name)
        df.write.option("compression", "zstd").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def names(self) -> list[str]:
        return list(self._builders)

    def register_views(self, names=None, prefix: str = "") -> list[str]:
        """Expose datasets as temp views so they can be queried with SQL
        (``spark.sql("SELECT * FROM daily_market_snapshot")``); lazy, nothing runs."""
        done = []
        for n in names or self.names():
            self.ref(n).createOrReplaceTempView(prefix + n)
            done.append(prefix + n)
        return done

    def materialise(self, spark: SparkSession, name: str) -> DataFrame:
        """Write ``name`` under the shared folder and serve later refs from it."""
        path = scratch_path(spark, name)
        self.ref(name).write.option("compression", "zstd").parquet(path)
        self.keep(name, spark.read.parquet(path))
        return self._memo[name]


def crypto_landing(ticks: DataFrame) -> DataFrame:
    """Intraday coin ticks -> daily landing records (history backfill shape)."""
    daily = daily_downsample(ticks, "coin_id", "ts_ms",
                             ["symbol", "name", "price", "market_cap", "total_volume", "circulating_supply",
                              "market_cap_rank"], seq="seq")
    return daily.select(
        "coin_id", "symbol", "name", F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.col("price").alias("price_usd"), "market_cap", "total_volume",
        "circulating_supply", "market_cap_rank", F.lit("coingecko").alias("source"),
        F.col("ts_ms"))


def _bronze_from_records(records: DataFrame, source: str) -> DataFrame:
    return to_bronze(records, source, loaded_at=F.timestamp_seconds(F.col("load_seq")),
                     file_name=F.col("file_name"), exclude=("load_seq", "file_name"))


def standin_bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five Bronze tables built from the driver tables (see ``standins``)."""
    crypto = crypto_landing(S.crypto_ticks(spark, sf_dir))
    return {
        "raw_stock_prices": _bronze_from_records(S.price_records(spark, sf_dir), "yahoo_finance"),
        "raw_stock_fundamentals": _bronze_from_records(S.fundamental_records(spark, sf_dir),
                                                       "yahoo_finance"),
        "raw_fred_series": _bronze_from_records(S.macro_records(spark, sf_dir), "fred"),
        "raw_crypto_prices": to_bronze(crypto, "coingecko",
                                       loaded_at=F.timestamp_millis(F.col("ts_ms")),
                                       file_name=F.lit("crypto-prices/history.json"),
                                       exclude=("ts_ms",)),
        "raw_fear_greed": _bronze_from_records(S.fear_greed_records(spark, sf_dir), "alternative_me"),
    }


def _input_tag(spark: SparkSession, sf_dir: str) -> str:
    """Identity of a stand-in Bronze build: the input folder's path, the
    size/mtime of its files and the source of the code that shapes them, so
    a changed adapter never reuses Bronze built by an older one."""
    from tidemark.sources import landing as _landing
    from tidemark.sources import vendor as _vendor
    h = hashlib.sha1(sf_dir.rstrip("/").encode())
    for mod in (S, _landing, _vendor):
        with open(mod.__file__, "rb") as f:
            h.update(f.read())
    with open(__file__, "rb") as f:
        h.update(f.read())
    for name, path, folder, size, modified in listing(spark, sf_dir) or []:
        inner = listing(spark, path) if folder else [(name, path, folder, size, modified)]
        h.update("".join(f"{n}:{m}:{k};" for n, _, _, m, k in inner).encode())
    return h.hexdigest()[:16]


def _bound_scans(spark: SparkSession, limit: int = SCAN_BYTES) -> None:
    key = "spark.sql.files.maxPartitionBytes"
    now = spark.conf.get(key).lower().rstrip("b")
    scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}.get(now[-1])
    if (int(now[:-1]) * scale if scale else int(now)) > limit:
        spark.conf.set(key, str(limit))


def persisted_bronze(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    """Bronze tables of ``standin_bronze``, written once to the shared folder.

    Bronze is a stored, append-only layer: later jobs read it back (VARIANT
    columns are shredded on write, so field extraction becomes a column
    read). Each task writes what it shaped, without a shuffle of all records,
    in files of ``FILE_RECORDS`` at most.
    A table whose write did not complete is rebuilt. Returns lazy
    factories so a query only touches the tables it uses. Scans of this
    session are cut into ``SCAN_BYTES`` or less, which changes no result.
    """
    _bound_scans(spark)
    root = f"{shared_dir(spark)}/tidemark-bronze/{_input_tag(spark, sf_dir)}"

    def load(name: str) -> DataFrame:
        path = f"{root}/{name}"
        if not complete(spark, path):
            standin_bronze(spark, sf_dir)[name].write.mode("overwrite").option("compression", "zstd") \
                .option("maxRecordsPerFile", FILE_RECORDS).parquet(path)
        return spark.read.parquet(path)

    return {name: (lambda n=name: load(n)) for name in BRONZE_TABLES}


def standin_medallion(spark: SparkSession, sf_dir: str, persist: bool = True) -> Medallion:
    seeds = {"tickers": lambda: S.tickers_seed(spark, sf_dir),
             "sectors": lambda: S.sectors_seed(spark, sf_dir),
             "series": lambda: default_seed(spark, "series")}
    bronze = persisted_bronze(spark, sf_dir) if persist else standin_bronze(spark, sf_dir)
    return Medallion(bronze, seeds, index_tickers=S.INDEX_STANDIN)
