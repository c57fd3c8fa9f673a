"""Medallion jobs: Bronze (VARIANT records) -> Silver staging -> intermediate -> Gold.

Each function takes DataFrames and returns a lazy DataFrame, so a caller can
compose, persist or write any layer. Staging extracts typed fields from the
VARIANT payload and keeps the latest load per natural key; intermediate and
Gold tables are ordinary window / aggregate / join plans.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.indicators import series_window
from tidemark.functions.scalar import rate_regime, vol_regime
from tidemark.operators.frames import first_in_task
from tidemark.operators.relational import corr_matrix, pivot_long, union_all
from tidemark.operators.windows import (
    dedup_latest, lag_k, latest_per_key, share_of_total, with_returns, with_technicals)

NUMBER = "decimal(38,0)"


def extract(raw: str, path: str, type_: str, strict: bool = True) -> Column:
    """Typed field of a VARIANT column. A missing path gives NULL; a value
    that does not convert raises (``strict``) or gives NULL."""
    fn = F.variant_get if strict else F.try_variant_get
    return fn(F.col(raw), f"$.{path}", type_)


def _loads(bronze: DataFrame, fields: list[tuple[str, str, str]], keys: list[str], strict: bool,
           columns: Sequence[str] | None = None) -> tuple[DataFrame, list[Column]]:
    """Flattened ``(json_path, type, name)`` fields of every load, and the order in which the latest comes first.

    Ties on the load time are broken by file name and then by the extracted
    values, all descending, so the result does not depend on task order. With
    ``columns`` the values end at the last one named: rows that are alike up to
    there do not differ in these columns, and no others need to be shuffled.
    """
    values = [n for _, _, n in fields if n not in keys]
    if columns is not None:
        values = values[:max((i + 1 for i, n in enumerate(values) if n in columns), default=0)]
    cols = [extract("raw_data", p, t, strict).alias(n) for p, t, n in fields if n in keys or n in values]
    flat = bronze.select(*cols, F.col("_loaded_at").alias("loaded_at"), F.col("_file_name"))
    return flat, [F.col(n).desc_nulls_first() for n in ("loaded_at", "_file_name", *values)]


def _stage(bronze: DataFrame, fields: list[tuple[str, str, str]], keys: list[str],
           strict: bool, columns: Sequence[str] | None = None) -> DataFrame:
    """The latest load of every key, whole or in the given ``columns``."""
    flat, order = _loads(bronze, fields, keys, strict, columns)
    latest = dedup_latest(flat, keys, order)
    return latest.drop("_file_name") if columns is None else latest.select(*columns)


# Bronze field maps: (json path, type, output column).
PRICE_FIELDS = [("ticker", "string", "ticker"), ("date", "date", "price_date"),
                ("open", "double", "open_price"), ("high", "double", "high_price"),
                ("low", "double", "low_price"), ("close", "double", "close_price"),
                ("adj_close", "double", "adj_close_price"), ("volume", NUMBER, "volume")]
FUNDAMENTAL_FIELDS = [("ticker", "string", "ticker"), ("date", "date", "snapshot_date"),
                      ("market_cap", NUMBER, "market_cap"), ("pe_ratio", "double", "pe_ratio"),
                      ("sector", "string", "sector"), ("industry", "string", "industry"),
                      ("short_name", "string", "company_name")]
MACRO_FIELDS = [("series_id", "string", "series_id"), ("series_name", "string", "series_name"),
                ("date", "date", "observation_date"), ("value", "double", "value")]
CRYPTO_FIELDS = [("coin_id", "string", "coin_id"), ("symbol", "string", "symbol"),
                 ("name", "string", "coin_name"), ("date", "date", "price_date"),
                 ("price_usd", "double", "price_usd"), ("market_cap", NUMBER, "market_cap"),
                 ("total_volume", NUMBER, "total_volume"),
                 ("circulating_supply", "double", "circulating_supply"),
                 ("market_cap_rank", NUMBER, "market_cap_rank")]
FEAR_GREED_FIELDS = [("date", "date", "reading_date"), ("value", NUMBER, "fng_value"),
                     ("classification", "string", "classification")]


def stg_daily_prices(bronze: DataFrame, strict: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    return _stage(bronze, PRICE_FIELDS, ["ticker", "price_date"], strict, columns)


def stg_fundamentals(bronze: DataFrame, strict: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    return _stage(bronze, FUNDAMENTAL_FIELDS, ["ticker", "snapshot_date"], strict, columns)


def newest_fundamentals(bronze: DataFrame, strict: bool = True) -> DataFrame:
    """The rows of ``stg_fundamentals`` of each ticker's newest day (a NULL one is).

    Loads of other days are dropped by the tasks that read them, before any exchange.
    """
    keys = ["ticker", "snapshot_date"]
    flat, order = _loads(bronze, FUNDAMENTAL_FIELDS, keys, strict)
    newest = Window.partitionBy("ticker").orderBy(F.col("snapshot_date").desc_nulls_first())
    loads = flat.withColumn("_age", F.rank().over(newest)).filter(F.col("_age") == 1).drop("_age")
    return dedup_latest(loads, keys, order).drop("_file_name")


def stg_macro(bronze: DataFrame, strict: bool = True) -> DataFrame:
    return _stage(bronze, MACRO_FIELDS, ["series_id", "observation_date"], strict)


def stg_crypto(bronze: DataFrame, strict: bool = True) -> DataFrame:
    return _stage(bronze, CRYPTO_FIELDS, ["coin_id", "price_date"], strict)


def stg_fear_greed(bronze: DataFrame, strict: bool = True) -> DataFrame:
    return _stage(bronze, FEAR_GREED_FIELDS, ["reading_date"], strict)


# ---------------------------------------------------------------- intermediate

TECHNICAL_COLUMNS = ["ticker", "price_date", "open_price", "high_price", "low_price",
                     "close_price", "adj_close_price", "volume", "daily_change", "daily_return",
                     "ma_20", "ma_50", "ma_200", "rsi_14", "bb_middle", "bb_upper", "bb_lower"]


def prices_with_technicals(stg_prices: DataFrame, ma_method: str = "frame") -> DataFrame:
    """Per (ticker, day): change, return, MA 20/50/200, RSI 14, Bollinger 20/2, beside the columns that were staged."""
    out = with_technicals(stg_prices, "close_price", "ticker", "price_date", ma_method=ma_method)
    return out.select(*[c for c in TECHNICAL_COLUMNS if c in out.columns])


def price_loads(bronze: DataFrame, strict: bool = True) -> DataFrame:
    """Every load of every price: ``stg_daily_prices`` before the latest ones are chosen."""
    return _loads(bronze, PRICE_FIELDS, ["ticker", "price_date"], strict)[0]


def technicals_of_loads(loads: DataFrame, value: str = "close_price", by: str = "ticker",
                        order: str = "price_date") -> DataFrame:
    """``prices_with_technicals`` of the latest loads, and any further columns, with one exchange for both.

    Each task sends its latest load of a (ticker, day); they are dealt by ticker
    alone, so that the latest of all and the frames are found where they arrive.
    """
    latest = [F.col(n).desc_nulls_first() for n in (
        "loaded_at", "_file_name", *[n for _, _, n in PRICE_FIELDS if n not in (by, order)])]
    dealt = first_in_task(loads, [by, order], latest).repartition(by)
    return with_technicals(dedup_latest(dealt, [by, order], latest).drop("loaded_at", "_file_name"),
                           value, by, order, ma_method="arrow", clustered=True)


# Macro series ids and their wide column names, in model order.
MACRO_SERIES = {
    "DFF": "fed_funds_rate",
    "DGS10": "treasury_10y",
    "DGS2": "treasury_2y",
    "VIXCLS": "vix",
    "DCOILWTICO": "wti_crude_oil",
    "DEXUSEU": "usd_eur_rate",
    "CPIAUCSL": "cpi",
    "UNRATE": "unemployment_rate",
    "M2SL": "m2_money_supply",
    "GDPC1": "real_gdp",
}


def macro_pivot(stg_macro_df: DataFrame, series: Mapping[str, str] = MACRO_SERIES) -> DataFrame:
    """One row per observation date, one column per series (NULL when absent)."""
    return pivot_long(stg_macro_df, "observation_date", "series_id", "value", series)


def yield_curve(macro_wide: DataFrame) -> DataFrame:
    """10y - 2y spread and inversion flag on dates where both yields exist."""
    m = macro_wide.filter(F.col("treasury_10y").isNotNull() & F.col("treasury_2y").isNotNull())
    spread = F.col("treasury_10y") - F.col("treasury_2y")
    return m.select("observation_date", "treasury_10y", "treasury_2y",
                    spread.alias("spread_10y_2y"), (spread < 0).alias("is_inverted"))


def crypto_with_dominance(stg_crypto_df: DataFrame) -> DataFrame:
    """Each coin's share (%) of the day's total market cap."""
    out = share_of_total(stg_crypto_df, "market_cap", "price_date", out="dominance_pct")
    return out.select("coin_id", "symbol", "coin_name", "price_date", "price_usd", "market_cap",
                      "total_volume", "circulating_supply", "market_cap_rank", "dominance_pct")


RETURN_COLUMNS = ["asset_type", "asset_id", "asset_name", "asset_date", "close", "daily_return"]


def coin_returns(crypto_dom: DataFrame) -> DataFrame:
    """Daily returns of coins, lagged over the coin's own calendar (every day it has)."""
    coins = with_returns(crypto_dom.select("coin_id", "symbol", "price_date", "price_usd"),
                         "price_usd", "coin_id", "price_date", prev="prev_price")
    return coins.select(F.lit("crypto").alias("asset_type"), F.col("coin_id").alias("asset_id"),
                        F.col("symbol").alias("asset_name"), F.col("price_date").alias("asset_date"),
                        F.col("price_usd").alias("close"), "daily_return")


def asset_daily_returns(technicals: DataFrame, crypto_dom: DataFrame) -> DataFrame:
    """Stocks and coins in one long (type, id, date) table with daily returns."""
    stocks = technicals.select(F.lit("stock").alias("asset_type"), F.col("ticker").alias("asset_id"),
                               F.col("ticker").alias("asset_name"),
                               F.col("price_date").alias("asset_date"),
                               F.col("close_price").alias("close"), "daily_return")
    return union_all(stocks, coin_returns(crypto_dom))


# ------------------------------------------------------------------------ gold

def dim_tickers(tickers_seed: DataFrame, stg_fund: DataFrame, sectors_seed: DataFrame) -> DataFrame:
    """Constituents + newest fundamentals + GICS sector (left joins: nothing dropped)."""
    latest = latest_per_key(stg_fund, "ticker", "snapshot_date").select(
        "ticker", "market_cap", "pe_ratio", "industry")
    sector_map = sectors_seed.select(F.col("yahoo_sector").alias("sector"), "gics_sector")
    return (tickers_seed.select("ticker", "company_name", "sector")
            .join(latest, "ticker", "left")
            .join(sector_map, "sector", "left")
            .select("ticker", "company_name", F.col("sector").alias("yahoo_sector"), "gics_sector",
                    "industry", "market_cap", "pe_ratio"))


def dim_sectors(sectors_seed: DataFrame) -> DataFrame:
    return sectors_seed.select("gics_sector", "yahoo_sector", "description")


def dim_macro_indicators(series_seed: DataFrame) -> DataFrame:
    return series_seed.select("series_id", "series_name", "frequency", "unit", "category")


# Index tickers pivoted into the snapshot, and the coin id used for BTC.
INDEX_TICKERS = {"sp500": "^GSPC", "nasdaq": "^IXIC", "dow": "^DJI"}
BTC_ID = "bitcoin"

SNAPSHOT_COLUMNS = ["snapshot_date", "sp500_close", "sp500_return", "nasdaq_close", "dow_close",
                    "advancers", "decliners", "btc_price", "btc_dominance", "btc_return",
                    "fng_value", "fng_classification", "fed_funds_rate", "treasury_10y",
                    "treasury_2y", "spread_10y_2y", "is_inverted", "vix", "wti_crude_oil"]


def daily_market_snapshot(technicals: DataFrame, tickers_seed: DataFrame, crypto_dom: DataFrame,
                          fear_greed: DataFrame, macro_wide: DataFrame, curve: DataFrame | None = None,
                          index_tickers: Mapping[str, str] = INDEX_TICKERS, btc_id: str = BTC_ID,
                          after: Column | None = None) -> DataFrame:
    """One row per trading day stitching every source onto the date grain.

    Trading days, index closes/returns and market breadth come from a single
    aggregate over the technicals (one pass over the largest input). Breadth
    counts constituents through the seed's multiplicity, so a duplicated seed
    row counts twice exactly as an inner join would, and a day without any
    constituent row has NULL breadth. Every other side is one row per date
    before its left join; those sides are small and AQE broadcasts them.
    The BTC return is the coin's own day-over-day return, cut to trading days.
    ``after`` restricts the output to later dates (incremental build); the
    filter stops above the windows, which still see the whole history.
    Without ``curve`` the spread and inversion flag are derived from the same
    macro row (identical to joining ``yield_curve``, whose rows are exactly
    the dates with both yields), saving a second pass over the macro data.
    """
    sp, nq, dj = index_tickers["sp500"], index_tickers["nasdaq"], index_tickers["dow"]
    members = tickers_seed.groupBy("ticker").agg(F.count(F.lit(1)).alias("_mult"))
    t, ret, mult = F.col("ticker"), F.col("daily_return"), F.col("_mult")
    day = technicals.select("ticker", "price_date", "close_price", "daily_return") \
        .join(members, "ticker", "left")
    has_members = F.sum(mult).isNotNull()
    grain = day.groupBy(F.col("price_date").alias("snapshot_date")).agg(
        F.max(F.when(t == sp, F.col("close_price"))).alias("sp500_close"),
        F.max(F.when(t == sp, ret)).alias("sp500_return"),
        F.max(F.when(t == nq, F.col("close_price"))).alias("nasdaq_close"),
        F.max(F.when(t == dj, F.col("close_price"))).alias("dow_close"),
        F.when(has_members, F.sum(F.when(ret > 0, mult).otherwise(0))).cast("bigint")
         .alias("advancers"),
        F.when(has_members, F.sum(F.when(ret < 0, mult).otherwise(0))).cast("bigint")
         .alias("decliners"))
    if after is not None:
        grain = grain.filter(F.col("snapshot_date") > after)
    btc = with_returns(crypto_dom.filter(F.col("coin_id") == btc_id)
                       .select("coin_id", "price_date", "price_usd", "dominance_pct"),
                       "price_usd", "coin_id", "price_date", prev="_prev")
    btc = btc.select(F.col("price_date").alias("snapshot_date"), F.col("price_usd").alias("btc_price"),
                     F.col("dominance_pct").alias("btc_dominance"),
                     F.col("daily_return").alias("btc_return"))
    fng = fear_greed.select(F.col("reading_date").alias("snapshot_date"), "fng_value",
                            F.col("classification").alias("fng_classification"))
    macro = macro_wide.select(F.col("observation_date").alias("snapshot_date"), "fed_funds_rate",
                              "treasury_10y", "treasury_2y", "vix", "wti_crude_oil")
    sides = [btc, fng]
    if curve is None:
        spread = F.col("treasury_10y") - F.col("treasury_2y")
        sides.append(macro.select("*", spread.alias("spread_10y_2y"), (spread < 0).alias("is_inverted")))
    else:
        sides += [macro, curve.select(F.col("observation_date").alias("snapshot_date"), "spread_10y_2y",
                                      "is_inverted")]
    out = grain
    for side in sides:
        out = out.join(side, "snapshot_date", "left")
    return out.select(*SNAPSHOT_COLUMNS)


def regime_timeline(snapshot: DataFrame, lag_days: int = 5, vix_threshold: float = 20) -> DataFrame:
    """Per-day rate and volatility regime labels.

    The rate trend compares the Fed funds rate with its value ``lag_days``
    rows (trading days) earlier over the whole history.
    """
    d = lag_k(snapshot.select("snapshot_date", "sp500_return", "btc_return", "vix",
                              "fed_funds_rate"),
              "fed_funds_rate", lag_days, "snapshot_date", out="fed_funds_prev")
    return d.select("snapshot_date", "sp500_return", "btc_return", "vix", "fed_funds_rate",
                    "fed_funds_prev",
                    rate_regime("fed_funds_rate", "fed_funds_prev").alias("rate_regime"),
                    vol_regime("vix", vix_threshold).alias("vol_regime"))


def regime_analysis(snapshot: DataFrame, lag_days: int = 5, vix_threshold: float = 20) -> DataFrame:
    """Days and mean S&P / BTC returns per (rate regime, vol regime)."""
    return (regime_timeline(snapshot, lag_days, vix_threshold)
            .groupBy("rate_regime", "vol_regime")
            .agg(F.count(F.lit(1)).alias("num_days"),
                 F.avg("sp500_return").alias("avg_sp500_return"),
                 F.avg("btc_return").alias("avg_btc_return")))


def sector_performance(technicals: DataFrame, tickers_seed: DataFrame,
                       dim_tickers_df: DataFrame) -> DataFrame:
    """Per (GICS sector, day): constituents, mean daily return, summed close.

    The close total is summed in exact decimal and returned as double, so it
    does not depend on how rows are split over tasks. A constituent is counted
    at the first of its rows of a day, found in the order the technicals have
    already, and at the first of its repeated seed rows, so that no task holds
    all its (sector, day, ticker) keys.
    """
    series = series_window("ticker", "price_date")
    again = (F.row_number().over(series) > 1) & F.lag("price_date").over(series).eqNullSafe(F.col("price_date"))
    prices = technicals.select("ticker", "price_date", "daily_return", "close_price", (~again).alias("_first"))
    members = tickers_seed.select("ticker").join(
        dim_tickers_df.filter(F.col("gics_sector").isNotNull()).select("ticker", "gics_sector"), "ticker", "inner")
    copy = F.row_number().over(series_window(["ticker", "gics_sector"], "gics_sector"))
    return (prices.join(members.select("ticker", "gics_sector", (copy == 1).alias("_once")), "ticker", "inner")
            .groupBy("gics_sector", "price_date")
            .agg(F.count_if(F.col("_first") & F.col("_once")).alias("num_constituents"),
                 F.avg("daily_return").alias("avg_daily_return"),
                 F.sum(F.col("close_price").cast("decimal(38,10)")).cast("double")
                  .alias("total_close_price")))


ASSET_PRICE_COLUMNS = ["asset_type", "asset_id", "asset_name", "price_date", "close",
                       "daily_return", "ma_20", "ma_50", "ma_200", "rsi_14"]


def asset_prices(technicals: DataFrame, crypto_dom: DataFrame) -> DataFrame:
    """Per-asset daily fact: stocks with their technicals, coins with NULL ones.

    Stock rows carry their technicals already, so both kinds are a union and no join.
    """
    own = ["ma_20", "ma_50", "ma_200", "rsi_14"]
    stocks = technicals.select(
        F.lit("stock").alias("asset_type"), F.col("ticker").alias("asset_id"), F.col("ticker").alias("asset_name"),
        "price_date", F.col("close_price").alias("close"), "daily_return", *own)
    coins = coin_returns(crypto_dom).withColumnRenamed("asset_date", "price_date")
    return union_all(stocks, coins.select("*", *[F.lit(None).cast("double").alias(c) for c in own])) \
        .select(*ASSET_PRICE_COLUMNS)


# Assets and macro indicators correlated in the Gold table.
CORR_ASSETS = {"SP500": "sp500_return", "BTC": "btc_return"}
CORR_MACROS = {"VIX": "vix", "TREASURY_10Y": "treasury_10y", "TREASURY_2Y": "treasury_2y",
               "FED_FUNDS_RATE": "fed_funds_rate", "WTI_CRUDE_OIL": "wti_crude_oil"}


def macro_asset_correlation(snapshot: DataFrame, min_obs: int = 3) -> DataFrame:
    """Pearson correlation of each asset return with each macro indicator."""
    return corr_matrix(snapshot, CORR_ASSETS, CORR_MACROS, min_obs)
