"""Analytics the reference describes but does not build (optional set)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.aggregates import pair_corr, pair_count
from tidemark.operators.asof import carry_forward
from tidemark.operators.relational import pivot_long
from tidemark.operators.rolling import corr_all_pairs, corr_pairs, rolling_corr_pairs, unpivot_series
from tidemark.operators.windows import forward_fill_global, global_frames, lag_k, top_k_per_group, zscore
from tidemark.session import scratch_path


def rolling_correlation(snapshot: DataFrame, asset: str = "sp500_return", macro: str = "vix",
                        windows=(30, 60, 90), min_obs: int = 3) -> DataFrame:
    """Trailing 30/60/90-trading-day correlation of an asset return with a macro series."""
    base = snapshot.select("snapshot_date", asset, macro)
    return global_frames(base, "snapshot_date", max(windows), lambda frame: [
        c for n in windows for c in (pair_corr(asset, macro, min_obs, over=frame(n)).alias(f"corr_{n}"),
                                     pair_count(asset, macro, over=frame(n)).alias(f"n_obs_{n}"))])


def inflation_regime(macro_wide: DataFrame, cpi: str = "cpi") -> DataFrame:
    """Rising / Falling / Stable CPI versus the previous CPI observation."""
    obs = macro_wide.filter(F.col(cpi).isNotNull()).select("observation_date", cpi)
    d = lag_k(obs, cpi, 1, "observation_date", out="cpi_prev")
    return d.withColumn("inflation_regime",
                        F.when(F.col(cpi) > F.col("cpi_prev"), "Rising")
                         .when(F.col(cpi) < F.col("cpi_prev"), "Falling").otherwise("Stable"))


def market_cap_outliers(dim_tickers_df: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Per-sector z-score of market cap and a |z| > threshold flag."""
    z = zscore(dim_tickers_df.withColumn("market_cap", F.col("market_cap").cast("double")),
               "market_cap", "gics_sector")
    return z.select("ticker", "gics_sector", "market_cap", "zscore",
                    (F.abs(F.col("zscore")) > threshold).alias("is_outlier"))


def top_movers(technicals: DataFrame, tickers_seed: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` constituents with the largest absolute daily return per day."""
    t = technicals.join(tickers_seed.select("ticker").distinct(), "ticker", "left_semi") \
        .filter(F.col("daily_return").isNotNull()).select("price_date", "ticker", "daily_return")
    return top_k_per_group(t, "price_date", [F.abs("daily_return").desc(), F.col("ticker").asc()], k)


def sector_vs_index(sector_perf: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Sector mean daily return minus the S&P return of the same day."""
    idx = snapshot.select(F.col("snapshot_date").alias("price_date"), "sp500_return")
    return sector_perf.join(idx, "price_date", "left").select(
        "gics_sector", "price_date", "avg_daily_return", "sp500_return",
        (F.col("avg_daily_return") - F.col("sp500_return")).alias("relative_return"))


def macro_ffill(macro_wide: DataFrame, cols=("fed_funds_rate", "treasury_10y", "treasury_2y", "vix",
                                              "wti_crude_oil")) -> DataFrame:
    """Sparse macro series carried forward to every observation date."""
    return forward_fill_global(macro_wide.select("observation_date", *cols), "observation_date", list(cols))


def macro_overlay(sector_perf: DataFrame, macro_wide: DataFrame) -> DataFrame:
    """Sector rows with the same day's macro context."""
    m = macro_wide.select(F.col("observation_date").alias("price_date"), "fed_funds_rate", "vix",
                          "treasury_10y")
    return sector_perf.join(m, "price_date", "left")


def macro_calendar(stg_macro: DataFrame, days: DataFrame | None = None, max_age_days: int | None = None) -> DataFrame:
    """Every macro series on every calendar day from its first observation to the newest one of all
    series, or on the trading days of ``days`` (column ``date_day``): its last known value, the day it
    was observed, and its age, up to ``max_age_days``."""
    return carry_forward(stg_macro.select("series_id", "observation_date", "value"), "series_id", "observation_date",
                         "value", days=days, max_age_days=max_age_days)


def macro_context(stg_macro: DataFrame, trading_days: DataFrame, series, max_age_days: int | None = None) -> DataFrame:
    """One row per trading day (``trading_days.price_date``), one carried column per series.

    The days are stored first: the plan reads them twice, and their own may be that of all prices.
    """
    spark = trading_days.sparkSession
    path = scratch_path(spark, "trading-days")
    trading_days.select(F.col("price_date").alias("date_day")).distinct().write.parquet(path)
    days = spark.read.parquet(path)
    carried = macro_calendar(stg_macro, days, max_age_days)
    wide = pivot_long(carried, F.col("date_day").alias("price_date"), "series_id", "value", series)
    return days.select(F.col("date_day").alias("price_date")).join(wide, "price_date", "left")


def macro_overlay_carried(sector_perf: DataFrame, context: DataFrame,
                          cols=("fed_funds_rate", "vix", "treasury_10y")) -> DataFrame:
    """Sector rows with the macro values known on their day, not only those observed on it."""
    return sector_perf.join(context.select("price_date", *cols), "price_date", "left")


def rolling_corr_snapshot(snapshot: DataFrame, assets, macros, windows=(30, 60, 90), min_obs: int = 3) -> DataFrame:
    """Trailing correlation of every asset return with every indicator over the snapshot's days."""
    long = unpivot_series(snapshot, "snapshot_date", {**{f"a/{k}": c for k, c in assets.items()},
                                                      **{f"m/{k}": c for k, c in macros.items()}})
    out = rolling_corr_pairs(long, "snapshot_date", "series", "value", windows, F.col("series").startswith("a/"),
                             F.col("series").startswith("m/"), min_obs, "asset", "macro_indicator")
    return out.withColumns({c: F.substring(c, 3, 100) for c in ("asset", "macro_indicator")})


def _assets_and_series(returns: DataFrame, stg_macro: DataFrame, assets) -> DataFrame:
    own = returns.filter(F.col("asset_id").isin(*assets)).select(
        F.col("asset_date").alias("day"), F.lit("asset").alias("kind"), F.col("asset_id").alias("series"), F.col("daily_return").alias("value"))
    return own.unionByName(stg_macro.select(F.col("observation_date").alias("day"), F.lit("macro").alias("kind"),
                                            F.col("series_id").alias("series"), "value"))


def rolling_corr_assets(returns: DataFrame, stg_macro: DataFrame, assets, windows=(30, 60, 90), min_obs: int = 3) -> DataFrame:
    """Trailing correlation of every asset with every macro series, straight from the long tables."""
    return rolling_corr_pairs(_assets_and_series(returns, stg_macro, assets), "day", "series", "value", windows,
                              F.col("kind") == "asset", F.col("kind") == "macro", min_obs, "asset", "macro_indicator")


def corr_assets(returns: DataFrame, stg_macro: DataFrame, assets, min_obs: int = 3) -> DataFrame:
    """Whole-history correlation of every asset with every macro series (E8 as rows of one aggregate)."""
    return corr_pairs(_assets_and_series(returns, stg_macro, assets), "day", "series", "value",
                      F.col("kind") == "asset", F.col("kind") == "macro", min_obs, "asset", "macro_indicator")


def corr_all_assets(returns: DataFrame, min_obs: int = 30) -> DataFrame:
    """Correlation of the daily returns of every two assets with ``min_obs`` common days."""
    if min_obs < 1:  # pairs without a common observation have rows too
        return corr_pairs(returns, "asset_date", "asset_id", "daily_return", min_obs=min_obs, left_name="asset", right_name="other")
    return corr_all_pairs(returns, "asset_date", "asset_id", "daily_return", min_obs, "asset", "other")
