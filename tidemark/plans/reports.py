"""Parameterised report queries over the Gold tables.

Each report is a function ``(gold DataFrame(s), **params) -> DataFrame`` that
aggregates inside Spark (statistics, best/worst rows, nested series), so
nothing is looped over on the driver. An empty result is an empty frame.
Calendar windows end at ``as_of``: a date string, ``None`` for today, or
``"latest"`` for the newest date present in the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import (
    corr_interpretation, inversion_label, period_days_value, score_band)
from tidemark.operators.relational import asset_stats, best_worst, ci_in, ilike_contains, trailing_days


def resolve_as_of(df: DataFrame, date_col: str, as_of: str | Column | None) -> Column:
    """``as_of`` as a date Column; 'latest' is a scalar subquery on ``df``. A caller that
    knows a cheaper table with the same days gives its maximum as a Column."""
    if isinstance(as_of, Column):
        return as_of
    if as_of is None:
        return F.current_date()
    if as_of == "latest":
        return df.agg(F.max(F.col(date_col))).scalar()
    return F.to_date(F.lit(as_of))


def market_snapshot(snapshot: DataFrame, date: str = "latest") -> DataFrame:
    """The snapshot row of one trading day ('latest' = newest day)."""
    if date == "latest":
        return snapshot.orderBy(F.col("snapshot_date").desc_nulls_first()).limit(1)
    return snapshot.filter(F.col("snapshot_date") == F.to_date(F.lit(date)))


def sector_report(sector_perf: DataFrame, sector: str, period: str = "1M",
                  as_of: str | Column | None = None, zero_is_missing: bool = False) -> DataFrame:
    """One row: matched sector, day count, mean return, best/worst day and the
    ordered daily series over the trailing period.

    ``sector`` is a case-insensitive fragment; a fragment matching several
    sectors mixes them and the label is the one of the earliest row.
    """
    days = period_days_value(period)
    rows = sector_perf.filter(ilike_contains("gics_sector", sector)
                              & trailing_days("price_date", days,
                                              resolve_as_of(sector_perf, "price_date", as_of)))
    rows = rows.withColumn("_all", F.lit(1))
    bw = best_worst(rows, "_all", "price_date", "avg_daily_return", zero_is_missing)
    summary = rows.groupBy("_all").agg(
        F.min_by(F.col("gics_sector"), F.struct("price_date", "gics_sector")).alias("sector"),
        F.count(F.lit(1)).alias("num_days"),
        F.avg("avg_daily_return").alias("avg_daily_return"),
        F.array_sort(F.collect_list(F.struct("price_date", "gics_sector", "avg_daily_return",
                                             "num_constituents"))).alias("daily_series"))
    return summary.join(bw, "_all").select(
        "sector", F.lit(period).alias("period"), "num_days", "avg_daily_return", "best_day",
        "worst_day", "daily_series")


def macro_impact(correlation: DataFrame, indicator: str, asset: str = "SP500") -> DataFrame:
    """First (asset, indicator) pair matching both fragments, with a reading."""
    rows = correlation.filter(ilike_contains("asset", asset)
                              & ilike_contains("macro_indicator", indicator))
    return rows.orderBy("asset", "macro_indicator").limit(1).select(
        "asset", "macro_indicator", "correlation", "n_obs",
        corr_interpretation("correlation").alias("interpretation"))


def compare_assets(asset_prices_df: DataFrame, assets: Sequence[str], metric: str = "returns",
                   period: str = "3M", as_of: str | Column | None = None) -> DataFrame:
    """Per-asset period statistics, best cumulative return first.

    Assets match on id or name, case-insensitively. Rows are grouped by
    asset id only, so equal ids of two asset types merge.
    """
    days = period_days_value(period)
    rows = asset_prices_df.filter(
        ci_in(["asset_id", "asset_name"], assets)
        & trailing_days("price_date", days, resolve_as_of(asset_prices_df, "price_date", as_of)))
    stats = asset_stats(rows, "asset_id", "price_date", "close", "daily_return",
                        first_cols=("asset_name", "asset_type"))
    return stats.select(F.lit(period).alias("period"), F.lit(metric).alias("metric"), "asset_id",
                        "asset_name", "asset_type", "num_days", "latest_close", "cumulative_return",
                        "avg_daily_return", "volatility") \
        .orderBy(F.col("cumulative_return").desc_nulls_last(), F.col("asset_id").asc())


def regime_report(regime: DataFrame, indicator: str = "fed_funds_rate") -> DataFrame:
    return regime.select(F.lit(indicator).alias("indicator"), "rate_regime", "vol_regime", "num_days",
                         "avg_sp500_return", "avg_btc_return").orderBy("rate_regime", "vol_regime")


def overview(snapshot: DataFrame) -> DataFrame:
    """The two newest snapshot rows with sentiment band and curve label."""
    latest = snapshot.orderBy(F.col("snapshot_date").desc_nulls_first()).limit(2)
    return latest.select("*", score_band("fng_value").alias("fng_band"),
                         inversion_label("spread_10y_2y").alias("curve_status"))


def overview_series(snapshot: DataFrame) -> DataFrame:
    """The index line of the overview: every trading day's close."""
    return snapshot.select("snapshot_date", "sp500_close").orderBy(F.col("snapshot_date").asc_nulls_last())


def sector_days(sector_perf: DataFrame) -> DataFrame:
    """The whole sector x date matrix as rows: mean daily return in percent of every sector and day."""
    return sector_perf.groupBy("gics_sector", "price_date").agg(F.avg(F.col("avg_daily_return") * 100).alias("return_pct"))


def sector_matrix(sector_perf: DataFrame, dates: Sequence[str]) -> DataFrame:
    """Sector x date matrix of mean daily return in percent, for listed dates
    (sectors with rows on those dates only)."""
    rows = sector_perf.withColumn("d", F.date_format("price_date", "yyyy-MM-dd")) \
        .filter(F.col("d").isin(*dates))
    return rows.groupBy("gics_sector").pivot("d", list(dates)).agg(F.avg(F.col("avg_daily_return") * 100))


def sector_cumulative(sector_perf: DataFrame) -> DataFrame:
    """Plain sum of daily mean returns per sector, in percent, ascending."""
    return (sector_perf.groupBy("gics_sector")
            .agg((F.sum("avg_daily_return") * 100).alias("cumulative_return_pct"))
            .orderBy("cumulative_return_pct"))


def corr_wide(correlation: DataFrame, indicators: Sequence[str]) -> DataFrame:
    """Asset x indicator matrix; a duplicated (asset, indicator) key fails the job."""
    one = F.when(F.count(F.lit(1)) > 1,
                 F.raise_error(F.lit("duplicate (asset, macro_indicator) key"))) \
        .otherwise(F.first("correlation"))
    return correlation.groupBy("asset").pivot("macro_indicator", list(indicators)).agg(one)


def regime_bars(regime: DataFrame) -> DataFrame:
    """Regime label ('rate / vol') with the mean S&P return in percent, ascending."""
    return regime.select(F.concat(F.col("rate_regime"), F.lit(" / "), F.col("vol_regime")).alias("regime"),
                         (F.col("avg_sp500_return") * 100).alias("avg_sp500_return_pct"),
                         "num_days").orderBy("avg_sp500_return_pct")


def json_rows(df: DataFrame) -> DataFrame:
    """Report rows as JSON text: decimals become doubles, dates ISO text, NULL stays a key."""
    cols = []
    for name, dtype in df.dtypes:
        c = F.col(name)
        if dtype.startswith("decimal"):
            c = c.cast("double")
        elif dtype == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif dtype.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        cols.append(c.alias(name))
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("json"))
