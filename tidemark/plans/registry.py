"""Registered queries: one Spark plan and one DuckDB oracle per operator.

Every query reads the driver tables of ``sf_dir`` in full (through the
shape adapters of ``standins`` where a market-data shape is needed) and runs
the library's own jobs on them. Output doubles are rounded (6 decimals; 4 for
price levels, 2 for sums of prices) on both sides, since the engines sum in different
orders; decimals are compared as doubles. Rounding is half-away-from-zero of
``x * 10^d`` on the double, then ``/ 10^d``: the arithmetic DuckDB's
``round`` uses, so exact half-way values (prices like 510.30175) round
alike on both sides.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import oracle as O
from tidemark.plans.pipeline import standin_medallion
from tidemark.session import apply_core_conf
from tidemark.sources.seeds import seed_rows


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    dbl: tuple[str, ...] = ()
    coarse: tuple[str, ...] = ()
    ints: tuple[str, ...] = ()
    cents: tuple[str, ...] = ()
    doc: str = ""

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_core_conf(spark)
        return normalise(self.build(spark, sf_dir), self.coarse, self.cents, self.ints)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        return round_sql(self.sql, self.dbl, self.coarse, self.ints, self.cents)


def _dp(name, coarse, cents) -> int:
    return 2 if name in cents else 4 if name in coarse else 6


def normalise(df: DataFrame, coarse=(), cents=(), ints=()) -> DataFrame:
    cols = []
    for name, dtype in df.dtypes:
        if name in ints or (dtype.startswith("decimal(") and dtype.endswith(",0)")):
            cols.append(F.col(name).cast("double").alias(name))
        elif dtype.startswith("decimal") or dtype in ("double", "float"):
            scale = F.lit(10.0 ** _dp(name, coarse, cents))
            y = F.col(name).cast("double") * scale
            half_away = F.signum(y) * F.floor(F.abs(y) + F.lit(0.5))
            # |y| >= 2^52 is already integral (and would overflow floor's long)
            rounded = F.when(F.abs(y) >= F.lit(4.5e15), y).otherwise(half_away)
            cols.append((rounded / scale + F.lit(0.0)).alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def round_sql(sql: str, dbl, coarse, ints=(), cents=()) -> str:
    """Wrap ``sql`` so listed columns are rounded like ``normalise`` does
    (``ints``: integral decimals, only cast to double)."""
    repl = [f"(round(CAST({c} AS DOUBLE), {_dp(c, coarse, cents)}) + CAST(0 AS DOUBLE)) AS {c}"
            for c in (*dbl, *coarse, *cents)]
    repl += [f"CAST({c} AS DOUBLE) AS {c}" for c in ints]
    if not repl:
        return sql
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM (\n{sql}\n) AS q"


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, dbl=(), coarse=(), ints=(), cents=(), doc: str = ""):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, tuple(dbl), tuple(coarse), tuple(ints), tuple(cents),
                               doc or (fn.__doc__ or ""))
        return fn
    return deco


def _m(spark, sf_dir):
    return standin_medallion(spark, sf_dir)


#: What returns and day totals are made of.
_CLOSES = ("ticker", "price_date", "close_price")
PRICE_COLS = ("open_price", "high_price", "low_price", "close_price", "adj_close_price")

# ------------------------------------------------------------------ staging (M1-M5)


@register("stg_daily_prices",
          O.cte("stg_prices") + "SELECT * FROM stg_prices", dbl=PRICE_COLS, ints=("volume",))
def q_stg_daily_prices(spark, d):
    """M1: VARIANT path extract + latest-load-wins dedup of stock prices."""
    return _m(spark, d).ref("stg_daily_prices").drop("loaded_at")


@register("stg_fundamentals", O.cte("stg_fund") + "SELECT * FROM stg_fund",
          dbl=("pe_ratio",), ints=("market_cap",))
def q_stg_fundamentals(spark, d):
    """M2: typed, deduplicated fundamentals snapshots."""
    return _m(spark, d).ref("stg_fundamentals").drop("loaded_at")


@register("stg_macro", O.cte("stg_macro") + "SELECT * FROM stg_macro", dbl=("value",))
def q_stg_macro(spark, d):
    """M3: typed, deduplicated macro observations."""
    return _m(spark, d).ref("stg_macro").drop("loaded_at")


@register("stg_crypto", O.cte("stg_crypto") + "SELECT * EXCLUDE (ts_ms) FROM stg_crypto",
          dbl=("price_usd", "circulating_supply"), ints=("market_cap", "total_volume", "market_cap_rank"))
def q_stg_crypto(spark, d):
    """M4: crypto Bronze typed from VARIANT and deduplicated per (coin, day).

    The Bronze rows were landed from intraday ticks by the B7 daily downsample
    when the stored Bronze layer was built (``pipeline.persisted_bronze``);
    ``daily_downsample`` and ``align_series`` run B7 itself on every call."""
    return _m(spark, d).ref("stg_crypto").drop("loaded_at")


@register("stg_fear_greed", O.cte("stg_fng") + "SELECT * FROM stg_fng", ints=("fng_value",))
def q_stg_fear_greed(spark, d):
    """M5: typed, deduplicated daily sentiment readings."""
    return _m(spark, d).ref("stg_fear_greed").drop("loaded_at")


# ------------------------------------------------------------- intermediate

TECH_COARSE = PRICE_COLS + ("daily_change", "ma_20", "ma_50", "ma_200", "bb_middle", "bb_upper",
                            "bb_lower")


@register("prices_with_technicals", O.cte("technicals") + "SELECT * FROM technicals",
          dbl=("daily_return", "rsi_14"), coarse=TECH_COARSE, ints=("volume",))
def q_technicals(spark, d):
    """M6: per-ticker lag/return, MA 20/50/200, RSI 14, Bollinger 20/2 in one pass over sorted series."""
    stg = _m(spark, d).ref("stg_daily_prices")
    return M.prices_with_technicals(stg.drop("loaded_at"), "arrow")


@register("pivot_long_wide", O.cte("macro_wide") + "SELECT * FROM macro_wide",
          dbl=("fed_funds_rate", "treasury_10y", "treasury_2y", "vix", "wti_crude_oil", "usd_eur_rate",
               "cpi", "unemployment_rate", "m2_money_supply", "real_gdp"))
def q_macro_pivot(spark, d):
    """Long macro series pivoted to one row per date by conditional max."""
    return _m(spark, d).ref("macro_pivot")


@register("yield_curve", O.cte("yield_curve") + "SELECT * FROM yield_curve",
          dbl=("treasury_10y", "treasury_2y", "spread_10y_2y"))
def q_yield_curve(spark, d):
    """M8: 10y-2y spread and inversion flag where both yields exist."""
    return _m(spark, d).ref("yield_curve")


@register("share_of_total", O.cte("crypto_dom") + "SELECT * FROM crypto_dom",
          dbl=("price_usd", "circulating_supply", "dominance_pct"),
          ints=("market_cap", "total_volume", "market_cap_rank"))
def q_share_of_total(spark, d):
    """M9/F8: each coin's share of the day's total market cap (aggregate + join back)."""
    return _m(spark, d).ref("crypto_with_dominance")


@register("union_all", O.cte("asset_returns") + "SELECT * FROM asset_returns",
          dbl=("daily_return",), coarse=("close",))
def q_union_all(spark, d):
    """Stock and coin returns unioned into one long table."""
    return _m(spark, d).ref("asset_daily_returns")


# --------------------------------------------------------------------- gold

@register("dim_tickers", O.cte("dim_tickers") + "SELECT * FROM dim_tickers",
          dbl=("pe_ratio",), ints=("market_cap",))
def q_dim_tickers(spark, d):
    """Constituents + newest fundamentals + sector map (left joins)."""
    return _m(spark, d).ref("dim_tickers")


@register("dim_sectors", O.cte("sectors") + "SELECT gics_sector, yahoo_sector, description FROM sectors")
def q_dim_sectors(spark, d):
    """Sector dimension projected from the sector seed."""
    return _m(spark, d).ref("dim_sectors")


_DIM_SERIES = """SELECT * FROM (VALUES {}) AS t(series_id, series_name, frequency, unit, category)"""


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in r) + ")" for r in rows)


@register("dim_macro_indicators", _DIM_SERIES.format(_values(seed_rows("series")))
          + " WHERE series_id IN (SELECT series_id FROM (" + O.cte("stg_macro") + "SELECT series_id FROM stg_macro))")
def q_dim_macro_indicators(spark, d):
    """The macro indicator dimension, of the series that were observed."""
    m = _m(spark, d)
    return m.ref("dim_macro_indicators").join(m.ref("stg_macro").select("series_id").distinct(), "series_id", "left_semi")


SNAP_DBL = ("sp500_return", "btc_price", "btc_dominance", "btc_return", "fed_funds_rate",
            "treasury_10y", "treasury_2y", "spread_10y_2y", "vix", "wti_crude_oil")
SNAP_COARSE = ("sp500_close", "nasdaq_close", "dow_close")


@register("daily_market_snapshot", O.cte("snapshot") + "SELECT * FROM snapshot",
          dbl=SNAP_DBL, coarse=SNAP_COARSE, ints=("fng_value",))
def q_snapshot(spark, d):
    """M12 (flagship): one row per trading day joining indices, breadth, BTC,
    sentiment, macro and yield curve."""
    return _m(spark, d).ref("daily_market_snapshot")


@register("regime_analysis", O.cte("regime") + "SELECT * FROM regime",
          dbl=("avg_sp500_return", "avg_btc_return"))
def q_regime(spark, d):
    """Rate regime from a 5-row lag, vol regime from VIX, grouped."""
    return _m(spark, d).ref("regime_analysis")


@register("sector_performance", O.cte("sector_perf") + "SELECT * FROM sector_perf",
          dbl=("avg_daily_return", "total_close_price"))
def q_sector_performance(spark, d):
    """Per (sector, day) constituents, mean return, summed close."""
    return _m(spark, d).ref("sector_performance")


@register("asset_prices", O.cte("asset_prices") + "SELECT * FROM asset_prices",
          dbl=("daily_return", "rsi_14"), coarse=("close", "ma_20", "ma_50", "ma_200"))
def q_asset_prices(spark, d):
    """Asset prices, stocks with their technicals and coins without."""
    m = _m(spark, d)
    closes = m.ref("stg_daily_prices").select("ticker", "price_date", "close_price")
    return M.asset_prices(W.with_technicals(closes, ma_method="arrow"), m.ref("crypto_with_dominance"))


@register("conditional_left_join", """
SELECT event_id, user_id, event_type, c_name, c_mktsegment
FROM events LEFT JOIN customer ON event_type = 'purchase' AND user_id = c_custkey""")
def q_conditional_left_join(spark, d):
    """Left join with a left-side constant in its condition: only purchases
    meet a customer, all other events stay with NULLs."""
    ev = _t(spark, d, "events").select("event_id", "user_id", "event_type")
    customers = _t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return R.tagged_left_join(ev, customers, F.col("event_type") == "purchase", {"user_id": "c_custkey"}) \
        .drop("c_custkey")


@register("corr_matrix", O.cte("correlation") + "SELECT * FROM correlation", dbl=("correlation",))
def q_corr_matrix(spark, d):
    """Pearson correlation of asset returns with macro indicators."""
    return _m(spark, d).ref("macro_asset_correlation")


# ----------------------------------------------------- tick / vendor normalisation (B)

from tidemark.functions import scalar as SC  # noqa: E402
from tidemark.operators import relational as R  # noqa: E402
from tidemark.operators import windows as W  # noqa: E402
from tidemark.plans import reports as RP  # noqa: E402
from tidemark.plans import standins as S  # noqa: E402
from tidemark.plans.standins import table as _t  # noqa: E402
from tidemark.sources import vendor as V  # noqa: E402


@register("daily_bars", """
SELECT user_id, CAST(ts AS DATE) AS date, arg_min(value, (ts, event_id)) AS open, max(value) AS high,
       min(value) AS low, arg_max(value, (ts, event_id)) AS close, count(*) AS volume
FROM events GROUP BY user_id, CAST(ts AS DATE)""", dbl=("open", "high", "low", "close"))
def q_daily_bars(spark, d):
    """Intraday events -> daily OHLCV bars per user (first/last by time)."""
    return V.ohlcv_bars(_t(spark, d, "events"), "user_id", "ts", "value", seq="event_id")


@register("daily_downsample", """
SELECT event_type, date, ts_ms, value, user_id FROM (
  SELECT event_type, DATE '1970-01-01' + CAST(floor(ts_ms / 86400000) AS INTEGER) AS date, ts_ms, value, user_id,
         row_number() OVER (PARTITION BY event_type, CAST(floor(ts_ms / 86400000) AS INTEGER)
                            ORDER BY ts_ms DESC, event_id ASC) AS rn
  FROM (SELECT *, CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS ts_ms FROM events)) WHERE rn = 1""",
          dbl=("value",))
def q_daily_downsample(spark, d):
    """Per key and UTC day keep the point with the greatest millisecond timestamp."""
    ev = _t(spark, d, "events").withColumn("ts_ms", F.unix_millis(F.col("ts").cast("timestamp")))
    return V.daily_downsample(ev, "event_type", "ts_ms", ["value", "user_id"], seq="event_id")


@register("dedup_latest", """
SELECT event_id, user_id, event_date, event_type, value FROM (
  SELECT event_id, user_id, CAST(ts AS DATE) AS event_date, event_type, value,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""", dbl=("value",))
def q_dedup_latest(spark, d):
    """latest event per (user, day); ties broken by event id."""
    ev = _t(spark, d, "events").withColumn("event_date", F.to_date("ts"))
    out = W.dedup_latest(ev, ["user_id", "event_date"],
                         [F.col("ts").desc_nulls_first(), F.col("event_id").desc_nulls_first()])
    return out.select("event_id", "user_id", "event_date", "event_type", "value")


@register("variant_extract", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(NULL AS INTEGER) AS missing FROM events""")
def q_variant_extract(spark, d):
    """Parse JSON props to VARIANT; typed path extract; a missing path is NULL."""
    ev = _t(spark, d, "events").select("event_id", F.parse_json("props").alias("v"))
    return ev.select("event_id", F.variant_get("v", "$.k", "int").alias("k"),
                     F.try_variant_get("v", "$.missing", "int").alias("missing"))


@register("score_band", """
SELECT event_id, k, CASE WHEN k < 25 THEN 'Extreme Fear' WHEN k < 45 THEN 'Fear'
                         WHEN k < 55 THEN 'Neutral' WHEN k < 75 THEN 'Greed'
                         ELSE 'Extreme Greed' END AS band
FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""")
def q_score_band(spark, d):
    """0-100 score -> sentiment band on half-open intervals."""
    ev = _t(spark, d, "events").select(
        "event_id", F.variant_get(F.parse_json("props"), "$.k", "int").alias("k"))
    return ev.select("event_id", "k", SC.score_band("k").alias("band"))


@register("epoch_to_date", """
SELECT event_id, epoch_s, DATE '1970-01-01' + CAST(floor(epoch_s / 86400) AS INTEGER) AS utc_date
FROM (SELECT event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS epoch_s FROM events)""")
def q_epoch_to_date(spark, d):
    """Epoch seconds -> UTC date."""
    ev = _t(spark, d, "events").select(
        "event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("epoch_s"))
    return ev.select("event_id", "epoch_s", SC.epoch_to_date("epoch_s").alias("utc_date"))


@register("date_range_filter", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'""")
def q_date_range_filter(spark, d):
    """Inclusive start <= date <= end (bounds pushed to the scan)."""
    o = R.between_dates(_t(spark, d, "orders"), "o_orderdate", "1996-01-01", "1996-12-31")
    return o.select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))


_RAW_TEXT_SQL = """(SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN '.' WHEN 'O' THEN ''
       ELSE CAST(o_totalprice AS VARCHAR) END AS raw_value FROM orders)"""


@register("sentinel_to_null", f"""
SELECT o_orderkey, raw_value,
       CASE WHEN raw_value IS NULL OR raw_value IN ('.', '') THEN NULL ELSE CAST(raw_value AS DOUBLE) END AS value
FROM {_RAW_TEXT_SQL}""", dbl=("value",))
def q_sentinel_to_null(spark, d):
    """B2: vendor text values; '.' and '' are missing, the rest parse as double.

    Stand-in text: order status P -> '.', O -> '', else the total price."""
    o = _t(spark, d, "orders")
    raw = (F.when(F.col("o_orderstatus") == "P", ".").when(F.col("o_orderstatus") == "O", "")
           .otherwise(F.col("o_totalprice").cast("string")))
    return o.select("o_orderkey", raw.alias("raw_value")).select(
        "o_orderkey", "raw_value", SC.sentinel_to_null("raw_value").alias("value"))


@register("nan_to_null", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN isnan(TRY_CAST(t AS DOUBLE)) THEN NULL ELSE TRY_CAST(t AS DOUBLE) END AS value
FROM (SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN 'NaN' WHEN 'A' THEN 'n/a'
             ELSE CAST(l_discount AS VARCHAR) END AS t FROM lineitem)""", dbl=("value",))
def q_nan_to_null(spark, d):
    """Non-numeric or NaN text -> NULL. Stand-in text: flag R -> 'NaN', A -> 'n/a'."""
    li = _t(spark, d, "lineitem")
    t = (F.when(F.col("l_returnflag") == "R", "NaN").when(F.col("l_returnflag") == "A", "n/a")
         .otherwise(F.col("l_discount").cast("string")))
    return li.select("l_orderkey", "l_linenumber", SC.nan_to_null(t).alias("value"))


@register("trunc_int", """
SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice / 7 - 5000) AS BIGINT) AS truncated
FROM lineitem""")
def q_trunc_int(spark, d):
    """Float -> integer truncating toward zero (negative values included)."""
    li = _t(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     SC.trunc_int(F.col("l_extendedprice") / F.lit(7) - F.lit(5000)).alias("truncated"))


@register("top_n", """
SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey ASC LIMIT 20""",
          dbl=("c_acctbal",))
def q_top_n(spark, d):
    """Top 20 by a metric (TakeOrderedAndProject)."""
    return V.top_n_by(_t(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"),
                      "c_acctbal", 20, tie="c_custkey")


@register("universe_filter", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
          dbl=("o_totalprice",))
def q_universe_filter(spark, d):
    """Keep rows whose key is in a universe table (left semi join)."""
    universe = _t(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return V.universe_filter(o, universe, "o_custkey", "c_custkey")


@register("date_sequence", """
SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
                                   INTERVAL 1 DAY)) AS DATE) AS date_day FROM orders""")
def q_date_sequence(spark, d):
    """Every day between the first and last order date, both inclusive."""
    b = _t(spark, d, "orders").agg(F.min(F.to_date("o_orderdate")).alias("s"),
                                   F.max(F.to_date("o_orderdate")).alias("e"))
    return R.spine_between(b, "s", "e", inclusive=True)


@register("date_spine", """
SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)) - 1,
                                   INTERVAL 1 DAY)) AS DATE) AS date_day FROM orders""")
def q_date_spine(spark, d):
    """Day spine from start up to but excluding end."""
    b = _t(spark, d, "orders").agg(F.min(F.to_date("o_orderdate")).alias("s"),
                                   F.max(F.to_date("o_orderdate")).alias("e"))
    return R.spine_between(b, "s", "e", inclusive=False)


@register("spine_join", """
WITH b AS (SELECT min(CAST(l_shipdate AS DATE)) s, max(CAST(l_shipdate AS DATE)) e FROM lineitem),
sp AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date_day FROM b),
o AS (SELECT CAST(o_orderdate AS DATE) AS date_day, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT sp.date_day, o.n_orders FROM sp LEFT JOIN o ON sp.date_day = o.date_day""")
def q_spine_join(spark, d):
    """Daily order counts aligned on the full shipping calendar; no day dropped."""
    b = _t(spark, d, "lineitem").agg(F.min(F.to_date("l_shipdate")).alias("s"),
                                     F.max(F.to_date("l_shipdate")).alias("e"))
    spine = R.spine_between(b, "s", "e", inclusive=True)
    counts = _t(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("od")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    return R.spine_join(spine, counts, "date_day", "od")


@register("safe_divide", """
SELECT l_orderkey, l_linenumber, l_discount / NULLIF(l_tax, 0) AS ratio,
       (100 * l_discount) / NULLIF(l_tax, 0) AS ratio_pct FROM lineitem""",
          dbl=("ratio", "ratio_pct"))
def q_safe_divide(spark, d):
    """C4: division that is NULL on a zero denominator; scaled numerator first."""
    li = _t(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     SC.safe_divide("l_discount", "l_tax").alias("ratio"),
                     SC.safe_divide(F.lit(100) * F.col("l_discount"), "l_tax").alias("ratio_pct"))


@register("case_label", """
SELECT o_orderkey,
       CASE WHEN o_totalprice >= 300000 THEN 'large' WHEN o_totalprice >= 100000 THEN 'medium' END AS size_no_else,
       CASE WHEN o_totalprice >= 300000 THEN 'large' WHEN o_totalprice >= 100000 THEN 'medium'
            ELSE 'small' END AS size_label
FROM orders""")
def q_case_label(spark, d):
    """Searched CASE with and without ELSE (no ELSE -> NULL)."""
    o = _t(spark, d, "orders")
    p = F.col("o_totalprice")
    no_else = F.when(p >= 300000, "large").when(p >= 100000, "medium")
    return o.select("o_orderkey", no_else.alias("size_no_else"),
                    no_else.otherwise("small").alias("size_label"))


@register("ilike_filter", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RING%'")
def q_ilike_filter(spark, d):
    """Case-insensitive contains (user text is a live pattern)."""
    return _t(spark, d, "part").select("p_partkey", "p_name").filter(R.ilike_contains("p_name", "RING"))


@register("ci_in_filter", """
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE upper(c_mktsegment) IN ('BUILDING', 'MACHINERY') OR upper(c_name) IN ('CUSTOMER#000000007')""")
def q_ci_in_filter(spark, d):
    """Case-insensitive IN list over two columns."""
    c = _t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return c.filter(R.ci_in(["c_mktsegment", "c_name"], ["building", "Machinery", "customer#000000007"]))


# ------------------------------------------------------ windows and aggregates (E, F)

from tidemark.functions import indicators as IND  # noqa: E402
from tidemark.operators import incremental as INC  # noqa: E402
from tidemark.operators import quality as DQ  # noqa: E402
from tidemark.operators import tail_state as TS  # noqa: E402
from tidemark.plans import medallion as M  # noqa: E402


@register("daily_return", O.cte("tech_base") + """
SELECT ticker, price_date, close_price, prev_close, daily_change, daily_change / NULLIF(prev_close, 0) AS daily_return
FROM tech_base""", dbl=("daily_return",), coarse=("close_price", "prev_close", "daily_change"))
def q_daily_return(spark, d):
    """previous close (previous row), change and return per ticker."""
    stg = _m(spark, d).ref("stg_daily_prices").select("ticker", "price_date", "close_price")
    return W.with_returns(stg, "close_price", "ticker", "price_date", prev="prev_close")


@register("moving_average", O.cte("technicals") + "SELECT ticker, price_date, ma_20, ma_50, ma_200 FROM technicals",
          coarse=("ma_20", "ma_50", "ma_200"))
def q_moving_average(spark, d):
    """trailing 20/50/200-row simple moving averages (partial frames average what exists)."""
    stg = _m(spark, d).ref("stg_daily_prices")
    return stg.select("ticker", "price_date", *[
        IND.moving_average("close_price", "ticker", "price_date", n).alias(f"ma_{n}") for n in (20, 50, 200)])


@register("rsi", O.cte("technicals") + "SELECT ticker, price_date, rsi_14 FROM technicals", dbl=("rsi_14",))
def q_rsi(spark, d):
    """14-row RSI from simple gain/loss averages (no losses -> NULL)."""
    r = W.with_returns(_m(spark, d).ref("stg_daily_prices"), "close_price", "ticker", "price_date")
    return r.select("ticker", "price_date", IND.rsi("daily_change", "ticker", "price_date", 14).alias("rsi_14"))


@register("bollinger", O.cte("technicals") + "SELECT ticker, price_date, bb_middle, bb_upper, bb_lower FROM technicals",
          coarse=("bb_middle", "bb_upper", "bb_lower"))
def q_bollinger(spark, d):
    """20-row Bollinger bands at 2 sample standard deviations."""
    mid, up, lo = IND.bollinger("close_price", "ticker", "price_date", 20, 2)
    return _m(spark, d).ref("stg_daily_prices").select(
        "ticker", "price_date", mid.alias("bb_middle"), up.alias("bb_upper"), lo.alias("bb_lower"))


@register("latest_per_key", O.cte("stg_fund") + """
SELECT ticker, snapshot_date, market_cap, pe_ratio, industry FROM stg_fund
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY snapshot_date DESC NULLS FIRST) = 1""",
          dbl=("pe_ratio",), ints=("market_cap",))
def q_latest_per_key(spark, d):
    """newest fundamentals snapshot per ticker."""
    f = _m(spark, d).ref("stg_fundamentals")
    return W.latest_per_key(f, "ticker", "snapshot_date").select(
        "ticker", "snapshot_date", "market_cap", "pe_ratio", "industry")


@register("lag_k", O.cte("regime_daily") + "SELECT * FROM regime_daily",
          dbl=("sp500_return", "btc_return", "vix", "fed_funds_rate", "fed_funds_prev"))
def q_lag_k(spark, d):
    """Per-day regime labels; Fed funds compared with its value 5 trading
    days earlier over the whole (unpartitioned) history."""
    return M.regime_timeline(_m(spark, d).stored("daily_market_snapshot"))


@register("breadth", O.cte("technicals", "tickers") + """
SELECT t.price_date, count(*) FILTER (WHERE t.daily_return > 0) AS advancers,
       count(*) FILTER (WHERE t.daily_return < 0) AS decliners
FROM technicals t JOIN tickers s ON t.ticker = s.ticker GROUP BY t.price_date""")
def q_breadth(spark, d):
    """Advancers and decliners among constituents (inner join to the seed)."""
    m = _m(spark, d)
    return R.breadth(m.ref("prices_with_technicals"), "daily_return", "price_date",
                     universe=m.seeds["tickers"], key="ticker")


@register("distinct_days", O.cte("stg_prices") + "SELECT DISTINCT price_date AS snapshot_date FROM stg_prices")
def q_distinct_days(spark, d):
    """Distinct trading days."""
    return _m(spark, d).ref("stg_daily_prices").select(F.col("price_date").alias("snapshot_date")).distinct()


@register("pivot_entities", O.cte("stg_prices") + """
SELECT price_date, max(CASE WHEN ticker = '^A' THEN close_price END) AS sp500_close,
       max(CASE WHEN ticker = '^N' THEN close_price END) AS nasdaq_close,
       max(CASE WHEN ticker = '^R' THEN close_price END) AS dow_close
FROM stg_prices GROUP BY price_date""", coarse=("sp500_close", "nasdaq_close", "dow_close"))
def q_pivot_entities(spark, d):
    """Index closes pivoted onto one row per date."""
    return R.pivot_long(_m(spark, d).ref("stg_daily_prices"), "price_date", "ticker", "close_price",
                        {"^A": "sp500_close", "^N": "nasdaq_close", "^R": "dow_close"})


_ASSET_STATS_SQL = """
SELECT asset_id, arg_min(asset_name, price_date) AS asset_name, arg_min(asset_type, price_date) AS asset_type,
       count(*) AS num_days,
       arg_max(close, price_date) FILTER (WHERE close IS NOT NULL) AS latest_close,
       CASE WHEN count(close) >= 2 THEN arg_max(close, price_date) FILTER (WHERE close IS NOT NULL)
            / NULLIF(arg_min(close, price_date) FILTER (WHERE close IS NOT NULL), 0) - 1 END AS cumulative_return,
       avg(daily_return) AS avg_daily_return,
       CASE WHEN count(daily_return) >= 2 THEN stddev_pop(daily_return) END AS volatility
FROM {src} GROUP BY asset_id"""


@register("asset_stats", O.cte("asset_prices") + _ASSET_STATS_SQL.format(src="asset_prices"),
          dbl=("cumulative_return", "avg_daily_return", "volatility"), coarse=("latest_close",))
def q_asset_stats(spark, d):
    """Per-asset days, latest close, cumulative return, mean return, population volatility."""
    return R.asset_stats(_m(spark, d).ref("asset_prices"), "asset_id", "price_date", "close",
                         "daily_return", first_cols=("asset_name", "asset_type"))


@register("best_worst", O.cte("sector_perf") + """
SELECT b.gics_sector, b.price_date AS best_date, b.avg_daily_return AS best_return,
       w.price_date AS worst_date, w.avg_daily_return AS worst_return
FROM (SELECT *, row_number() OVER (PARTITION BY gics_sector ORDER BY (avg_daily_return IS NULL),
                                   avg_daily_return DESC, price_date ASC) AS rn FROM sector_perf) b
JOIN (SELECT *, row_number() OVER (PARTITION BY gics_sector ORDER BY (avg_daily_return IS NULL),
                                   avg_daily_return ASC, price_date ASC) AS rn FROM sector_perf) w
  ON b.gics_sector = w.gics_sector AND b.rn = 1 AND w.rn = 1""", dbl=("best_return", "worst_return"))
def q_best_worst(spark, d):
    """Best and worst day per sector (ties -> earliest date, NULL loses)."""
    bw = R.best_worst(_m(spark, d).ref("sector_performance"), "gics_sector", "price_date", "avg_daily_return")
    return bw.select("gics_sector", F.col("best_day.date").alias("best_date"),
                     F.col("best_day.return").alias("best_return"), F.col("worst_day.date").alias("worst_date"),
                     F.col("worst_day.return").alias("worst_return"))


@register("nested_series", O.cte("sector_perf") + """
SELECT gics_sector, strftime(price_date, '%Y-%m') AS month, price_date, avg_daily_return,
       count(*) OVER (PARTITION BY gics_sector, strftime(price_date, '%Y-%m')) AS n_days,
       row_number() OVER (PARTITION BY gics_sector, strftime(price_date, '%Y-%m') ORDER BY price_date) - 1 AS place
FROM sector_perf""", dbl=("avg_daily_return",))
def q_nested_series(spark, d):
    """Each sector's rows as date-ordered arrays, one per month (a bounded
    period), every element of which is returned with its place."""
    sp = _m(spark, d).ref("sector_performance").withColumn("month", F.date_format("price_date", "yyyy-MM"))
    ns = R.nested_series(sp, ["gics_sector", "month"], "price_date", ["avg_daily_return"])
    return ns.select("gics_sector", "month", F.size("daily_series").cast("bigint").alias("n_days"),
                     F.posexplode("daily_series").alias("place", "e")).select(
        "gics_sector", "month", "n_days", F.col("place").cast("bigint").alias("place"), "e.price_date",
        "e.avg_daily_return")


@register("sector_cumulative", O.cte("sector_perf") + """
SELECT gics_sector, sum(avg_daily_return) * 100 AS cumulative_return_pct FROM sector_perf GROUP BY gics_sector""",
          coarse=("cumulative_return_pct",))
def q_sector_cumulative(spark, d):
    """Plain sum of daily mean returns per sector, in percent."""
    return RP.sector_cumulative(_m(spark, d).ref("sector_performance"))


_IND = ["VIX", "TREASURY_10Y", "TREASURY_2Y", "FED_FUNDS_RATE", "WTI_CRUDE_OIL"]


@register("corr_wide", O.cte("correlation") + "SELECT asset, " + ", ".join(
    f"max(CASE WHEN macro_indicator = '{i}' THEN correlation END) AS {i}" for i in _IND)
          + " FROM correlation GROUP BY asset", dbl=tuple(_IND))
def q_corr_wide(spark, d):
    """Asset x indicator matrix (duplicate key fails the job)."""
    return RP.corr_wide(_m(spark, d).ref("macro_asset_correlation"), _IND)


@register("regime_bars", O.cte("regime") + """
SELECT rate_regime || ' / ' || vol_regime AS regime, avg_sp500_return * 100 AS avg_sp500_return_pct, num_days
FROM regime""", dbl=("avg_sp500_return_pct",))
def q_regime_bars(spark, d):
    """M18/C16/C17: 'rate / vol' label and mean S&P return in percent."""
    return RP.regime_bars(_m(spark, d).ref("regime_analysis"))


@register("corr_interpretation", O.cte("correlation") + """
SELECT asset, macro_indicator, correlation, n_obs,
       CASE WHEN correlation IS NULL THEN 'insufficient overlapping data to compute'
            ELSE (CASE WHEN abs(correlation) >= 0.6 THEN 'strong' WHEN abs(correlation) >= 0.3 THEN 'moderate'
                       ELSE 'weak' END) || ' ' || (CASE WHEN correlation > 0 THEN 'positive' ELSE 'negative' END)
                 || ' correlation' END AS interpretation
FROM correlation""", dbl=("correlation",))
def q_corr_interpretation(spark, d):
    """Plain-language reading of every correlation."""
    c = _m(spark, d).ref("macro_asset_correlation")
    return c.select("*", SC.corr_interpretation("correlation").alias("interpretation"))


# ------------------------------------------------------------------- reports

@register("overview", O.cte("snapshot") + """
SELECT *, CASE WHEN fng_value IS NULL THEN NULL WHEN fng_value < 25 THEN 'Extreme Fear' WHEN fng_value < 45 THEN 'Fear'
               WHEN fng_value < 55 THEN 'Neutral' WHEN fng_value < 75 THEN 'Greed' ELSE 'Extreme Greed' END AS fng_band,
       CASE WHEN spread_10y_2y < 0 THEN 'Inverted' ELSE 'Normal' END AS curve_status
FROM snapshot ORDER BY snapshot_date DESC NULLS FIRST LIMIT 2""", dbl=SNAP_DBL, coarse=SNAP_COARSE,
          ints=("fng_value",))
def q_overview(spark, d):
    """Two newest snapshot rows with sentiment band and curve label."""
    return RP.overview(_m(spark, d).ref("daily_market_snapshot"))


@register("overview_series", O.cte("snapshot") + """
SELECT snapshot_date, sp500_close FROM snapshot ORDER BY snapshot_date NULLS LAST""", coarse=("sp500_close",))
def q_overview_series(spark, d):
    """The overview's index line, every trading day."""
    return RP.overview_series(_m(spark, d).ref("daily_market_snapshot"))


@register("latest_row", O.cte("snapshot") + "SELECT * FROM snapshot ORDER BY snapshot_date DESC NULLS FIRST LIMIT 1",
          dbl=SNAP_DBL, coarse=SNAP_COARSE, ints=("fng_value",))
def q_latest_row(spark, d):
    """Market snapshot of the latest trading day."""
    return RP.market_snapshot(_m(spark, d).ref("daily_market_snapshot"), "latest")


@register("market_snapshot_on_date", O.cte("snapshot") + "SELECT * FROM snapshot WHERE snapshot_date = DATE '1998-06-15'",
          dbl=SNAP_DBL, coarse=SNAP_COARSE, ints=("fng_value",))
def q_snapshot_on_date(spark, d):
    """Market snapshot of a given 'YYYY-MM-DD' day."""
    return RP.market_snapshot(_m(spark, d).ref("daily_market_snapshot"), "1998-06-15")


@register("sector_report", O.cte("sector_perf") + """
, win AS (SELECT * FROM sector_perf WHERE gics_sector ILIKE '%asia%'
          AND price_date >= (SELECT max(price_date) FROM sector_perf) - INTERVAL 30 DAY)
SELECT (SELECT gics_sector FROM win ORDER BY price_date, gics_sector LIMIT 1) AS sector, '1M' AS period,
       (SELECT count(*) FROM win) AS num_days, (SELECT avg(avg_daily_return) FROM win) AS avg_daily_return,
       (SELECT price_date FROM win ORDER BY (avg_daily_return IS NULL), avg_daily_return DESC, price_date LIMIT 1) AS best_date,
       (SELECT avg_daily_return FROM win ORDER BY (avg_daily_return IS NULL), avg_daily_return DESC, price_date LIMIT 1) AS best_return,
       (SELECT price_date FROM win ORDER BY (avg_daily_return IS NULL), avg_daily_return ASC, price_date LIMIT 1) AS worst_date,
       (SELECT avg_daily_return FROM win ORDER BY (avg_daily_return IS NULL), avg_daily_return ASC, price_date LIMIT 1) AS worst_return,
       (SELECT count(*) FROM win) AS series_len""", dbl=("avg_daily_return", "best_return", "worst_return"))
def q_sector_report(spark, d):
    """Trailing-period sector report ('asia', 1M, as of the newest day)."""
    m = _m(spark, d)
    newest = m.ref("stg_daily_prices").join(m.seeds["tickers"].select("ticker"), "ticker", "left_semi") \
        .agg(F.max("price_date")).scalar()
    r = RP.sector_report(m.ref("sector_performance"), "asia", "1M", as_of=newest)
    return r.select("sector", "period", "num_days", "avg_daily_return",
                    F.col("best_day.date").alias("best_date"), F.col("best_day.return").alias("best_return"),
                    F.col("worst_day.date").alias("worst_date"), F.col("worst_day.return").alias("worst_return"),
                    F.size("daily_series").cast("bigint").alias("series_len"))


@register("macro_impact", O.cte("correlation") + """
SELECT asset, macro_indicator, correlation, n_obs,
       CASE WHEN correlation IS NULL THEN 'insufficient overlapping data to compute'
            ELSE (CASE WHEN abs(correlation) >= 0.6 THEN 'strong' WHEN abs(correlation) >= 0.3 THEN 'moderate'
                       ELSE 'weak' END) || ' ' || (CASE WHEN correlation > 0 THEN 'positive' ELSE 'negative' END)
                 || ' correlation' END AS interpretation
FROM correlation WHERE asset ILIKE '%sp%' AND macro_indicator ILIKE '%treasury%'
ORDER BY asset, macro_indicator LIMIT 1""", dbl=("correlation",))
def q_macro_impact(spark, d):
    """First correlation matching both fragments, with its reading."""
    return RP.macro_impact(_m(spark, d).ref("macro_asset_correlation"), "treasury", "sp")


@register("compare_assets", O.cte("asset_prices") + """
, win AS (SELECT * FROM asset_prices
          WHERE (upper(asset_id) IN ('^A', 'BITCOIN', 'S7', 'ETH') OR upper(asset_name) IN ('^A', 'BITCOIN', 'S7', 'ETH'))
            AND price_date >= (SELECT max(price_date) FROM asset_prices) - INTERVAL 365 DAY)
SELECT '1Y' AS period, 'returns' AS metric, * FROM (""" + _ASSET_STATS_SQL.format(src="win") + ")",
          dbl=("cumulative_return", "avg_daily_return", "volatility"), coarse=("latest_close",))
def q_compare_assets(spark, d):
    """Side-by-side asset statistics over the trailing year."""
    m = _m(spark, d)
    newest = m.ref("stg_daily_prices").select("price_date").union(
        m.stored("stg_crypto").select("price_date")).agg(F.max("price_date")).scalar()
    return RP.compare_assets(m.ref("asset_prices"), ["^a", "bitcoin", "S7", "eth"], period="1Y", as_of=newest)


@register("regime_report", O.cte("regime") + """
SELECT 'fed_funds_rate' AS indicator, rate_regime, vol_regime, num_days, avg_sp500_return, avg_btc_return
FROM regime ORDER BY rate_regime, vol_regime""", dbl=("avg_sp500_return", "avg_btc_return"))
def q_regime_report(spark, d):
    """Regimes sorted by (rate, vol)."""
    return RP.regime_report(_m(spark, d).ref("regime_analysis"))


# -------------------------------------------------------- quality checks (K1-K8)

@register("dq_not_null", O.cte("macro_wide") + "SELECT observation_date, treasury_2y FROM macro_wide WHERE treasury_2y IS NULL")
def q_dq_not_null(spark, d):
    """K1: dates of the wide macro table missing the 2-year yield."""
    return DQ.dq_not_null(_m(spark, d).ref("macro_pivot"), "treasury_2y").select(
        "observation_date", F.col("treasury_2y").cast("double").alias("treasury_2y"))


@register("dq_unique", O.cte("sectors") + """
SELECT gics_sector, count(*) AS n_records FROM sectors WHERE gics_sector IS NOT NULL
GROUP BY gics_sector HAVING count(*) > 1""")
def q_dq_unique(spark, d):
    """K2: GICS sectors listed more than once in the sector dimension."""
    return DQ.dq_unique(_m(spark, d).ref("dim_sectors"), "gics_sector")


@register("dq_unique_combo", """
SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_dq_unique_combo(spark, d):
    """K3: duplicated (order, line) keys."""
    return DQ.dq_unique_combo(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("dq_range", "SELECT event_id, value FROM events WHERE NOT (value >= 0 AND value <= 100)", dbl=("value",))
def q_dq_range(spark, d):
    """K4: values outside [0, 100] (NULL passes)."""
    return DQ.dq_range(_t(spark, d, "events").select("event_id", "value"), "value", 0, 100)


@register("dq_future_dates", O.cte("stg_prices") + """
SELECT ticker, price_date FROM stg_prices WHERE price_date > DATE '2001-06-30'""")
def q_dq_future_dates(spark, d):
    """K5: price dates after the as-of date (2001-06-30)."""
    stg = _m(spark, d).ref("stg_daily_prices").select("ticker", "price_date")
    return DQ.dq_future_dates(stg, "price_date", F.to_date(F.lit("2001-06-30")))


@register("dq_bounds", O.cte("stg_fund") + """
SELECT ticker, snapshot_date, market_cap FROM stg_fund
WHERE market_cap IS NOT NULL AND (market_cap <= 0 OR market_cap > 100000000000000)""", ints=("market_cap",))
def q_dq_bounds(spark, d):
    """K6: market caps present but <= 0 or above 100 trillion."""
    f = _m(spark, d).ref("stg_fundamentals").select("ticker", "snapshot_date", "market_cap")
    return DQ.dq_bounds(f, "market_cap")


from tidemark.plans import jobs as J  # noqa: E402

_TABLE_CTE = {"stg_daily_prices": "stg_prices", "stg_fundamentals": "stg_fund", "stg_fear_greed": "stg_fng",
              "prices_with_technicals": "technicals", "crypto_with_dominance": "crypto_dom",
              "macro_pivot": "macro_wide", "asset_daily_returns": "asset_returns", "dim_macro_indicators": "series",
              "dim_sectors": "sectors", "daily_market_snapshot": "snapshot", "sector_performance": "sector_perf",
              "regime_analysis": "regime", "macro_asset_correlation": "correlation"}


def _test_sql(table: str, test: str, args) -> str:
    """One data test as its own query over the oracle's tables."""
    src = _TABLE_CTE.get(table, table)
    name = f"{table}.{test}.{args if isinstance(args, str) else '+'.join(str(a) for a in args)}"
    if test in ("unique", "unique_combo"):
        keys = args if isinstance(args, str) else ", ".join(args)
        some = f"WHERE {args} IS NOT NULL" if test == "unique" else ""
        body = f"(SELECT 1 FROM {src} {some} GROUP BY {keys} HAVING count(*) > 1)"
    elif test == "not_null":
        body = f"{src} WHERE {args} IS NULL"
    elif test == "future_dates":
        body = f"{src} WHERE {args} > DATE '2001-12-31'"
    elif test == "bounds":
        body = f"{src} WHERE NOT ({args} > 0 AND {args} <= 100000000000000)"
    else:
        c, low, high = args
        body = f"{src} WHERE {c} < {low}" + (f" OR {c} > {high}" if high is not None else "")
    return f"SELECT '{name}' AS check_name, count(*) AS failures FROM {body}"


@register("dq_report", O.cte(*dict.fromkeys(_TABLE_CTE.get(t, t) for t, *_ in J.TESTS))
          + "\nUNION ALL ".join(_test_sql(*t) for t in J.TESTS))
def q_dq_report(spark, d):
    """K1-K6, K8: failures of every data test of the build (the gate's input)."""
    m = _m(spark, d).narrow("stg_daily_prices", *_CLOSES).narrow("stg_fundamentals", "ticker", "snapshot_date", "market_cap")
    for name in ("stg_daily_prices", "daily_market_snapshot"):
        m.stored(name)  # each has several tests and consumers
    return J.quality_report(m.ref, as_of=F.to_date(F.lit("2001-12-31")))


@register("dq_measured", O.cte(*dict.fromkeys(_TABLE_CTE.get(t, t) for t, *_ in J.TESTS if t in (
          "stg_daily_prices", "stg_macro", "crypto_with_dominance", "macro_pivot"))) + "\nUNION ALL ".join(
          _test_sql(*t) for t in J.TESTS if t[0] in ("stg_daily_prices", "stg_macro", "crypto_with_dominance", "macro_pivot")))
def q_dq_measured(spark, d):
    """K1-K8: row tests counted while their tables are stored; only key columns are read again."""
    m, measured = _m(spark, d), {}
    as_of, root = F.to_date(F.lit("2001-12-31")), scratch_path(spark, "measured")
    names = ("stg_daily_prices", "stg_macro", "crypto_with_dominance", "macro_pivot")
    for name in names:
        m.keep(name, J.store(m.ref(name), f"{root}/{name}", J.PARTITIONED.get(name), J.row_tests(name, as_of=as_of), measured))
    return J.quality_report(m.ref, [t for t in J.TESTS if t[0] in names], as_of, measured)


# ------------------------------------------------------------- incremental

@register("incremental_filter", O.cte("stg_prices", "stg_fng") + """
SELECT ticker, price_date FROM stg_prices WHERE price_date > (SELECT max(reading_date) FROM stg_fng)""")
def q_incremental_filter(spark, d):
    """Trading rows newer than the sentiment feed's high-water mark
    (a scalar subquery over the other table)."""
    m = _m(spark, d)
    hwm = INC.high_water_mark(m.ref("stg_fear_greed"), "reading_date")
    return INC.incremental_filter(m.ref("stg_daily_prices").select("ticker", "price_date"), "price_date", hwm)


# ------------------------------------------------ landing, ingest and streaming (A, J)

from tidemark.session import scratch_path  # noqa: E402
from tidemark.sources import landing as L  # noqa: E402
from tidemark.streaming import jobs as ST  # noqa: E402

_EVENT_FIELDS_SQL = """
SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS event_date FROM events"""


def _event_records(spark, d) -> DataFrame:
    """Events in landing-record shape (one JSON object per event, dated by day)."""
    ev = _t(spark, d, "events")
    return ev.select("event_id", "user_id", "event_type", "value",
                     F.date_format("ts", "yyyy-MM-dd").alias("date"))


def _typed_events(bronze: DataFrame) -> DataFrame:
    v = F.col("raw_data")
    return bronze.select(F.variant_get(v, "$.event_id", "bigint").alias("event_id"),
                         F.variant_get(v, "$.user_id", "bigint").alias("user_id"),
                         F.variant_get(v, "$.event_type", "string").alias("event_type"),
                         F.variant_get(v, "$.value", "double").alias("value"),
                         F.to_date(F.regexp_extract(F.col("_file_name"), r"date=(\d{4}-\d{2}-\d{2})", 1))
                         .alias("event_date"))


@register("json_landing_scan", _EVENT_FIELDS_SQL, dbl=("value",))
def q_json_landing_scan(spark, d):
    """Events landed as JSON-lines files (one folder per day,
    dynamic overwrite), scanned and ingested into Bronze twice; Bronze's own
    file-identity columns act as the ledger (the second run adds nothing).
    Rows are then typed from the VARIANT payload. The one-array-per-file landing format goes through the same scan
    (covered by the ingest tests)."""
    root = scratch_path(spark, "landing-events")
    L.write_landing(_event_records(spark, d), root, "date")
    bronze = root + "-bronze"
    L.ingest(spark, root, "events", bronze)
    L.ingest(spark, root, "events", bronze)
    return _typed_events(spark.read.parquet(bronze))


@register("bad_records", """
SELECT CAST(ts AS DATE) AS day, count(*) AS n_bad FROM events WHERE event_id % 13 = 0 GROUP BY ALL""")
def q_bad_records(spark, d):
    """A5: malformed records per landing file: every thirteenth event is cut off in its file of lines; a scan
    that is to abort on them is held to that in the tests."""
    root = scratch_path(spark, "landing-broken")
    record = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    lines = _t(spark, d, "events").select(
        F.when(F.col("event_id") % 13 == 0, F.substring(record, 1, 12)).otherwise(record).alias("value"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"))
    lines.repartition("date").write.partitionBy("date").option("compression", "none").format("text").save(root + "-text")
    # text files end in .txt; the landing zone's are .json
    day = F.to_date(F.regexp_extract("file_path", r"date=(\d{4}-\d{2}-\d{2})", 1))
    return L.bad_records(spark, root + "-text", glob="*.txt").groupBy(day.alias("day")).agg(F.sum("n_bad").alias("n_bad"))


@register("backfill_range", _EVENT_FIELDS_SQL + """ WHERE CAST(ts AS DATE) BETWEEN
  (SELECT min(CAST(ts AS DATE)) + 1 FROM events) AND (SELECT max(CAST(ts AS DATE)) - 1 FROM events)""", dbl=("value",))
def q_backfill_range(spark, d):
    """A backfill of all days but the first and the last, in two runs whose ranges overlap: the
    second one takes only the files that the first did not."""
    root = scratch_path(spark, "landing-backfill")
    L.write_landing(_event_records(spark, d), root, "date")
    first, last = _t(spark, d, "events").agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    days = [(first + dt.timedelta(days=1)).isoformat(), ((first + (last - first) / 2)).isoformat(),
            (last - dt.timedelta(days=1)).isoformat()]
    L.ingest(spark, root, "events", root + "-bronze", days[0], days[1])
    L.ingest(spark, root, "events", root + "-bronze", days[0], days[2])
    return _typed_events(spark.read.parquet(root + "-bronze"))


@register("csv_export", O.cte("sector_perf") + "SELECT * FROM sector_perf", dbl=("avg_daily_return", "total_close_price"))
def q_csv_export(spark, d):
    """A Gold table stored in its layer's folder, exported as CSV with a header and read back."""
    root = scratch_path(spark, "export")
    table = J.store(_m(spark, d).ref("sector_performance"), J.layer_path(root, "gold", "sector_performance"), "price_date")
    table.write.option("header", True).csv(root + "-csv")
    return spark.read.schema(table.schema).option("header", True).csv(root + "-csv")


@register("load_counts", """
WITH t AS (
  SELECT 'raw_stock_prices' AS table_name, count(DISTINCT CAST(l_shipdate AS DATE)) AS files, 2 * count(*) AS rows_loaded FROM lineitem
  UNION ALL SELECT 'raw_stock_fundamentals', count(DISTINCT CAST(l_shipdate AS DATE)), count(*) FROM lineitem
  UNION ALL SELECT 'raw_fred_series', count(DISTINCT CAST(o_orderdate AS DATE)), count(*) FROM orders
  UNION ALL SELECT 'raw_crypto_prices', 1, count(*) FROM (SELECT DISTINCT o_orderstatus,
            floor((CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 86400000
                   + o_orderkey % 86400000) / 86400000) FROM orders)
  UNION ALL SELECT 'raw_fear_greed', count(DISTINCT CAST(o_orderdate AS DATE)), count(*) FROM orders)
SELECT * FROM t UNION ALL SELECT 'TOTAL', sum(files), sum(rows_loaded) FROM t""",
          ints=("files", "rows_loaded"))
def q_load_counts(spark, d):
    """A4: files and rows loaded per Bronze table, plus the total."""
    m = _m(spark, d)
    out = L.load_counts({n: m.bronze[n] for n in ("raw_stock_prices", "raw_stock_fundamentals",
                                                   "raw_fred_series", "raw_crypto_prices", "raw_fear_greed")})
    return out.select("table_name", F.col("files").cast("double").alias("files"),
                      F.col("rows_loaded").cast("double").alias("rows_loaded"))


@register("stream_ingest", _EVENT_FIELDS_SQL, dbl=("value",))
def q_stream_ingest(spark, d):
    """Landing files ingested by a checkpointed file stream, run twice
    (the second run finds no new file), then typed from the VARIANT payload."""
    root = scratch_path(spark, "landing-stream")
    L.write_landing(_event_records(spark, d), root, "date")
    bronze, ck = root + "-bronze", root + "-ckpt"
    for _ in range(2):
        ST.ingest_stream(spark, root, "events", bronze, ck).awaitTermination()
    return _typed_events(spark.read.parquet(bronze))


@register("stream_dedup_latest", """
SELECT event_id, user_id, event_date, event_type, value FROM (
  SELECT event_id, user_id, CAST(ts AS DATE) AS event_date, event_type, value,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""", dbl=("value",))
def q_stream_dedup_latest(spark, d):
    """Latest event per (user, day) kept across micro-batches: each batch
    is deduplicated and appended (foreachBatch), readers resolve the newest row."""
    src = scratch_path(spark, "events-src")
    ev = _t(spark, d, "events")
    ev.write.parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src) \
        .withColumn("event_date", F.to_date("ts")) \
        .select("event_id", "user_id", "event_date", "event_type", "value", "ts")
    target, ck = src + "-latest", src + "-ckpt"
    order = [F.col("ts").desc_nulls_first(), F.col("event_id").desc_nulls_first()]
    ST.upsert_latest_stream(stream, ["user_id", "event_date"], order, target, ck).awaitTermination()
    return ST.read_latest(spark, target, ["user_id", "event_date"], order).select(
        "event_id", "user_id", "event_date", "event_type", "value")


@register("stream_latest_state", """
SELECT user_id, event_date, x.event_id AS event_id, x.event_type AS event_type, x.value AS value FROM (
  SELECT user_id, CAST(ts AS DATE) AS event_date, arg_max(events, (ts, event_id)) AS x FROM events GROUP BY ALL)""", dbl=("value",))
def q_stream_latest_state(spark, d):
    """Latest event per (user, day) as keyed state of the stream, in two runs from one checkpoint."""
    from tidemark.streaming.latest import upsert_latest_state
    src = scratch_path(spark, "events-state")
    ev, order = _t(spark, d, "events"), ["ts", "event_id"]
    for half in (0, 1):
        ev.filter(F.col("event_id") % 2 == half).coalesce(4).write.parquet(f"{src}/{half}")
        stream = spark.readStream.schema(ev.schema).option("recursiveFileLookup", True).parquet(src) \
            .withColumn("event_date", F.to_date("ts"))
        upsert_latest_state(stream, ["user_id", "event_date"], order, src + "-latest", src + "-ckpt").awaitTermination()
    return ST.read_latest(spark, src + "-latest", ["user_id", "event_date"], [F.col(c).desc_nulls_first() for c in order]).select(
        "event_id", "user_id", "event_date", "event_type", "value")


@register("stream_daily_bars", """
SELECT event_type, CAST(ts AS DATE) AS date, arg_min(value, (ts, event_id)) AS open, max(value) AS high,
       min(value) AS low, arg_max(value, (ts, event_id)) AS close, count(*) AS volume
FROM events GROUP BY event_type, CAST(ts AS DATE)""", dbl=("open", "high", "low", "close"))
def q_stream_daily_bars(spark, d):
    """Watermarked streaming daily bars in update mode, upserted by (type, day):
    the day still open at the watermark is there too."""
    src = scratch_path(spark, "ticks-src")
    ev = _t(spark, d, "events")
    ev.write.parquet(src)
    ticks = spark.readStream.schema(ev.schema).parquet(src).withColumn("ts", F.col("ts").cast("timestamp"))
    out, ck = src + "-bars", src + "-ckpt"
    bars = ST.daily_bars_stream(ticks, "event_type", "ts", "value", seq="event_id")
    ST.upsert_bars(bars, out, ck).awaitTermination()
    return ST.read_bars(spark, out, "event_type")


@register("merge_upsert", O.cte("snapshot") + "SELECT * FROM snapshot", dbl=SNAP_DBL, coarse=SNAP_COARSE,
          ints=("fng_value",))
def q_merge_upsert(spark, d):
    """The snapshot materialised incrementally. A first run builds the
    table as of 1998-12-31; the next run builds only days after the table's
    high-water mark and merges them by snapshot_date into a new version.
    Without late data this equals a full rebuild."""
    m = _m(spark, d)
    root = scratch_path(spark, "snapshot-incremental")

    def build(after):
        return M.daily_market_snapshot(
            m.ref("prices_with_technicals"), m.seeds["tickers"], m.ref("crypto_with_dominance"),
            m.ref("stg_fear_greed"), m.ref("macro_pivot"), None, m.index_tickers,
            m.btc_id, after=after)

    cut = F.to_date(F.lit("1998-12-31"))
    INC.merge_into(spark, root, lambda hwm: build(None).filter(F.col("snapshot_date") <= cut), "snapshot_date")
    return INC.merge_into(spark, root, build, "snapshot_date")


# ------------------------------------------------------------- optional

from tidemark.plans import extras as X  # noqa: E402


def _roll_sql(n: int) -> str:
    w = f"OVER (ORDER BY snapshot_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    a, b = "sp500_return", "vix"
    a2, b2 = f"CASE WHEN {b} IS NOT NULL THEN {a} END", f"CASE WHEN {a} IS NOT NULL THEN {b} END"
    cnt = f"count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) {w}"
    return (f"CASE WHEN {cnt} >= 3 THEN covar_pop({a2}, {b2}) {w} / NULLIF(stddev_pop({a2}) {w} * "
            f"stddev_pop({b2}) {w}, 0) END AS corr_{n}, {cnt} AS n_obs_{n}")


@register("rolling_correlation", O.cte("snapshot") + "SELECT snapshot_date, sp500_return, vix, "
          + ", ".join(_roll_sql(n) for n in (30, 60, 90)) + " FROM snapshot",
          dbl=("sp500_return", "vix", "corr_30", "corr_60", "corr_90"))
def q_rolling_correlation(spark, d):
    """Trailing 30/60/90-day S&P return vs VIX correlation (bucketed frames with halo)."""
    return X.rolling_correlation(_m(spark, d).stored("daily_market_snapshot"))


@register("zscore_outliers", O.cte("dim_tickers") + """
SELECT ticker, gics_sector, CAST(market_cap AS DOUBLE) AS market_cap,
       (CAST(market_cap AS DOUBLE) - avg(CAST(market_cap AS DOUBLE)) OVER (PARTITION BY gics_sector))
         / NULLIF(stddev_samp(CAST(market_cap AS DOUBLE)) OVER (PARTITION BY gics_sector), 0) AS zscore,
       abs((CAST(market_cap AS DOUBLE) - avg(CAST(market_cap AS DOUBLE)) OVER (PARTITION BY gics_sector))
         / NULLIF(stddev_samp(CAST(market_cap AS DOUBLE)) OVER (PARTITION BY gics_sector), 0)) > 3 AS is_outlier
FROM dim_tickers""", dbl=("zscore",), ints=("market_cap",))
def q_zscore_outliers(spark, d):
    """Per-sector market-cap z-score with a 3-sigma flag."""
    return X.market_cap_outliers(_m(spark, d).ref("dim_tickers"))


@register("top_movers", O.cte("technicals", "tickers") + """
SELECT price_date, ticker, daily_return, rn AS rank FROM (
  SELECT t.price_date, t.ticker, t.daily_return,
         row_number() OVER (PARTITION BY t.price_date ORDER BY abs(t.daily_return) DESC, t.ticker ASC) AS rn
  FROM technicals t WHERE t.daily_return IS NOT NULL AND t.ticker IN (SELECT ticker FROM tickers)) WHERE rn <= 3""",
          dbl=("daily_return",))
def q_top_movers(spark, d):
    """Three largest absolute constituent moves per day."""
    m = _m(spark, d)
    out = X.top_movers(m.ref("prices_with_technicals"), m.seeds["tickers"])
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@register("sector_vs_index", O.cte("sector_perf", "snapshot") + """
SELECT s.gics_sector, s.price_date, s.avg_daily_return, n.sp500_return,
       s.avg_daily_return - n.sp500_return AS relative_return
FROM sector_perf s LEFT JOIN snapshot n ON s.price_date = n.snapshot_date""",
          dbl=("avg_daily_return", "sp500_return", "relative_return"))
def q_sector_vs_index(spark, d):
    """Sector return relative to the index on the same day."""
    m = _m(spark, d).narrow("stg_daily_prices", *_CLOSES)
    m.stored("stg_daily_prices")  # the technicals of both sides come from it
    return X.sector_vs_index(m.ref("sector_performance"), m.ref("daily_market_snapshot"))


_FF = ("fed_funds_rate", "treasury_10y", "treasury_2y", "vix", "wti_crude_oil")


@register("forward_fill", O.cte("macro_wide") + "SELECT observation_date, " + ", ".join(
    f"last_value({c} IGNORE NULLS) OVER (ORDER BY observation_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
    for c in _FF) + " FROM macro_wide", dbl=_FF)
def q_forward_fill(spark, d):
    """Sparse macro series carried forward over the whole history (bucketed)."""
    return X.macro_ffill(_m(spark, d).stored("macro_pivot"))


@register("macro_overlay", O.cte("sector_perf", "macro_wide") + """
SELECT s.*, m.fed_funds_rate, m.vix, m.treasury_10y
FROM sector_perf s LEFT JOIN macro_wide m ON s.price_date = m.observation_date""",
          dbl=("avg_daily_return", "fed_funds_rate", "vix", "treasury_10y", "total_close_price"))
def q_macro_overlay(spark, d):
    """Sector rows with the same day's macro context."""
    m = _m(spark, d)
    return X.macro_overlay(m.ref("sector_performance"), m.ref("macro_pivot"))


_CARRIED = """
, known AS (SELECT series_id, observation_date, value FROM stg_macro WHERE value IS NOT NULL),
bounds AS (SELECT series_id, min(observation_date) AS since, (SELECT max(observation_date) FROM known) AS upto
           FROM known GROUP BY series_id)"""


@register("macro_calendar", O.cte("stg_macro") + _CARRIED + """
, spine AS (SELECT series_id, CAST(unnest(generate_series(since, upto, INTERVAL 1 DAY)) AS DATE) AS date_day FROM bounds)
SELECT s.series_id, s.date_day, if(s.date_day - k.observation_date <= 5, k.value, NULL) AS value,
       if(s.date_day - k.observation_date <= 5, k.observation_date, NULL) AS as_of,
       CAST(if(s.date_day - k.observation_date <= 5, s.date_day - k.observation_date, NULL) AS INTEGER) AS age_days
FROM spine s ASOF LEFT JOIN known k ON s.series_id = k.series_id AND s.date_day >= k.observation_date""", dbl=("value",))
def q_macro_calendar(spark, d):
    """Every macro series on every calendar day, its last observation carried for at most five days."""
    return X.macro_calendar(_m(spark, d).stored("stg_macro"), max_age_days=5)


def _context_sql(series: dict[str, str]) -> str:
    parts = [f"""ASOF LEFT JOIN (SELECT observation_date AS day_{c}, value AS {c} FROM stg_macro
WHERE series_id = '{i}' AND value IS NOT NULL) AS of_{c} ON d.price_date >= day_{c}""" for i, c in series.items()]
    return (", context AS (SELECT d.price_date, " + ", ".join(
        f"if(d.price_date <= (SELECT max(observation_date) FROM stg_macro WHERE value IS NOT NULL), {c}, NULL) AS {c}"
        for c in series.values()) + " FROM (SELECT DISTINCT price_date FROM stg_prices) d\n" + "\n".join(parts) + ")")


@register("macro_context", O.cte("stg_macro", "stg_prices") + _context_sql(M.MACRO_SERIES)
          + "SELECT * FROM context", dbl=tuple(M.MACRO_SERIES.values()))
def q_macro_context(spark, d):
    """The wide macro table on trading days, each series carried from its last observation."""
    m = _m(spark, d)
    return X.macro_context(m.stored("stg_macro"), m.ref("stg_daily_prices"), m.macro_series)


@register("macro_overlay_carried", O.cte("sector_perf", "stg_macro", "stg_prices")
          + _context_sql({k: M.MACRO_SERIES[k] for k in ("DFF", "VIXCLS", "DGS10")}) + """
SELECT s.*, fed_funds_rate, vix, treasury_10y FROM sector_perf s LEFT JOIN context USING (price_date)""",
          dbl=("avg_daily_return", "fed_funds_rate", "vix", "treasury_10y", "total_close_price"))
def q_macro_overlay_carried(spark, d):
    """Sector rows with the macro values known on their day."""
    m = _m(spark, d).narrow("stg_daily_prices", *_CLOSES)
    context = X.macro_context(m.stored("stg_macro"), m.stored("stg_daily_prices"), m.macro_series)
    return X.macro_overlay_carried(m.ref("sector_performance"), context)


_WINDOWS = (30, 60, 90)
_ROLLED = tuple(f"corr_{n}" for n in _WINDOWS)


def _pair_corr_sql(over: str, tag: str, least: int = 3) -> str:
    """Correlation of x and y over complete rows (both or neither is NULL), from sums about the pair's means."""
    n, sums = f"count(x) {over}", {k: f"sum({k}) {over}" for k in ("x", "y", "x * y", "x * x", "y * y")}
    top = f"({n} * {sums['x * y']} - {sums['x']} * {sums['y']})"
    below = f"(({n} * {sums['x * x']} - {sums['x']} * {sums['x']}) * ({n} * {sums['y * y']} - {sums['y']} * {sums['y']}))"
    varies = f"min(x) {over} < max(x) {over} AND min(y) {over} < max(y) {over}"
    return f"CASE WHEN {n} >= {least} AND {varies} THEN {top} / sqrt({below}) END AS corr{tag}, {n} AS n_obs{tag}"


def _rolling_sql() -> str:
    return ("SELECT asset, macro_indicator, day, " + ", ".join(_pair_corr_sql(
        f"OVER (PARTITION BY asset, macro_indicator ORDER BY place RANGE BETWEEN {n - 1} PRECEDING AND CURRENT ROW)", f"_{n}")
        for n in _WINDOWS) + " FROM complete")


_COMPLETE = """, complete AS (SELECT asset, macro_indicator, day, place, if(y IS NULL, NULL, x) AS x, if(x IS NULL, NULL, y) AS y FROM paired)
"""
_PAIRED = """
, own AS (SELECT asset_id AS asset, asset_date AS day, daily_return AS x FROM asset_returns
          WHERE asset_id IN ('^A', '^N', '^R', 'bitcoin', 'ethereum', 'tether')),
places AS (SELECT day, row_number() OVER (ORDER BY day) AS place
           FROM (SELECT day FROM own UNION SELECT observation_date FROM stg_macro)),
paired AS (SELECT asset, series_id AS macro_indicator, day, place, x, value AS y
           FROM own JOIN stg_macro ON observation_date = day JOIN places USING (day))""" + _COMPLETE
_ASSETS = ("^A", "^N", "^R", "bitcoin", "ethereum", "tether")


@register("rolling_corr_snapshot", O.cte("snapshot") + """
, places AS (SELECT *, row_number() OVER (ORDER BY snapshot_date) AS place FROM snapshot),
paired AS (SELECT a.k AS asset, m.k AS macro_indicator, snapshot_date AS day, place, a.v AS x, m.v AS y FROM (
  SELECT snapshot_date, place, unnest([{'k': 'SP500', 'v': sp500_return}, {'k': 'BTC', 'v': btc_return}]) AS a,
         [{'k': 'VIX', 'v': vix}, {'k': 'TREASURY_10Y', 'v': treasury_10y}, {'k': 'TREASURY_2Y', 'v': treasury_2y},
          {'k': 'FED_FUNDS_RATE', 'v': fed_funds_rate}, {'k': 'WTI_CRUDE_OIL', 'v': wti_crude_oil}] AS ms
  FROM places), unnest(ms) AS t(m))""" + _COMPLETE + "SELECT * RENAME (day AS snapshot_date) FROM (" + _rolling_sql() + ")",
          dbl=_ROLLED)
def q_rolling_corr_snapshot(spark, d):
    """30/60/90-day correlation matrices of the snapshot, every asset with every indicator, as rows."""
    return X.rolling_corr_snapshot(_m(spark, d).stored("daily_market_snapshot"), M.CORR_ASSETS, M.CORR_MACROS)


@register("rolling_corr_assets", O.cte("asset_returns", "stg_macro") + _PAIRED + _rolling_sql(), dbl=_ROLLED)
def q_rolling_corr_assets(spark, d):
    """30/60/90-day correlations of six assets with all ten macro series from the long tables."""
    m = _m(spark, d)
    return X.rolling_corr_assets(m.stored("asset_daily_returns"), m.stored("stg_macro"), _ASSETS)


@register("corr_assets", O.cte("asset_returns", "stg_macro") + _PAIRED + "SELECT asset, macro_indicator, "
          + _pair_corr_sql("", "") + " FROM complete GROUP BY ALL", dbl=("corr",))
def q_corr_assets(spark, d):
    """The whole-history matrix of six assets and ten macro series, rows of one aggregate."""
    m = _m(spark, d)
    return X.corr_assets(m.ref("asset_daily_returns"), m.ref("stg_macro"), _ASSETS).withColumnRenamed("correlation", "corr")


@register("corr_all_assets", O.cte("asset_returns") + """
, kept AS (SELECT asset_id, asset_date, daily_return FROM asset_returns)
SELECT a.asset_id AS asset, b.asset_id AS other, corr(a.daily_return, b.daily_return) AS corr,
       count(a.daily_return * b.daily_return) AS n_obs
FROM kept a JOIN kept b ON a.asset_date = b.asset_date AND a.asset_id < b.asset_id
GROUP BY ALL HAVING count(a.daily_return * b.daily_return) >= 30""", dbl=("corr",))
def q_corr_all_assets(spark, d):
    """Return correlations of every two assets with at least 30 common days, any number of series."""
    m = _m(spark, d).narrow("stg_daily_prices", *_CLOSES)
    returns = m.stored_columns("asset_daily_returns", "asset_id", "asset_date", "daily_return")
    return X.corr_all_assets(returns).withColumnRenamed("correlation", "corr")


_FRAMED = tuple(c for c in TECH_COARSE if c.startswith(("ma_", "bb_")))
_EXACT_SUMS = dict(dbl=("daily_return",), coarse=tuple(c for c in TECH_COARSE if c not in _FRAMED), cents=("rsi_14", *_FRAMED),
                   ints=("volume",))


def _shifted(df: DataFrame) -> DataFrame:
    return df.select(*M.TECHNICAL_COLUMNS).withColumns({c: F.col(c) + F.lit(0.00137) for c in _FRAMED})


@register("technicals_sliding", O.cte("technicals") + "SELECT * REPLACE (" + ", ".join(
    f"{c} + CAST(0.00137 AS DOUBLE) AS {c}" for c in _FRAMED) + ") FROM technicals", **_EXACT_SUMS)
def q_technicals_sliding(spark, d):
    """All indicators from exact running sums in halo buckets of each series. Sums of doubles differ
    from these by some 1e-9, so frames are compared to two decimals; means and bands are shifted by less
    than that, as means of prices in cents often lie on a half of the last digit."""
    from tidemark.operators.sliding import sliding_technicals
    return _shifted(sliding_technicals(_m(spark, d).stored("stg_daily_prices")))


def _runs_of_prices(stg: DataFrame) -> list[DataFrame]:
    """The prices, staged or loaded, as three runs would find them: each sees what was there by its day."""
    return [stg.filter(F.col("price_date") <= F.to_date(F.lit(day))) for day in ("1994-12-31", "1997-06-30", "2100-01-01")]


@register("incremental_technicals", REGISTRY["technicals_sliding"].sql, **_EXACT_SUMS)
def q_incremental_technicals(spark, d):
    """The technicals built by three runs, each from its new rows and the last 200 rows of every
    series, equal to a full rebuild (means and bands shifted as in ``technicals_sliding``)."""
    loads, root = M.price_loads(_m(spark, d).bronze["raw_stock_prices"]), scratch_path(spark, "technicals-runs")
    for prices in _runs_of_prices(loads):  # a run stages the loads of its own days, which its filters take from Bronze
        out = TS.append_technicals(prices, root, compute=M.technicals_of_loads, stored=True)
    return _shifted(out)


@register("incremental_snapshot", O.cte("snapshot") + "SELECT * FROM snapshot", dbl=SNAP_DBL, coarse=SNAP_COARSE,
          ints=("fng_value",))
def q_incremental_snapshot(spark, d):
    """The snapshot merged by three runs over technicals that are kept incrementally: each reads the
    technicals after its high-water mark only, no window sees the history."""
    m, root = _m(spark, d), scratch_path(spark, "snapshot-runs")
    stg, crypto = m.stored_columns("stg_daily_prices", "ticker", "price_date", "close_price"), m.stored("crypto_with_dominance")
    for prices in _runs_of_prices(stg):
        technicals = TS.append_technicals(prices, f"{root}-technicals", stored=True,
                                          compute=partial(W.with_technicals, ma_method="arrow"))
        out = INC.merge_into(spark, root, lambda after, t=technicals: M.daily_market_snapshot(
            t, m.seeds["tickers"], crypto, m.ref("stg_fear_greed"), m.ref("macro_pivot"), None, m.index_tickers,
            m.btc_id, after=after), "snapshot_date")
    return out


@register("dq_freshness", O.cte("crypto_ticks") + """
, t AS (
  SELECT 'yahoo_finance' AS source, max(l_orderkey) * 1000 AS ms FROM lineitem
  UNION ALL SELECT 'yahoo_fundamentals', max(l_orderkey) * 1000 FROM lineitem
  UNION ALL SELECT 'fred', max(o_orderkey) * 1000 FROM orders
  UNION ALL SELECT 'coingecko', max(ts_ms) FROM crypto_ticks
  UNION ALL SELECT 'alternative_me', max(o_orderkey) * 1000 FROM orders),
h AS (SELECT source, CAST((epoch_ms(TIMESTAMP '2001-12-31 00:00:00') - ms) // 3600000 AS BIGINT) AS age_hours FROM t)
SELECT source, age_hours, ['pass', 'warn', 'error'][1 + CAST(age_hours > 24 AS INT) + CAST(age_hours > 48 AS INT)] AS status
FROM h""")
def q_dq_freshness(spark, d):
    """K7: age in hours of all five Bronze sources' newest load at 2001-12-31
    00:00 (warn > 24 h, error > 48 h)."""
    return J.freshness_report(_m(spark, d).bronze, as_of=F.lit("2001-12-31 00:00:00").cast("timestamp_ntz")) \
        .select("source", "age_hours", "status")


# ------------------------------------------------- JSON rows and the sector matrix

@register("json_rows", O.cte("regime") + """
SELECT 'fed_funds_rate' AS indicator, rate_regime, vol_regime, num_days, avg_sp500_return, avg_btc_return,
       'indicator,rate_regime,vol_regime,num_days,avg_sp500_return,avg_btc_return' AS keys
FROM regime""", dbl=("avg_sp500_return", "avg_btc_return"))
def q_json_rows(spark, d):
    """Regime report rows serialised as JSON text (decimals -> double, dates
    -> ISO), read back by key: engines print numbers differently, so the parsed
    values and the key order are compared."""
    rows = RP.json_rows(RP.regime_report(_m(spark, d).ref("regime_analysis")))
    typed = F.from_json("json", "indicator string, rate_regime string, vol_regime string, num_days bigint, "
                                "avg_sp500_return double, avg_btc_return double")
    return rows.select(typed.alias("r"), F.array_join(F.json_object_keys("json"), ",").alias("keys")).select("r.*", "keys")


@register("sector_matrix", O.cte("sector_perf") + """
SELECT gics_sector, price_date, 100 * avg_daily_return AS return_pct FROM sector_perf""", dbl=("return_pct",))
def q_sector_matrix(spark, d):
    """The whole sector x date matrix (percent) as rows; ``reports.sector_matrix``
    lays a caller's days out as columns."""
    return RP.sector_days(_m(spark, d).ref("sector_performance"))


@register("align_series", O.cte("crypto_ticks") + """
, lk AS (SELECT coin_id, ts_ms, arg_max(mcap, seq) AS market_cap, arg_max(tvol, seq) AS total_volume
         FROM crypto_ticks GROUP BY coin_id, ts_ms)
SELECT p.coin_id, p.date, p.ts_ms, p.price_usd, lk.market_cap, lk.total_volume
FROM (SELECT coin_id, DATE '1970-01-01' + CAST(floor(ts_ms / 86400000) AS INTEGER) AS date, ts_ms, price_usd,
             row_number() OVER (PARTITION BY coin_id, floor(ts_ms / 86400000) ORDER BY ts_ms DESC, seq ASC) AS rn
      FROM crypto_ticks) p
LEFT JOIN lk ON p.coin_id = lk.coin_id AND p.ts_ms = lk.ts_ms
WHERE p.rn = 1""", dbl=("price_usd", "market_cap", "total_volume"))
def q_align_series(spark, d):
    """The [timestamp, value] pair arrays of chart payloads exploded; daily
    price points with market cap and volume looked up at the chosen timestamp
    from their own series (last entry wins on a duplicated timestamp; a missing
    timestamp gives NULL)."""
    charts = S.market_charts(spark, d)
    prices, caps, vols = (V.explode_pairs(charts, "coin_id", n, v, "seq") for n, v in (
        ("prices", "price_usd"), ("market_caps", "market_cap"), ("total_volumes", "total_volume")))
    out = V.align_series(prices, "coin_id", "ts_ms", "price_usd", [caps, vols], ["market_cap", "total_volume"])
    return out.select("coin_id", "date", "ts_ms", "price_usd", "market_cap", "total_volume")


@register("flatten_observations", O.cte("macro_typed") + """
SELECT series_id, strftime(observation_date, '%Y-%m-%d') AS date, CASE WHEN o_orderstatus <> 'P' THEN value END AS value,
       load_seq AS seq, '2001-12-31' AS run_date
FROM macro_typed JOIN orders ON o_orderkey = load_seq""", dbl=("value",))
def q_flatten_observations(spark, d):
    """Nested vendor observations flattened to one row per series and
    date, the missing sentinel as NULL, stamped with the run date."""
    payloads = S.macro_payloads(spark, d).withColumn("series_id", F.concat_ws("|", "series_id", "o_orderkey"))
    rows = V.stamp(V.flatten_observations(payloads), "2001-12-31", "run_date")
    return rows.select(F.substring_index("series_id", "|", 1).alias("series_id"), "date", "value",
                       F.substring_index("series_id", "|", -1).cast("bigint").alias("seq"), "run_date")


@register("inflation_regime", O.cte("stg_macro") + """
, cpi AS (SELECT observation_date, value AS cpi, row_number() OVER (ORDER BY observation_date) AS place
          FROM stg_macro WHERE series_id = 'CPIAUCSL' AND value IS NOT NULL)
SELECT a.observation_date, a.cpi, b.cpi AS cpi_prev,
       CASE sign(a.cpi - b.cpi) WHEN 1 THEN 'Rising' WHEN -1 THEN 'Falling' ELSE 'Stable' END AS inflation_regime
FROM cpi a LEFT JOIN cpi b ON b.place = a.place - 1""", dbl=("cpi", "cpi_prev"))
def q_inflation_regime(spark, d):
    """CPI against its previous observation."""
    return X.inflation_regime(_m(spark, d).stored("macro_pivot"))


@register("seed_scan", O.cte("tickers") + "SELECT ticker, company_name, sector FROM tickers")
def q_seed_scan(spark, d):
    """The constituent seed written as CSV with a header and quotes, read back
    with its fixed schema."""
    path = scratch_path(spark, "seed-tickers")
    S.tickers_seed(spark, d).write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    from tidemark.sources.seeds import read_seed
    return read_seed(spark, path, "tickers")
