"""DuckDB oracle SQL for the registered queries.

Computed by other means than the Spark plans, from the semantics rules (SURVEY R1-R13):
the latest load is the maximum of a struct, a previous row is a join on row numbers,
breadth is a sum of signs, a correlation comes from sums of products, and the date
grain is one conditional aggregate. ``cte(*names)`` assembles a WITH clause holding the
named CTEs and everything they depend on.
"""

from __future__ import annotations

_UNIT = "l_extendedprice / NULLIF(l_quantity, 0)"

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _def(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body.strip())


def _latest(src: str, keys: str, fields: list[str]) -> str:
    """The greatest struct (load_seq, then the fields; NULL is greatest) of each key, unpacked."""
    packed = ", ".join(f"{f} := {f}" for f in ("load_seq", *fields))
    return (f"SELECT {keys}, {', '.join(f'newest.{f} AS {f}' for f in fields)} "
            f"FROM (SELECT {keys}, max(struct_pack({packed})) AS newest FROM {src} GROUP BY {keys})")


_def("price_src", (), f"""
SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS price_date,
       l_orderkey AS load_seq, {_UNIT} AS unit, l_discount, l_tax, l_quantity FROM lineitem
UNION ALL
SELECT '^' || l_returnflag, CAST(l_shipdate AS DATE), l_orderkey, {_UNIT}, l_discount, l_tax,
       l_quantity FROM lineitem""")
_def("price_typed", ("price_src",), """
SELECT ticker, price_date, load_seq, unit * (1 - l_discount) AS open_price,
       unit * (1 + l_tax) AS high_price, unit * (1 - l_discount) * (1 - l_tax) AS low_price,
       unit AS close_price, unit * (1 - l_tax) AS adj_close_price,
       CAST(l_quantity AS DECIMAL(38,0)) AS volume
FROM price_src""")
_def("stg_prices", ("price_typed",), _latest(
    "price_typed", "ticker, price_date",
    ["open_price", "high_price", "low_price", "close_price", "adj_close_price", "volume"]))
_def("numbered", ("stg_prices",), """
SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY price_date) AS place FROM stg_prices""")
_def("tech_base", ("numbered",), """
SELECT a.*, b.close_price AS prev_close, a.close_price - b.close_price AS daily_change
FROM numbered a LEFT JOIN numbered b ON b.ticker = a.ticker AND b.place + 1 = a.place""")
_def("technicals", ("tech_base",), """
SELECT ticker, price_date, open_price, high_price, low_price, close_price, adj_close_price, volume,
       daily_change, daily_change / NULLIF(prev_close, 0) AS daily_return, ma_20, ma_50, ma_200,
       CASE WHEN fall > 0 THEN 100 * rise / (rise + fall) END AS rsi_14,
       ma_20 AS bb_middle, ma_20 + 2 * sd AS bb_upper, ma_20 - 2 * sd AS bb_lower
FROM (SELECT *, avg(close_price) OVER (series ROWS 19 PRECEDING) AS ma_20,
             avg(close_price) OVER (series ROWS 49 PRECEDING) AS ma_50,
             avg(close_price) OVER (series ROWS 199 PRECEDING) AS ma_200,
             stddev_samp(close_price) OVER (series ROWS 19 PRECEDING) AS sd,
             sum(greatest(coalesce(daily_change, 0), 0)) OVER (series ROWS 13 PRECEDING) AS rise,
             sum(greatest(coalesce(-daily_change, 0), 0)) OVER (series ROWS 13 PRECEDING) AS fall
      FROM tech_base WINDOW series AS (PARTITION BY ticker ORDER BY place))""")

_def("fund_typed", (), """
SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS snapshot_date,
       l_orderkey AS load_seq, CAST(l_extendedprice * CAST(1e9 AS DOUBLE) AS DECIMAL(38,0)) AS market_cap,
       l_extendedprice / NULLIF(l_quantity * 100, 0) AS pe_ratio, 'Sector ' || l_linestatus AS sector,
       'Industry ' || l_returnflag || l_linestatus AS industry,
       'Supplier ' || CAST(l_suppkey AS VARCHAR) AS company_name
FROM lineitem""")
_def("stg_fund", ("fund_typed",), _latest(
    "fund_typed", "ticker, snapshot_date", ["market_cap", "pe_ratio", "sector", "industry", "company_name"]))

_def("macro_typed", (), """
SELECT [['DFF', 'DGS10', 'DGS2', 'VIXCLS', 'DCOILWTICO'], ['DEXUSEU', 'CPIAUCSL', 'UNRATE', 'M2SL', 'GDPC1']]
         [1 + o_orderkey % 2][CAST(o_orderpriority[1] AS INTEGER)] AS series_id,
       o_orderpriority AS series_name, CAST(o_orderdate AS DATE) AS observation_date,
       o_totalprice / CAST(10000 AS DOUBLE) AS value, o_orderkey AS load_seq
FROM orders""")
_def("stg_macro", ("macro_typed",), _latest(
    "macro_typed", "series_id, observation_date", ["series_name", "value"]))
#: Series (fixed ids) and their columns.
_SERIES = {"DFF": "fed_funds_rate", "DGS10": "treasury_10y", "DGS2": "treasury_2y", "VIXCLS": "vix",
           "DCOILWTICO": "wti_crude_oil", "DEXUSEU": "usd_eur_rate", "CPIAUCSL": "cpi",
           "UNRATE": "unemployment_rate", "M2SL": "m2_money_supply", "GDPC1": "real_gdp"}
_def("macro_map", ("stg_macro",), """
SELECT observation_date, map_from_entries(list((series_id, value)) FILTER (WHERE series_id IS NOT NULL)) AS of
FROM stg_macro GROUP BY observation_date""")
_def("macro_wide", ("macro_map",), "SELECT observation_date, " + ", ".join(
    f"CAST(of['{i}'] AS DOUBLE) AS {c}" for i, c in _SERIES.items()) + " FROM macro_map")
_def("yield_curve", ("stg_macro",), """
SELECT observation_date, a.value AS treasury_10y, b.value AS treasury_2y, a.value - b.value AS spread_10y_2y,
       b.value > a.value AS is_inverted
FROM (SELECT * FROM stg_macro WHERE series_id = 'DGS10') a
JOIN (SELECT * FROM stg_macro WHERE series_id = 'DGS2') b USING (observation_date)
WHERE a.value - b.value IS NOT NULL""")

_def("crypto_ticks", (), """
SELECT CASE o_orderstatus WHEN 'F' THEN 'bitcoin' WHEN 'O' THEN 'ethereum' WHEN 'P' THEN 'tether' END AS coin_id,
       CASE o_orderstatus WHEN 'F' THEN 'btc' WHEN 'O' THEN 'eth' WHEN 'P' THEN 'usdt' END AS symbol,
       CASE o_orderstatus WHEN 'F' THEN 'Bitcoin' WHEN 'O' THEN 'Ethereum' WHEN 'P' THEN 'Tether' END AS coin_name,
       CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 86400000
         + o_orderkey % 86400000 AS ts_ms,
       o_totalprice / CAST(100 AS DOUBLE) AS price_usd, o_totalprice * CAST(1000 AS DOUBLE) AS mcap,
       o_totalprice * CAST(10 AS DOUBLE) AS tvol, o_totalprice * CAST(3 AS DOUBLE) AS supply,
       o_custkey % 20 + 1 AS cap_rank, o_orderkey AS seq
FROM orders""")
_def("stg_crypto", ("crypto_ticks",), """
SELECT coin_id, p.symbol, p.coin_name, price_date, p.price_usd, CAST(p.mcap AS DECIMAL(38,0)) AS market_cap,
       CAST(p.tvol AS DECIMAL(38,0)) AS total_volume, p.supply AS circulating_supply,
       CAST(p.cap_rank AS DECIMAL(38,0)) AS market_cap_rank, p.ts_ms
FROM (SELECT coin_id, DATE '1970-01-01' + CAST(ts_ms // 86400000 AS INTEGER) AS price_date,
             arg_max(t, (ts_ms, -seq)) AS p
      FROM crypto_ticks t GROUP BY ALL)""")
_def("crypto_dom", ("stg_crypto",), """
SELECT c.* EXCLUDE (ts_ms), CAST(100 * market_cap AS DOUBLE) / NULLIF(CAST(total AS DOUBLE), 0) AS dominance_pct
FROM stg_crypto c
JOIN (SELECT price_date, sum(market_cap) AS total FROM stg_crypto GROUP BY price_date) USING (price_date)""")
_def("crypto_returns", ("crypto_dom",), """
SELECT now.* EXCLUDE (place), (now.price_usd - past.price_usd) / NULLIF(past.price_usd, 0) AS daily_return
FROM (SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY price_date) AS place FROM crypto_dom) now
LEFT JOIN (SELECT coin_id, price_usd, 1 + row_number() OVER (PARTITION BY coin_id ORDER BY price_date) AS place
           FROM crypto_dom) past USING (coin_id, place)""")

_def("fng_typed", (), """
SELECT CAST(o_orderdate AS DATE) AS reading_date,
       CAST(floor(o_totalprice / CAST(5000 AS DOUBLE)) AS INTEGER) AS v, o_orderkey AS load_seq
FROM orders""")
_def("fng_labelled", ("fng_typed",), """
SELECT reading_date, load_seq, CAST(v AS DECIMAL(38,0)) AS fng_value,
       ['Extreme Fear', 'Fear', 'Neutral', 'Greed', 'Extreme Greed']
         [1 + len(list_filter([25, 45, 55, 75], lambda edge: v >= edge))] AS classification
FROM fng_typed""")
_def("stg_fng", ("fng_labelled",), _latest("fng_labelled", "reading_date", ["fng_value", "classification"]))

_def("tickers", (), """
SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS ticker, s_name AS company_name, n_name AS sector
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")
_def("sectors", (), """
SELECT n_name AS yahoo_sector, r_name AS gics_sector, 'Nations of ' || r_name AS description
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""")

_def("series", (), "SELECT unnest([" + ", ".join(f"'{i}'" for i in _SERIES) + "]) AS series_id")
_def("asset_returns", ("technicals", "crypto_returns"), """
SELECT 'crypto' AS asset_type, coin_id AS asset_id, symbol AS asset_name, price_date AS asset_date,
       price_usd AS close, daily_return FROM crypto_returns
UNION ALL BY NAME
SELECT 'stock' AS asset_type, ticker AS asset_id, ticker AS asset_name, price_date AS asset_date,
       daily_return, close_price AS close FROM technicals""")
_def("dim_tickers", ("tickers", "stg_fund"), """
SELECT t.ticker, t.company_name, t.sector AS yahoo_sector, r_name AS gics_sector, f.newest.industry AS industry,
       f.newest.market_cap AS market_cap, f.newest.pe_ratio AS pe_ratio
FROM tickers t
LEFT JOIN nation ON n_name = t.sector
LEFT JOIN region ON r_regionkey = n_regionkey
LEFT JOIN (SELECT ticker, arg_max(s, snapshot_date) AS newest FROM stg_fund s GROUP BY ticker) f USING (ticker)""")
_def("day_grain", ("technicals", "tickers"), """
SELECT price_date, any_value(close_price) FILTER (WHERE ticker = '^A') AS sp500_close,
       any_value(daily_return) FILTER (WHERE ticker = '^A') AS sp500_return,
       any_value(close_price) FILTER (WHERE ticker = '^N') AS nasdaq_close,
       any_value(close_price) FILTER (WHERE ticker = '^R') AS dow_close,
       CAST(sum(members * greatest(coalesce(sign(daily_return), 0), 0)) AS BIGINT) AS advancers,
       CAST(sum(members * greatest(coalesce(-sign(daily_return), 0), 0)) AS BIGINT) AS decliners
FROM technicals LEFT JOIN (SELECT ticker, count(*) AS members FROM tickers GROUP BY ticker) USING (ticker)
GROUP BY price_date""")
_def("snapshot", ("day_grain", "crypto_returns", "stg_fng", "macro_wide"), """
SELECT g.price_date AS snapshot_date, sp500_close, sp500_return, nasdaq_close, dow_close, advancers, decliners,
       c.price_usd AS btc_price, c.dominance_pct AS btc_dominance, c.daily_return AS btc_return, fng_value,
       classification AS fng_classification, fed_funds_rate, treasury_10y, treasury_2y,
       treasury_10y - treasury_2y AS spread_10y_2y, treasury_2y > treasury_10y AS is_inverted, vix, wti_crude_oil
FROM day_grain g
LEFT JOIN crypto_returns c ON (c.coin_id, c.price_date) = ('bitcoin', g.price_date)
LEFT JOIN stg_fng ON reading_date = g.price_date
LEFT JOIN macro_wide ON observation_date = g.price_date""")
_def("snapshot_places", ("snapshot",), """
SELECT snapshot_date, sp500_return, btc_return, vix, fed_funds_rate,
       (SELECT count(*) FROM snapshot b WHERE b.snapshot_date < a.snapshot_date) AS place FROM snapshot a""")
_def("regime_daily", ("snapshot_places",), """
SELECT now.* EXCLUDE (place), past.fed_funds_rate AS fed_funds_prev,
       coalesce(map {1: 'Hiking', -1: 'Cutting'}[sign(now.fed_funds_rate - past.fed_funds_rate)], 'Holding') AS rate_regime,
       if(coalesce(now.vix, 0) < 20, 'Low Vol', 'High Vol') AS vol_regime
FROM snapshot_places now LEFT JOIN snapshot_places past ON past.place = now.place - 5""")
_def("regime", ("regime_daily",), """
SELECT rate_regime, vol_regime, count(*) AS num_days, sum(sp500_return) / NULLIF(count(sp500_return), 0)
         AS avg_sp500_return, sum(btc_return) / NULLIF(count(btc_return), 0) AS avg_btc_return
FROM regime_daily GROUP BY ALL""")

#: Correlated pairs (fixed names), unpivoted to one row per day, asset and indicator.
_ASSETS = {"SP500": "sp500_return", "BTC": "btc_return"}
_MACROS = {"VIX": "vix", "TREASURY_10Y": "treasury_10y", "TREASURY_2Y": "treasury_2y",
           "FED_FUNDS_RATE": "fed_funds_rate", "WTI_CRUDE_OIL": "wti_crude_oil"}


def _long(columns: dict[str, str], name: str) -> str:
    rows = ", ".join(f"{{'{name}': '{k}', 'x': CAST({c} AS DOUBLE)}}" for k, c in columns.items())
    return f"SELECT snapshot_date, unnest([{rows}], recursive := true) FROM snapshot"


_def("correlation", ("snapshot",), f"""
SELECT asset, macro_indicator, n AS n_obs, CASE WHEN n >= 3 THEN (n * xy - sx * sy)
         / NULLIF(sqrt(greatest(n * xx - sx * sx, 0)) * sqrt(greatest(n * yy - sy * sy, 0)), 0) END AS correlation
FROM (SELECT asset, macro_indicator, count(x * y) AS n, sum(x * y) AS xy, sum(x) FILTER (WHERE y IS NOT NULL) AS sx,
             sum(y) FILTER (WHERE x IS NOT NULL) AS sy, sum(x * x) FILTER (WHERE y IS NOT NULL) AS xx,
             sum(y * y) FILTER (WHERE x IS NOT NULL) AS yy
      FROM (SELECT a.snapshot_date, asset, macro_indicator, a.x AS x, m.x AS y FROM ({_long(_ASSETS, 'asset')}) a
            JOIN ({_long(_MACROS, 'macro_indicator')}) m USING (snapshot_date)) GROUP BY ALL)""")
_def("sector_perf", ("technicals",), """
SELECT r_name AS gics_sector, price_date, count(DISTINCT ticker) AS num_constituents,
       sum(daily_return) / NULLIF(count(daily_return), 0) AS avg_daily_return,
       CAST(sum(CAST(close_price AS DECIMAL(38,10))) AS DOUBLE) AS total_close_price
FROM region JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey
JOIN technicals ON ticker = concat('S', s_suppkey)
GROUP BY ALL HAVING r_name IS NOT NULL""")
_def("asset_prices", ("technicals", "crypto_returns"), """
SELECT 'stock' AS asset_type, ticker AS asset_id, ticker AS asset_name, price_date, close_price AS close,
       daily_return, ma_20, ma_50, ma_200, rsi_14 FROM technicals
UNION ALL BY NAME
SELECT 'crypto' AS asset_type, coin_id AS asset_id, symbol AS asset_name, price_date, price_usd AS close,
       daily_return FROM crypto_returns""")


def cte(*names: str) -> str:
    """WITH clause containing ``names`` and their dependencies, in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in order) + "\n"
