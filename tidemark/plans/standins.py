"""Shape adapters: driver test tables -> the market-data inputs the jobs expect.

These functions rename and re-type columns of the given tables into the
record shapes of the five landing sources and the two seeds. They do none
of the jobs' work (no dedup, windows or aggregation; the seeds only look up
nation / region names, and the sentiment label is the library's band of the
reading, as the vendor's own label would be), and every job runs on their
output exactly as it would on real landings.

    stock prices      lineitem: one price record per line item, keyed by
                      supplier ticker 'S<suppkey>', plus index tickers
                      '^<returnflag>' from the same lines
    fundamentals      lineitem: one fundamentals record per line item
    macro series      orders: five priorities, by odd and even keys, stand for ten series ids
    crypto ticks      orders: intraday ticks, one coin per order status
    fear & greed      orders: a 0-100 reading per order
    constituent seed  supplier + nation names
    sector seed       nation -> region names
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalar import safe_divide, score_band


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _iso(c: Column) -> Column:
    return F.to_date(c).cast("string")


# Stand-in naming: index tickers and which lineitem flag each one tracks.
INDEX_STANDIN = {"sp500": "^A", "nasdaq": "^N", "dow": "^R"}
# Stand-in naming: order priority and the key's remainder modulo 2 -> macro series id.
MACRO_STANDIN = {"1-URGENT/0": "DFF", "2-HIGH/0": "DGS10", "3-MEDIUM/0": "DGS2", "4-NOT SPECIFIED/0": "VIXCLS",
                 "5-LOW/0": "DCOILWTICO", "1-URGENT/1": "DEXUSEU", "2-HIGH/1": "CPIAUCSL", "3-MEDIUM/1": "UNRATE",
                 "4-NOT SPECIFIED/1": "M2SL", "5-LOW/1": "GDPC1"}
# Stand-in naming: order status -> (coin id, symbol, name).
COIN_STANDIN = {"F": ("bitcoin", "btc", "Bitcoin"), "O": ("ethereum", "eth", "Ethereum"),
                "P": ("tether", "usdt", "Tether")}


def _case(col: str | Column, mapping: dict[str, str]) -> Column:
    expr, key = None, F.col(col) if isinstance(col, str) else col
    for k, v in mapping.items():
        expr = (F.when(key == k, v) if expr is None else expr.when(key == k, v))
    return expr


def _series_id() -> Column:
    return _case(F.concat_ws("/", "o_orderpriority", (F.col("o_orderkey") % 2).cast("string")), MACRO_STANDIN)


def price_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing-shaped stock price records (+ ``load_seq`` and file name)."""
    li = table(spark, sf_dir, "lineitem")
    unit = safe_divide(F.col("l_extendedprice"), F.col("l_quantity"))

    def shape(ticker: Column) -> DataFrame:
        return li.select(
            ticker.alias("ticker"), _iso(F.col("l_shipdate")).alias("date"),
            (unit * (F.lit(1) - F.col("l_discount"))).alias("open"),
            (unit * (F.lit(1) + F.col("l_tax"))).alias("high"),
            (unit * (F.lit(1) - F.col("l_discount")) * (F.lit(1) - F.col("l_tax"))).alias("low"),
            unit.alias("close"),
            (unit * (F.lit(1) - F.col("l_tax"))).alias("adj_close"),
            F.col("l_quantity").alias("volume"),
            F.lit("yahoo_finance").alias("source"),
            F.col("l_orderkey").alias("load_seq"))

    out = shape(F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))).unionByName(
        shape(F.concat(F.lit("^"), F.col("l_returnflag"))))
    return out.withColumn("file_name", F.concat(F.lit("stock-prices/"), F.col("date"), F.lit(".json")))


def fundamental_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("ticker"),
        _iso(F.col("l_shipdate")).alias("date"),
        (F.col("l_extendedprice") * F.lit(1e9)).alias("market_cap"),
        safe_divide(F.col("l_extendedprice"), F.col("l_quantity") * F.lit(100)).alias("pe_ratio"),
        F.concat(F.lit("Sector "), F.col("l_linestatus")).alias("sector"),
        F.concat(F.lit("Industry "), F.col("l_returnflag"), F.col("l_linestatus")).alias("industry"),
        F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string")).alias("short_name"),
        F.lit("yahoo_finance").alias("source"),
        F.col("l_orderkey").alias("load_seq"),
        F.concat(F.lit("stock-fundamentals/"), _iso(F.col("l_shipdate")), F.lit(".json"))
         .alias("file_name"))


def macro_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        _series_id().alias("series_id"),
        F.col("o_orderpriority").alias("series_name"),
        _iso(F.col("o_orderdate")).alias("date"),
        (F.col("o_totalprice") / F.lit(10000.0)).alias("value"),
        F.lit(None).cast("string").alias("realtime_start"),
        F.lit(None).cast("string").alias("realtime_end"),
        F.lit("fred").alias("source"),
        F.col("o_orderkey").alias("load_seq"),
        F.concat(F.lit("fred-series/"), _iso(F.col("o_orderdate")), F.lit(".json")).alias("file_name"))


def crypto_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intraday ticks: (coin, epoch-ms timestamp, price, cap, volume, arrival seq)."""
    o = table(spark, sf_dir, "orders")
    day_ms = F.unix_date(F.to_date(F.col("o_orderdate"))).cast("bigint") * F.lit(86_400_000)
    return o.select(
        _case("o_orderstatus", {k: v[0] for k, v in COIN_STANDIN.items()}).alias("coin_id"),
        _case("o_orderstatus", {k: v[1] for k, v in COIN_STANDIN.items()}).alias("symbol"),
        _case("o_orderstatus", {k: v[2] for k, v in COIN_STANDIN.items()}).alias("name"),
        (day_ms + F.col("o_orderkey") % F.lit(86_400_000)).alias("ts_ms"),
        (F.col("o_totalprice") / F.lit(100.0)).alias("price"),
        (F.col("o_totalprice") * F.lit(1000.0)).alias("market_cap"),
        (F.col("o_totalprice") * F.lit(10.0)).alias("total_volume"),
        (F.col("o_totalprice") * F.lit(3.0)).alias("circulating_supply"),
        (F.col("o_custkey") % F.lit(20) + F.lit(1)).alias("market_cap_rank"),
        F.col("o_orderkey").alias("seq"))


def fear_greed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    value = F.floor(F.col("o_totalprice") / F.lit(5000.0)).cast("int")
    return o.select(
        _iso(F.col("o_orderdate")).alias("date"), value.alias("value"),
        score_band(value).alias("classification"), F.lit("alternative_me").alias("source"),
        F.col("o_orderkey").alias("load_seq"),
        F.concat(F.lit("fear-greed/"), _iso(F.col("o_orderdate")), F.lit(".json")).alias("file_name"))


def tickers_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"),
        F.col("s_name").alias("company_name"), F.col("n_name").alias("sector"))


def sectors_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_name").alias("yahoo_sector"), F.col("r_name").alias("gics_sector"),
        F.concat(F.lit("Nations of "), F.col("r_name")).alias("description"))


def macro_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw vendor payloads: one per order, its observation as text ('.' where the status is P)."""
    o = table(spark, sf_dir, "orders")
    value = F.when(F.col("o_orderstatus") == "P", ".").otherwise((F.col("o_totalprice") / F.lit(10000.0)).cast("string"))
    observation = F.struct(_iso(F.col("o_orderdate")).alias("date"), value.alias("value"),
                           F.lit(None).cast("string").alias("realtime_start"),
                           F.lit(None).cast("string").alias("realtime_end"))
    return o.select(_series_id().alias("series_id"), F.struct(F.array(observation).alias("observations")).alias("payload"),
                    "o_orderkey")


def market_charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw chart payloads: one per order, parallel arrays of [timestamp, value] pairs."""
    t = crypto_ticks(spark, sf_dir)
    ts = F.col("ts_ms").cast("double")
    return t.select("coin_id", "seq", *[F.array(F.array(ts, F.col(c).cast("double"))).alias(n) for n, c in (
        ("prices", "price"), ("market_caps", "market_cap"), ("total_volumes", "total_volume"))])
