"""Seed tables: small static CSVs (constituents, sector map, series metadata).

``read_seed`` reads a seed CSV with an explicit schema. The default seeds
below are the reference lookup tables; they are tiny and fixed, so they are
marked for broadcast when joined.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED_SCHEMAS = {
    "tickers": "ticker string, company_name string, sector string",
    "sectors": "yahoo_sector string, gics_sector string, description string",
    "series": "series_id string, series_name string, frequency string, unit string, category string",
}

# Reference seed tables (CSV with header, quoted commas).
TICKERS_CSV = """ticker,company_name,sector
AAPL,Apple Inc.,Technology
MSFT,Microsoft Corporation,Technology
NVDA,NVIDIA Corporation,Technology
AMZN,Amazon.com Inc.,Consumer Cyclical
GOOGL,Alphabet Inc.,Communication Services
META,Meta Platforms Inc.,Communication Services
TSLA,Tesla Inc.,Consumer Cyclical
JPM,JPMorgan Chase & Co.,Financial Services
XOM,Exxon Mobil Corporation,Energy
JNJ,Johnson & Johnson,Healthcare
"""
SECTORS_CSV = """yahoo_sector,gics_sector,description
Technology,Information Technology,"Software, hardware, semiconductors"
Financial Services,Financials,"Banks, insurers, capital markets"
Healthcare,Health Care,"Pharma, biotech, providers, devices"
Consumer Cyclical,Consumer Discretionary,"Retail, autos, leisure"
Consumer Defensive,Consumer Staples,"Food, beverage, household goods"
Communication Services,Communication Services,"Telecom, media, interactive"
Industrials,Industrials,"Capital goods, transport, services"
Energy,Energy,"Oil, gas, consumable fuels"
Basic Materials,Materials,"Chemicals, metals, mining"
Real Estate,Real Estate,"REITs, real estate management"
Utilities,Utilities,"Electric, gas, water utilities"
"""
SERIES_CSV = """series_id,series_name,frequency,unit,category
DFF,Federal Funds Effective Rate,Daily,Percent,Interest Rates
DGS10,10-Year Treasury Yield,Daily,Percent,Interest Rates
DGS2,2-Year Treasury Yield,Daily,Percent,Interest Rates
CPIAUCSL,Consumer Price Index,Monthly,Index 1982-1984=100,Inflation
GDPC1,Real Gross Domestic Product,Quarterly,Billions of Chained 2017 Dollars,Growth
UNRATE,Unemployment Rate,Monthly,Percent,Labor Market
M2SL,M2 Money Supply,Monthly,Billions of Dollars,Money Supply
VIXCLS,CBOE Volatility Index,Daily,Index,Volatility
DCOILWTICO,WTI Crude Oil Price,Daily,USD per Barrel,Commodities
DEXUSEU,USD/EUR Exchange Rate,Daily,USD per EUR,Foreign Exchange
"""
# Ingestion universe (stocks, indices, sector ETFs).
STOCK_TICKERS = ["AAPL", "MSFT", "NVDA", "AMZN", "GOOGL", "META", "TSLA", "JPM", "XOM", "JNJ"]
INDICES = ["^GSPC", "^DJI", "^IXIC"]
SECTOR_ETFS = ["XLF", "XLK", "XLE", "XLV", "XLY", "XLP", "XLI", "XLB", "XLRE", "XLU", "XLC"]

_DEFAULTS = {"tickers": TICKERS_CSV, "sectors": SECTORS_CSV, "series": SERIES_CSV}


def read_seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A seed CSV (header, quoted fields) with its fixed schema."""
    return spark.read.schema(SEED_SCHEMAS[name]).option("header", True).option("quote", '"') \
        .option("escape", '"').csv(path)


def seed_rows(name: str) -> list[list[str]]:
    """Rows of a built-in seed table."""
    return list(csv.reader(io.StringIO(_DEFAULTS[name])))[1:]


def default_seed(spark: SparkSession, name: str) -> DataFrame:
    """One of the built-in seed tables (a dozen rows; broadcast when joined)."""
    return F.broadcast(spark.createDataFrame(seed_rows(name), SEED_SCHEMAS[name]))


def universe(spark: SparkSession, include_indices: bool = True) -> DataFrame:
    """Symbols to ingest; fundamentals use ``include_indices=False``."""
    syms = STOCK_TICKERS + (INDICES if include_indices else []) + SECTOR_ETFS
    return F.broadcast(spark.createDataFrame([(s,) for s in syms], "ticker string"))
