"""tidemark: market and macro time-series analytics on Spark DataFrames."""

__version__ = "0.1.0"
