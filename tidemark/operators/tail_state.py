"""Incremental technicals: each run reads its new rows and the last rows of every series, no history.

Beside the rows written so far, a run leaves the last ``keep`` rows of each series. The next one
joins these in front of its new rows, so every trailing frame is whole. A run writes its rows
first and its tails last; readers take the runs up to the newest complete tails, so a run that
breaks off is as if it never was, and the next one writes over it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.sliding import sliding_technicals
from tidemark.operators.windows import top_k_per_group
from tidemark.session import scratch_path
from tidemark.storage import complete, listing, remove

#: Longest frame of the technicals (a moving average of 200 rows), and so the rows kept of a series.
KEEP = 200


def _runs(spark: SparkSession, root: str) -> list[int]:
    """Runs whose tails are there and complete."""
    names = [n for n, _, folder, *_ in listing(spark, f"{root}/tails") or [] if folder and n.startswith("run=")]
    return sorted(int(n[4:]) for n in names if complete(spark, f"{root}/tails/{n}"))


def read_rows(spark: SparkSession, root: str) -> DataFrame | None:
    """All rows of the complete runs; None before the first."""
    runs = _runs(spark, root)
    return spark.read.parquet(*[f"{root}/rows/run={k}" for k in range(runs[-1] + 1)]) if runs else None


def new_rows(prices: DataFrame, tails: DataFrame | None, order: str) -> DataFrame:
    """Rows later than every one processed; a late row for an earlier day is not picked up.

    The mark is one value, so that the filter reaches the scan of ``prices``."""
    mark = None if tails is None else tails.agg(F.max(order)).first()[0]
    return prices if mark is None else prices.filter(F.col(order) > F.lit(mark))


def append_technicals(prices: DataFrame, root: str, value: str = "close_price", by: str = "ticker", order: str = "price_date",
                      keep: int = KEEP, compute: Callable[..., DataFrame] = sliding_technicals,
                      stored: bool = False) -> DataFrame:
    """Technicals of the rows of ``prices`` that are newer than the last run's; returns all rows so far.

    ``compute`` takes (rows, value, by, order) and needs no more than ``keep`` rows before a row; it may
    drop rows, as earlier loads of a key. Its input is stored first, for it may read it twice, unless
    ``stored`` says that ``prices`` is a stored table or that it is read once. The tails come from the
    rows written. Runs without new rows write empty ones. Equal to ``compute`` over all rows at once,
    for rows that come in the order of their days.
    """
    spark = prices.sparkSession
    runs = _runs(spark, root)
    k = runs[-1] + 1 if runs else 0
    tails = spark.read.parquet(f"{root}/tails/run={k - 1}") if runs else None
    rows = new_rows(prices, tails, order).withColumn("_new", F.lit(True))
    if tails is not None:
        rows = rows.unionByName(tails.withColumn("_new", F.lit(False)), allowMissingColumns=True)
    held = None if stored else scratch_path(spark, "technicals-input")
    if held:
        rows.write.parquet(held)
        rows = spark.read.schema(rows.schema).parquet(held)
    out, path = compute(rows, value, by, order).filter("_new").drop("_new"), f"{root}/rows/run={k}"
    out.write.mode("overwrite").option("compression", "zstd").parquet(path)
    ends = spark.read.schema(out.schema).parquet(path).select(by, order, value)
    if tails is not None:
        ends = ends.unionByName(tails)
    top_k_per_group(ends, by, [F.col(order).desc_nulls_last()], keep, "_rank").drop("_rank") \
        .write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/tails/run={k}")
    if held:
        remove(spark, held)
    for old in runs[:-1]:  # the newest before this one stays for who may be reading it
        remove(spark, f"{root}/tails/run={old}")
    return read_rows(spark, root)
