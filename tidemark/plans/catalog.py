"""Layers as catalog databases: tables that other tools find by name, bucketed by their series.

A table bucketed by ticker is read already dealt by ticker, so the windows over series and the joins
of prices with the ticker dimension need no exchange.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.jobs import LAYERS, layer_path
from tidemark.storage import listing, remove

#: Tables that are bucketed, by which column, and in which order inside a bucket.
BUCKETED = {"stg_daily_prices": ("ticker", ["ticker", "price_date"]), "prices_with_technicals": ("ticker", ["ticker", "price_date"]),
            "dim_tickers": ("ticker", ["ticker"]), "stg_fundamentals": ("ticker", ["ticker", "snapshot_date"])}


def layer_of(table: str) -> str:
    return next(layer for layer, tables in LAYERS.items() if table in tables)


def create_layers(spark: SparkSession, warehouse: str, layers: Sequence[str] = tuple(LAYERS)) -> None:
    """A database per layer, in ``<warehouse>/<LAYER>``; one that is there is left as it is."""
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{warehouse.rstrip('/')}/{layer.upper()}'")


def save_table(df: DataFrame, warehouse: str, table: str, buckets: int, layer: str | None = None) -> DataFrame:
    """Write ``df`` as ``<layer>.<table>`` and read it by name.

    Tables of ``BUCKETED`` get ``buckets`` files, one a bucket (one number for all, so that their
    buckets match); choose it so that a bucket is a few hundred MB. Each write goes to a folder of its
    own and the name is pointed to it when it is complete, so readers of the old state are not
    disturbed; ``drop_unread`` removes what no name points to.
    """
    spark, layer = df.sparkSession, layer or layer_of(table)
    create_layers(spark, warehouse, [layer])
    name, path = f"{layer}.{table}", f"{layer_path(warehouse, layer, table)}/v{time.time_ns()}"
    held = f"{layer}.{table}__new"
    spark.sql(f"DROP TABLE IF EXISTS {held}")
    if table in BUCKETED:
        key, order = BUCKETED[table]
        df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(*order).option("path", path).saveAsTable(held)
    else:
        df.write.option("path", path).saveAsTable(held)
    # Both are external tables: dropping a name leaves its folder.
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {held} RENAME TO {name}")
    return spark.table(name)


def drop_unread(spark: SparkSession, warehouse: str, table: str, min_age_hours: float = 24, layer: str | None = None) -> list[str]:
    """Remove the folders of a table that its name does not point to and that were last written
    ``min_age_hours`` ago or earlier, so that a query still reading one is left alone."""
    layer = layer or layer_of(table)
    current = next(r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {layer}.{table}").collect() if r["col_name"] == "Location")
    before, gone = (time.time() - 3600 * min_age_hours) * 1000, []
    for name, path, folder, _, modified in listing(spark, layer_path(warehouse, layer, table)) or []:
        if folder and name.startswith("v") and not current.rstrip("/").endswith(f"/{name}") and modified <= before:
            remove(spark, path)
            gone.append(name)
    return gone


def save_layers(tables: Mapping[str, DataFrame], warehouse: str, buckets: int) -> dict[str, DataFrame]:
    """All given tables by name, each in its layer."""
    return {name: save_table(df, warehouse, name, buckets) for name, df in tables.items()}
