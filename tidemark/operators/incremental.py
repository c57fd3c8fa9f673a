"""Incremental builds: high-water-mark filters and key-based upserts.

A merged table is a folder of versions. Each merge writes only the buckets (months, for a
date key) that it touches into a new version folder; Spark's committer leaves ``_SUCCESS``
there last, and readers take, for each bucket, the newest complete version that holds it.
So a merge costs what it touches, and one that breaks off is as if it never ran.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.storage import complete, listing, remove


def high_water_mark(target: DataFrame, key: str) -> Column:
    """``max(key)`` of the target as a scalar-subquery Column (stays lazy)."""
    return target.agg(F.max(F.col(key))).scalar()


def incremental_filter(df: DataFrame, key: str, high_water: Column | None,
                       lookback_days: int = 0) -> DataFrame:
    """Rows with ``key > high_water - lookback_days``.

    With the default lookback a late value for an already-built key is never
    picked up; a positive lookback rebuilds that many trailing days. A NULL
    high-water mark (empty target) is treated as a first run: every row passes.
    """
    if high_water is None:
        return df
    bound = F.date_sub(high_water, lookback_days) if lookback_days else high_water
    return df.filter(bound.isNull() | (F.col(key) > bound))


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not updated, plus all update rows."""
    keys = list(keys)
    kept = target.join(updates.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(updates)


def _versions(spark: SparkSession, root: str) -> list[tuple[int, bool, str]]:
    """(number, full, path) of the complete versions, oldest first."""
    out = []
    for name, path, folder, *_ in listing(spark, root) or []:
        number, _, kind = name.partition("-")
        if folder and number.isdigit() and complete(spark, path):
            out.append((int(number), kind == "full", path))
    return sorted(out)


def _next_version(spark: SparkSession, root: str) -> int:
    """Above every version, also those that were not completed."""
    return 1 + max((int(n.partition("-")[0]) for n, *_ in listing(spark, root) or []
                    if n.partition("-")[0].isdigit()), default=-1)


def _bucket(df: DataFrame, key: str) -> Column:
    kind = dict(df.dtypes)[key]
    month = F.date_format(key, "yyyy-MM") if kind in ("date", "timestamp", "timestamp_ntz") else F.lit("all")
    return F.coalesce(month, F.lit("null"))


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """The merged table: of each bucket its newest complete version since the last full one."""
    buckets: dict[str, str] = {}
    for _, full, path in _versions(spark, root):
        buckets = {} if full else buckets
        buckets |= {name: own for name, own, folder, *_ in listing(spark, path) if folder and name.startswith("_bucket=")}
    return spark.read.parquet(*buckets.values()) if buckets else None


def merge_into(spark: SparkSession, root: str, build: Callable[[Column | None], DataFrame],
               key: str, lookback_days: int = 0, full_refresh: bool = False) -> DataFrame:
    """Incremental materialisation with merge on ``key``.

    First run (or ``full_refresh``, or an empty target): ``build(None)``.
    Later runs: ``build(high_water)`` yields only newer keys, which replace
    equal keys; the buckets they fall into are written as the next version.
    The updates are stored before they are merged, so their plan runs once and the buckets
    touched are those of the rows written. Returns the new current table.
    """
    held = None
    current = None if full_refresh else read_current(spark, root)
    path = f"{root.rstrip('/')}/{_next_version(spark, root):06d}"
    if current is None:
        rows, path = build(None), f"{path}-full"
    else:
        hwm = high_water_mark(current, key)
        if lookback_days:
            hwm = F.date_sub(hwm, lookback_days)
        updates, path, held = build(hwm), f"{path}-merge", scratch_path(spark, "merge-updates")
        updates.write.parquet(held)
        updates = spark.read.schema(updates.schema).parquet(held)
        touched = updates.select(_bucket(updates, key).alias("_touched")).distinct()
        own = current.join(touched, _bucket(current, key) == F.col("_touched"), "left_semi")
        rows = upsert(own, updates, [key])
    schema = rows.schema
    rows.withColumn("_bucket", _bucket(rows, key)).write.partitionBy("_bucket").parquet(path)
    if held:
        remove(spark, held)
    table = read_current(spark, root)
    return table if table is not None else spark.createDataFrame([], schema)


def vacuum(spark: SparkSession, root: str, min_age_hours: float = 24) -> list[str]:
    """Remove the versions that no bucket of the current table comes from, and those never completed.

    Only versions that were last written ``min_age_hours`` ago or earlier go, so that readers of an
    older state and merges under way are left alone. Returns the names removed.
    """
    used: dict[str, str] = {}
    for _, full, path in _versions(spark, root):
        used = {} if full else used
        used |= {name: path for name, _, folder, *_ in listing(spark, path) if folder and name.startswith("_bucket=")}
    latest, before, gone = _next_version(spark, root) - 1, (time.time() - 3600 * min_age_hours) * 1000, []
    for name, path, folder, _, modified in listing(spark, root) or []:
        number = name.partition("-")[0]
        if folder and number.isdigit() and int(number) != latest and path not in used.values() and modified <= before:
            remove(spark, path)
            gone.append(name)
    return gone
