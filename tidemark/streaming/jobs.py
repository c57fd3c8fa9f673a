"""File-stream jobs: exactly-once landing ingest, latest-row upsert, daily bars.

All run with a checkpoint in the shared folder, so a restarted query resumes
where it stopped, and with ``trigger(availableNow=True)`` for batch-style
catch-up runs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.windows import dedup_latest
from tidemark.sources.landing import BRONZE_COLUMNS, LINES_PREFIX, load_time


#: Names of landing files that Spark did not write (all but ``part-*.json``), as a glob.
OTHER_FILES = "{[!p]*,p,p[!a]*,pa,pa[!r]*,par,par[!t]*,part,part[!-]*}.json"


def landing_stream(spark: SparkSession, path: str, source: str, fail_fast: bool = True) -> DataFrame:
    """Streaming scan of landing JSON files -> Bronze rows.

    Files that Spark wrote are read line by line and split like any text, all others whole, as an
    array or as lines, like the batch scan does. The file sources record every processed path in
    their checkpoint, so each file is ingested exactly once. A file later overwritten under the
    same name is not seen again (use the batch ledger ingest for that case).
    """
    def text(glob: str, whole: bool) -> DataFrame:
        return (spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
                .text(path, wholetext=whole))

    parse = F.parse_json if fail_fast else F.try_parse_json
    filled = lambda s: F.length(F.trim(s)) > 0
    lines = F.filter(F.split(F.col("value"), "\n"), filled)
    arr = F.when(F.regexp_replace("value", r"^\s+", "").startswith("["),
                 F.from_json(F.col("value"), "array<variant>",
                             {"mode": "FAILFAST" if fail_fast else "PERMISSIVE"})) \
        .otherwise(F.transform(lines, lambda s: parse(s)))
    meta = [F.lit(source).alias("source"), load_time().alias("_loaded_at"), F.col("_metadata.file_path").alias("_file_name")]
    whole = text(OTHER_FILES, True).select(F.explode(arr).alias("raw_data"), *meta)
    by_line = text(f"{LINES_PREFIX}*.json", False).filter(filled(F.col("value"))).select(
        parse(F.col("value")).alias("raw_data"), *meta)
    return whole.unionByName(by_line).select(*BRONZE_COLUMNS)


def ingest_stream(spark: SparkSession, landing_path: str, source: str, bronze_path: str,
                  checkpoint: str) -> StreamingQuery:
    """Append new landing files to a Bronze parquet table (exactly once)."""
    return (landing_stream(spark, landing_path, source).writeStream.format("parquet")
            .option("checkpointLocation", checkpoint).option("path", bronze_path)
            .outputMode("append").trigger(availableNow=True).start())


def batch_name(batch: DataFrame, epoch_id: int) -> str:
    """Name of a micro-batch that no other query or epoch has."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{int(epoch_id):09d}"


def write_changes(target_root: str) -> Callable[[DataFrame, int], None]:
    """A batch writer: each batch is a partition of its own, which a replay writes anew."""
    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        (batch.withColumn("_batch", F.lit(batch_name(batch, epoch_id))).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(target_root))

    return write_batch


def upsert_latest_stream(stream: DataFrame, keys: Sequence[str], order: Sequence[Column],
                         target_root: str, checkpoint: str) -> StreamingQuery:
    """Keep the latest row per key across micro-batches (append-only target).

    Each micro-batch is deduplicated and written as its own
    ``_batch=<query id>-<epoch>`` partition (dynamic overwrite, so a replayed
    epoch replaces only itself: exactly once; a query with a new checkpoint has
    a new id and never overwrites another's batches). Writes cost O(batch), never O(table). ``read_latest``
    resolves the newest row per key across batches under the same order, so
    an older late row never wins; ``compact_latest`` folds the batches.
    """
    keys = list(keys)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        (dedup_latest(batch, keys, order).withColumn("_batch", F.lit(batch_name(batch, epoch_id)))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_batch").parquet(target_root))

    return (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_latest(spark: SparkSession, target_root: str, keys: Sequence[str],
                order: Sequence[Column]) -> DataFrame:
    """Newest row per key over all batch partitions of an upsert target."""
    rows = spark.read.parquet(target_root)
    return dedup_latest(rows, list(keys), order).drop("_batch")


def compact_latest(spark: SparkSession, target_root: str, compacted_root: str, keys: Sequence[str],
                   order: Sequence[Column]) -> DataFrame:
    """Write the resolved latest rows to a new table (readers switch to it)."""
    read_latest(spark, target_root, keys, order).withColumn("_batch", F.lit("compacted")) \
        .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_batch").parquet(compacted_root)
    return spark.read.parquet(compacted_root).drop("_batch")


def daily_bars_stream(ticks: DataFrame, key: str, ts: str, price: str,
                      delay: str = "1 hour", size: str | None = None, seq: str | None = None) -> DataFrame:
    """Streaming daily OHLCV bars per key.

    In append mode a day's bar is emitted once the event-time watermark (newest
    event time minus ``delay``) passes the end of that day; in update mode with
    each batch that changes it (see ``upsert_bars``). Later events for a day
    behind the watermark are dropped as late. Equal timestamps go by ``seq``.
    """
    vol = F.sum(F.col(size)) if size else F.count(F.lit(1))
    at = F.struct(F.col(ts), F.col(seq or price))
    bars = (ticks.withWatermark(ts, delay)
            .groupBy(F.col(key), F.window(F.col(ts), "1 day").alias("w"))
            .agg(F.min_by(F.col(price), at).alias("open"), F.max(F.col(price)).alias("high"),
                 F.min(F.col(price)).alias("low"), F.max_by(F.col(price), at).alias("close"),
                 vol.alias("volume")))
    return bars.select(key, F.to_date(F.col("w.start")).alias("date"), "open", "high", "low", "close",
                       "volume")


def upsert_bars(bars: DataFrame, target_root: str, checkpoint: str) -> StreamingQuery:
    """Write each changed bar with its batch (update mode); days still open are there too.

    A bar only grows, so the newest state of a (key, date) has the most ticks:
    ``read_bars`` takes that one.
    """
    return (bars.writeStream.outputMode("update").foreachBatch(write_changes(target_root))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_bars(spark: SparkSession, target_root: str, key: str) -> DataFrame:
    """Newest state of every bar that ``upsert_bars`` wrote, the open days included."""
    return read_latest(spark, target_root, [key, "date"], [F.col("volume").desc_nulls_last(), F.col("_batch").desc()])
