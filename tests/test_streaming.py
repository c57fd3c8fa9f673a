"""Streaming twins equal their batch jobs."""

import json
import os

from pyspark.sql import functions as F

from tidemark.operators.windows import dedup_latest
from tidemark.sources import vendor as V
from tidemark.streaming import jobs as ST

from conftest import SF_SMALL


def test_stream_ingest_exactly_once(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "land")
    os.makedirs(land)
    with open(f"{land}/2024-01-01.json", "w") as f:
        json.dump([{"a": 1}, {"a": 2}], f)
    bronze, ck = os.path.join(tmpdir_path, "b"), os.path.join(tmpdir_path, "ck")
    ST.ingest_stream(spark, land, "s", bronze, ck).awaitTermination()
    ST.ingest_stream(spark, land, "s", bronze, ck).awaitTermination()
    assert spark.read.parquet(bronze).count() == 2
    with open(f"{land}/2024-01-02.json", "w") as f:
        json.dump([{"a": 3}], f)
    ST.ingest_stream(spark, land, "s", bronze, ck).awaitTermination()
    got = sorted(r[0] for r in spark.read.parquet(bronze).select(F.variant_get("raw_data", "$.a", "int")).collect())
    assert got == [1, 2, 3]


def test_stream_dedup_equals_batch(spark, tmpdir_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = os.path.join(tmpdir_path, "src")
    ev.repartition(4).write.parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src) \
        .withColumn("d", F.to_date("ts"))
    order = [F.col("ts").desc_nulls_first(), F.col("event_id").desc_nulls_first()]
    target = os.path.join(tmpdir_path, "t")
    ST.upsert_latest_stream(stream, ["user_id", "d"], order, target,
                            os.path.join(tmpdir_path, "ck")).awaitTermination()
    got = ST.read_latest(spark, target, ["user_id", "d"], order).select("event_id")
    compacted = ST.compact_latest(spark, target, os.path.join(tmpdir_path, "c"), ["user_id", "d"], order)
    assert compacted.select("event_id").exceptAll(got).count() == 0
    want = dedup_latest(ev.withColumn("d", F.to_date("ts")), ["user_id", "d"], order).select("event_id")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_stream_bars_equal_batch_except_open_day(spark, tmpdir_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    src = os.path.join(tmpdir_path, "src")
    ev.write.parquet(src)
    ticks = spark.readStream.schema(ev.schema).parquet(src)
    out = os.path.join(tmpdir_path, "bars")
    (ST.daily_bars_stream(ticks, "event_type", "ts", "value").writeStream.format("parquet")
     .option("path", out).option("checkpointLocation", os.path.join(tmpdir_path, "ck"))
     .trigger(availableNow=True).start().awaitTermination())
    got = spark.read.parquet(out)
    batch = V.ohlcv_bars(ev, "event_type", "ts", "value")
    last_day = ev.agg(F.max(F.to_date("ts"))).first()[0]
    want = batch.filter(F.col("date") < F.lit(last_day))
    assert got.count() == want.count() and got.select(*want.columns).exceptAll(want).count() == 0


def test_new_checkpoint_never_overwrites_older_batches(spark, tmpdir_path):
    from pyspark.sql import functions as F
    order, target = [F.col("ts").desc_nulls_first()], f"{tmpdir_path}/latest"
    for run, rows in enumerate(([("a", 1), ("b", 1)], [("c", 1), ("a", 2)])):
        src = f"{tmpdir_path}/src{run}"
        spark.createDataFrame(rows, "k string, ts int").write.parquet(src)
        stream = spark.readStream.schema("k string, ts int").parquet(src)
        ST.upsert_latest_stream(stream, ["k"], order, target, f"{tmpdir_path}/ck{run}").awaitTermination()
    assert {r.k: r.ts for r in ST.read_latest(spark, target, ["k"], order).collect()} == {"a": 2, "b": 1, "c": 1}


def test_open_day_and_equal_timestamps(spark, tmpdir_path):
    from pyspark.sql import functions as F
    schema = "k string, ts timestamp, price double, seq int"
    rows = [("a", "2024-01-01 10:00:00", 1.0, 2), ("a", "2024-01-01 10:00:00", 2.0, 1), ("a", "2024-01-01 11:00:00", 3.0, 4),
            ("a", "2024-01-01 11:00:00", 4.0, 3)]
    df = spark.createDataFrame(rows, "k string, t string, price double, seq int") \
        .select("k", F.col("t").cast("timestamp").alias("ts"), "price", "seq")
    df.write.parquet(f"{tmpdir_path}/src")
    bars = ST.daily_bars_stream(spark.readStream.schema(schema).parquet(f"{tmpdir_path}/src"), "k", "ts", "price", seq="seq")
    ST.upsert_bars(bars, f"{tmpdir_path}/bars", f"{tmpdir_path}/ck").awaitTermination()
    got = ST.read_bars(spark, f"{tmpdir_path}/bars", "k").collect()
    from tidemark.sources.vendor import ohlcv_bars
    batch = ohlcv_bars(df, "k", "ts", "price", seq="seq").first()
    assert [(r.open, r.close, r.volume) for r in got] == [(2.0, 3.0, 4)] == [(batch.open, batch.close, batch.volume)]


def test_stream_takes_whole_arrays_and_splits_lines(spark, tmpdir_path):
    """Arrays over several lines, files of lines, and Spark's own files of lines, each taken once."""
    land = os.path.join(tmpdir_path, "land")
    os.makedirs(land + "/date=2024-01-03")
    files = {"2024-01-01.json": json.dumps([{"a": i, "t": "x"} for i in range(5)], indent=2), "pat.json": '\n [{"a": 5}]',
             "p.json": '{"a": 6}\n\n{"a": 7}\n', "date=2024-01-03/part-0.json": '{"a": 8}\n\n{"a": 9}\n', "notes.txt": "no"}
    for name, text in files.items():
        with open(f"{land}/{name}", "w") as f:
            f.write(text)
    bronze, ck = os.path.join(tmpdir_path, "b"), os.path.join(tmpdir_path, "ck")
    for _ in range(2):
        ST.ingest_stream(spark, land, "s", bronze, ck).awaitTermination()
        got = sorted(r[0] for r in spark.read.parquet(bronze).select(F.variant_get("raw_data", "$.a", "int")).collect())
        assert got == list(range(10))
    from tidemark.sources import landing as L
    assert L.scan_landing(spark, land).count() == 10
