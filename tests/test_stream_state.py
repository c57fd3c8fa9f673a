"""Latest rows kept as keyed state: equal to the batch dedup, with late and replayed rows and restarts."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from tidemark.operators.windows import dedup_latest
from tidemark.streaming import jobs as ST
from tidemark.streaming import latest as SL

SCHEMA = "k string, day date, ts timestamp, n long, v double"


def _order():
    return [F.col("ts").desc_nulls_first(), F.col("n").desc_nulls_first()]


def _batches():
    r = random.Random(6)
    rows = [(r.choice(["HOT", "HOT", "a", "b", None]), dt.date(2024, 1, r.randint(1, 3)),
             None if r.random() < 0.02 else dt.datetime(2024, 1, 1, r.randint(0, 23)), n, None if r.random() < 0.2 else r.random())
            for n in range(300)]
    r.shuffle(rows)  # late rows all over
    return [rows[:100], rows[100:200] + rows[:40], rows[200:]]  # and replayed ones


def test_state_equals_batch_over_restarts(spark, tmpdir_path):
    src, out, ck = (os.path.join(tmpdir_path, n) for n in ("src", "out", "ck"))
    sizes = []
    for i, rows in enumerate(_batches()):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{src}/{i}")
        stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(src)
        SL.upsert_latest_state(stream, ["k", "day"], ["ts", "n"], out, ck).awaitTermination()  # a new query each time, from the checkpoint
        so_far = spark.read.option("recursiveFileLookup", True).schema(SCHEMA).parquet(src)
        want = dedup_latest(so_far, ["k", "day"], _order())
        got = ST.read_latest(spark, out, ["k", "day"], _order()).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()
        sizes.append(spark.read.parquet(out).count())
        last = spark.read.parquet(out)
        assert last.groupBy("k", "day", "_batch").count().filter("count > 1").count() == 0
    assert sizes[0] <= 15 and sizes[2] <= 45  # at most one row a key and batch
    SL.upsert_latest_state(spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(src),
                           ["k", "day"], ["ts", "n"], out, ck).awaitTermination()
    assert spark.read.parquet(out).count() == sizes[2]


def test_ties_and_batch_use(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 9), ("a", None, 2), ("b", 3, 1), ("b", 4, 0)], "k string, o int, v int")
    assert sorted(tuple(r) for r in SL.latest_rows(df, ["k"], ["o"]).collect()) == [("a", None, 2), ("b", 4, 0)]
    assert sorted(tuple(r) for r in SL.latest_rows(df.filter("o is not null"), ["k"], ["o"]).collect()) == [("a", 1, 9), ("b", 4, 0)]
