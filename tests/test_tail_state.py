"""Technicals kept incrementally: equal to a rebuild, from new rows and tails alone."""

import datetime as dt
import os
import random
import time

from pyspark.sql import functions as F

from tidemark.operators import incremental as INC
from tidemark.operators import tail_state as TS
from tidemark.operators.sliding import sliding_technicals


def day(n):
    return dt.date(2018, 1, 1) + dt.timedelta(days=n)


def _prices(spark):
    r, rows = random.Random(3), []
    for k, days in (("HOT", range(700)), ("OLD", range(250)), ("NEW", range(400, 700)), ("GAP", [*range(30), *range(600, 640)])):
        rows += [(k, day(n), None if r.random() < 0.02 else round(100 + r.random() * 9, 2), "x") for n in days]
    return spark.createDataFrame(rows, "ticker string, price_date date, close_price double, other string")


def _rows(df):
    rows = df.select("ticker", "price_date", *sorted(set(df.columns) - {"ticker", "price_date"})).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: r[:2])


def test_runs_equal_rebuild_and_broken_run_is_redone(spark, tmpdir_path):
    prices, root = _prices(spark), tmpdir_path + "/t"
    for until in (90, 91, 320, 610):
        TS.append_technicals(prices.filter(F.col("price_date") <= F.lit(day(until))), root)
    # a run that wrote rows but no tails is as if it never was
    sliding_technicals(prices).limit(5).write.parquet(f"{root}/rows/run=4")
    assert TS.read_rows(spark, root).count() == prices.filter(F.col("price_date") <= F.lit(day(610))).count()
    out = TS.append_technicals(prices, root)
    want = _rows(sliding_technicals(prices))
    for a, b in zip(_rows(out), want, strict=True):
        assert all(x == y or (isinstance(x, float) and abs(x - y) < 2e-6) for x, y in zip(a, b, strict=True)), (a, b)
    # tails: the last two runs', 200 rows of a series at most; nothing new adds nothing
    assert len(os.listdir(f"{root}/tails")) == 2
    tails = spark.read.parquet(f"{root}/tails/run=4")
    assert tails.groupBy("ticker").count().agg(F.max("count")).first()[0] == TS.KEEP and tails.columns == ["ticker", "price_date", "close_price"]
    assert TS.append_technicals(prices, root).count() == prices.count()


def test_only_new_rows_are_read(spark, tmpdir_path):
    """The filter by the mark reaches the scan of the prices."""
    prices = _prices(spark)
    prices.write.parquet(tmpdir_path + "/p")
    stored = spark.read.parquet(tmpdir_path + "/p")
    TS.append_technicals(stored.filter(F.col("price_date") <= F.lit(day(600))), tmpdir_path + "/t")
    new = TS.new_rows(stored, spark.read.parquet(tmpdir_path + "/t/tails/run=0"), "price_date")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(price_date,2019-08-24)" in plan
    assert new.count() == prices.filter(F.col("price_date") > F.lit(day(600))).count()


def test_updates_are_read_once_and_old_versions_go(spark, tmpdir_path):
    runs = spark.sparkContext.accumulator(0)

    def counted(rows):
        for r in rows:
            runs.add(1)
            yield r

    def build(days):
        rdd = spark.sparkContext.parallelize([(day(n), float(n)) for n in days], 2).mapPartitions(counted)
        return lambda mark: spark.createDataFrame(rdd, "d date, v double")

    root = tmpdir_path + "/m"
    INC.merge_into(spark, root, build(range(40)), "d")
    runs.value = 0
    table = INC.merge_into(spark, root, build(range(35, 70)), "d")
    assert runs.value == 35 and table.count() == 70
    INC.merge_into(spark, root, build(range(36, 45)), "d")
    INC.merge_into(spark, root, build(range(70)), "d")
    assert INC.vacuum(spark, root) == []
    time.sleep(1.1)
    assert INC.vacuum(spark, root, min_age_hours=0.0003) == ["000000-full", "000001-merge", "000002-merge"]
    assert INC.read_current(spark, root).count() == 70


def test_runs_over_a_stored_table_store_no_input_again(spark, tmpdir_path):
    """Frames in Arrow batches over a stored table: the rows of a rebuild, and no second copy of the input."""
    from functools import partial

    from tidemark.operators.windows import with_technicals
    compute = partial(with_technicals, ma_method="arrow")
    path, held, own = f"{tmpdir_path}/prices", [], TS.scratch_path
    _prices(spark).select("ticker", "price_date", "close_price").write.parquet(path)
    prices = spark.read.parquet(path)
    try:
        TS.scratch_path = lambda s, name: held.append(name) or own(s, name)
        for until in (90, 320, 800):
            out = TS.append_technicals(prices.filter(F.col("price_date") <= F.lit(day(until))), f"{tmpdir_path}/t",
                                       compute=compute, stored=True)
    finally:
        TS.scratch_path = own
    assert not held and _rows(out) == _rows(with_technicals(prices))
