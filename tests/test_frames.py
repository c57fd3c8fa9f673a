"""Row frames in Arrow batches: the bits of Spark's sliding frames, across batches and series."""

import random
import struct

import pytest

from tidemark.operators.windows import with_technicals


def _bits(x):
    return struct.pack(">d", x) if isinstance(x, float) and x == x else x if x is None or x == x else "nan"


@pytest.fixture(scope="module")
def prices(spark):
    r, rows = random.Random(11), []
    for k, n in (("LONG", 900), ("FLAT", 60), ("NULLS", 40), (None, 230), ("ONE", 1), *((f"S{i}", r.randrange(1, 30)) for i in range(40))):
        p = 100.0
        for day in range(n):
            p = p if k == "FLAT" else round(p * (0.95 + r.random() / 10), 2)
            odd = r.random()
            rows.append((k, day, None if k == "NULLS" or odd < 0.03 else 0.0 if odd < 0.04 else -p if odd < 0.05 else p))
    rows += [("NAN", i, float("nan") if i == 5 else float(i)) for i in range(40)]
    r.shuffle(rows)
    return spark.createDataFrame(rows, "ticker string, price_date int, close_price double").cache()


@pytest.mark.parametrize("batch", ["1", "7", "10000"])
def test_arrow_frames_equal_sliding_frames_in_every_bit(spark, prices, batch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(key)
    spark.conf.set(key, batch)
    try:
        found = with_technicals(prices, ma_method="arrow")
        got = found.collect()
    finally:
        spark.conf.set(key, own)
    frames = with_technicals(prices)
    assert found.columns == frames.columns
    want = {r[:2]: r for r in frames.collect()}
    assert len(got) == len(want) == prices.count()
    for row in got:
        assert [_bits(x) for x in row] == [_bits(x) for x in want[row[:2]]], (row, want[row[:2]])


def test_arrow_technicals_have_no_sliding_window(spark, prices):
    """One exchange of the rows, and no window that goes over its frame for every row."""
    plan = with_technicals(prices, ma_method="arrow")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange hashpartitioning") == 1
