"""Landing JSON scan, Bronze audit columns, idempotent loads, staging extract."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tidemark.plans import medallion as M
from tidemark.sources import landing as L


def _write(path, payload):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(payload if isinstance(payload, str) else json.dumps(payload))


def test_scan_arrays_empty_and_lines(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "stock-prices")
    _write(f"{root}/2024-01-02.json", [{"ticker": "AAPL", "date": "2024-01-02", "close": 1.5, "volume": 2.5},
                                       {"ticker": "MSFT", "date": "2024-01-02", "close": None}])
    _write(f"{root}/2024-01-03.json", [])
    _write(f"{root}/sub/2024-01-04.json", '{"ticker": "AAPL", "date": "2024-01-04", "close": 2.0}\n')
    _write(f"{root}/notes.txt", "ignored")
    b = L.read_landing(spark, root, "yahoo_finance")
    assert b.count() == 3
    assert set(b.columns) >= {"raw_data", "source", "_loaded_at", "_file_name"}
    stg = M.stg_daily_prices(b.select(*L.BRONZE_COLUMNS)).orderBy("ticker", "price_date").collect()
    assert [r.ticker for r in stg] == ["AAPL", "AAPL", "MSFT"]
    assert str(stg[0].volume) == "3" and stg[2].close_price is None and stg[0].open_price is None


def test_malformed_file_fails(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "bad")
    _write(f"{root}/2024-01-02.json", '[{"ticker": "AAPL", ')
    with pytest.raises(Exception):
        L.read_landing(spark, root, "x").collect()


def test_bad_date_strict_vs_try(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "dates")
    _write(f"{root}/a.json", [{"ticker": "A", "date": "not-a-date", "close": 1.0}])
    b = L.read_landing(spark, root, "x").select(*L.BRONZE_COLUMNS)
    with pytest.raises(Exception):
        M.stg_daily_prices(b).collect()
    assert M.stg_daily_prices(b, strict=False).first().price_date is None


def test_ingest_is_idempotent_and_reloads_changed_files(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "fear-greed")
    bronze = os.path.join(tmpdir_path, "bronze")
    _write(f"{root}/2024-01-01.json", [{"date": "2024-01-01", "value": 40, "classification": "Fear"}])
    assert L.ingest(spark, root, "alternative_me", bronze).first().rows_loaded == 1
    assert L.ingest(spark, root, "alternative_me", bronze).count() == 0
    assert spark.read.parquet(bronze).count() == 1
    time.sleep(1.1)
    _write(f"{root}/2024-01-01.json", [{"date": "2024-01-01", "value": 60, "classification": "Greed"},
                                       {"date": "2024-01-02", "value": 61, "classification": "Greed"}])
    L.ingest(spark, root, "alternative_me", bronze)
    b = spark.read.parquet(bronze)
    assert b.count() == 3
    stg = {str(r.reading_date): int(r.fng_value) for r in M.stg_fear_greed(b).collect()}
    assert stg == {"2024-01-01": 60, "2024-01-02": 61}


def test_write_landing_rerun_replaces_day(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "land")
    d1 = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "date string, v int")
    L.write_landing(d1, root)
    L.write_landing(spark.createDataFrame([("2024-01-02", 3)], "date string, v int"), root)
    got = sorted((str(r.date), r.v) for r in spark.read.json(root).collect())
    assert got == [("2024-01-01", 1), ("2024-01-02", 3)]


def test_load_counts_total(spark):
    a = spark.createDataFrame([(1, "f1"), (2, "f1"), (3, "f2")], "x int, _file_name string")
    b = spark.createDataFrame([(1, "g1")], "x int, _file_name string")
    got = {r.table_name: (r.files, r.rows_loaded) for r in L.load_counts({"a": a, "b": b}).collect()}
    assert got == {"a": (2, 3), "b": (1, 1), "TOTAL": (3, 4)}


def test_empty_day_writes_artifact_and_warns(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "land-empty")
    empty = spark.createDataFrame([], "date string, v int")
    with pytest.warns(UserWarning):
        L.write_landing(empty, root, run_date="2024-01-09")
    assert any(f.endswith(".json") for f in os.listdir(os.path.join(root, "date=2024-01-09")))
    assert L.read_landing(spark, root, "x").count() == 0


def test_second_run_reads_no_old_file(spark, tmpdir_path):
    root, bronze = os.path.join(tmpdir_path, "prices"), os.path.join(tmpdir_path, "bronze")
    _write(f"{root}/2024-01-01.json", [{"v": 1}])
    L.ingest(spark, root, "x", bronze)
    old = os.stat(f"{root}/2024-01-01.json")
    _write(f"{root}/2024-01-01.json", "[{'v':")  # unreadable now, with the same time and size
    with open(f"{root}/2024-01-01.json", "w") as f:
        f.write("!" * old.st_size)
    os.utime(f"{root}/2024-01-01.json", ns=(old.st_atime_ns, old.st_mtime_ns))
    _write(f"{root}/pair.json", [{"v": 2}, {"v": 3}])
    assert [r.rows_loaded for r in L.ingest(spark, root, "x", bronze).collect()] == [2]
    assert L.ingest(spark, root + "-absent", "x", bronze + "2").count() == 0


def test_permissive_scan_drops_and_counts_bad_records(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "mixed")
    _write(f"{root}/part-0.json", '{"v": 1}\n{"v": \n{"v": 3}\n')
    _write(f"{root}/b.json", '[{"v": 1}, ')
    _write(f"{root}/c.json", '{"v": 4}\nbad\n')
    got = L.scan_landing(spark, root, fail_fast=False)
    assert got.count() == 3
    bad = {os.path.basename(r.file_path): r.n_bad for r in L.bad_records(spark, root).collect()}
    assert bad == {"part-0.json": 1, "b.json": 1, "c.json": 1}
    with pytest.raises(Exception):
        L.scan_landing(spark, root).collect()


def test_late_files_and_days_without_lists(spark, tmpdir_path, monkeypatch):
    """New files by their time, late ones (older than the newest loaded) by name in passes, bounds on both."""
    monkeypatch.setattr(L, "LATE_FILES", 2)
    root, bronze = os.path.join(tmpdir_path, "prices"), os.path.join(tmpdir_path, "bronze")

    def put(day, value, age):
        _write(f"{root}/2024-01-{day:02d}.json", [{"v": value}])
        at = 1_700_000_000 - age
        os.utime(f"{root}/2024-01-{day:02d}.json", (at, at))

    def seen():
        return sorted(r[0] for r in spark.read.parquet(bronze).select(F.variant_get("raw_data", "$.v", "int")).collect())

    for day in (1, 2, 9):
        put(day, day, 1000 - day)
    assert L.ingest(spark, root, "x", bronze, start="2024-01-02", end="2024-01-08").count() == 1 and seen() == [2]
    for day in (3, 4, 5, 6, 7):
        put(day, day, 5000 + day)  # late, but for day 2's file all older
    put(8, 8, 10)
    assert L.ingest(spark, root, "x", bronze, end="2024-01-08").count() == 7 and seen() == [1, 2, 3, 4, 5, 6, 7, 8]
    assert L.ingest(spark, root, "x", bronze, end="2024-01-08").count() == 0
    put(2, 22, 990)  # delivered anew with an older time
    _write(f"{root}/none.json", [{"v": 99}])
    assert L.ingest(spark, root, "x", bronze).count() == 3 and seen() == [1, 2, 3, 4, 5, 6, 7, 8, 9, 22, 99]
