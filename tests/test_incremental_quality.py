"""Incremental merge and data-quality checks."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import incremental as INC
from tidemark.operators import quality as DQ


def _days(spark, rows):
    return spark.createDataFrame(rows, "d string, v double").withColumn("d", F.to_date("d"))


def test_upsert_replaces_keys(spark):
    t = _days(spark, [("2024-01-01", 1.0), ("2024-01-02", 2.0)])
    u = _days(spark, [("2024-01-02", 20.0), ("2024-01-03", 3.0)])
    got = sorted((str(r.d), r.v) for r in INC.upsert(t, u, ["d"]).collect())
    assert got == [("2024-01-01", 1.0), ("2024-01-02", 20.0), ("2024-01-03", 3.0)]


def test_merge_into_incremental_equals_full_and_ignores_late(spark, tmpdir_path):
    src = _days(spark, [("2024-01-01", 1.0), ("2024-01-02", 2.0), ("2024-01-03", 3.0)])

    def build(hwm):
        return INC.incremental_filter(src, "d", hwm)

    root = tmpdir_path + "/t"
    INC.merge_into(spark, root, lambda h: src.filter("d <= date'2024-01-02'"), "d")
    cur = INC.merge_into(spark, root, build, "d")
    assert sorted(str(r.d) for r in cur.collect()) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    again = INC.merge_into(spark, root, build, "d")
    assert again.count() == 3
    late = _days(spark, [("2024-01-02", 99.0)])
    after_late = INC.merge_into(spark, root, lambda h: INC.incremental_filter(late, "d", h), "d")
    assert {str(r.d): r.v for r in after_late.collect()}["2024-01-02"] == 2.0
    looked = INC.merge_into(spark, root, lambda h: INC.incremental_filter(late, "d", h), "d", lookback_days=2)
    assert {str(r.d): r.v for r in looked.collect()}["2024-01-02"] == 99.0


def test_unfinished_version_is_not_read(spark, tmpdir_path):
    import os
    root = tmpdir_path + "/t"
    good = _days(spark, [("2024-01-01", 1.0), ("2024-01-02", 2.0), ("2024-02-01", 3.0)])
    INC.merge_into(spark, root, lambda h: good, "d")
    half = f"{root}/000001-merge/_bucket=2024-01"
    _days(spark, [("2024-01-01", 9.0)]).write.parquet(half)  # its merge never committed
    assert INC.read_current(spark, root).count() == 3
    INC.merge_into(spark, root, lambda h: _days(spark, [("2024-02-02", 4.0)]), "d")
    assert {str(r.d): r.v for r in INC.read_current(spark, root).collect()} == {
        "2024-01-01": 1.0, "2024-01-02": 2.0, "2024-02-01": 3.0, "2024-02-02": 4.0}
    assert sorted(os.listdir(f"{root}/000002-merge")) [-1:] == ["_bucket=2024-02"]  # only the month it touched
    INC.merge_into(spark, root, lambda h: good.limit(0), "d", full_refresh=True)
    assert INC.read_current(spark, root) is None


def test_incremental_filter_empty_target_is_first_run(spark):
    src = _days(spark, [("2024-01-01", 1.0)])
    empty = src.limit(0)
    assert INC.incremental_filter(src, "d", INC.high_water_mark(empty, "d")).count() == 1


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 1, None), (None, 2, 150.0), ("b", 3, -1.0)],
                               "k string, n int, v double")
    assert DQ.dq_not_null(df, "k").count() == 1
    assert DQ.dq_unique(df, "k").first().k == "a"
    assert DQ.dq_unique_combo(df, ["k", "n"]).count() == 1
    assert DQ.dq_range(df, "v", 0, 100).count() == 2
    assert DQ.dq_range(df, "v", 0, 100, inclusive=False).count() == 2
    assert DQ.dq_bounds(df, "v", 0, 100).count() == 2
    d = spark.createDataFrame([("2024-01-05",), ("2030-01-01",)], "d string").withColumn("d", F.to_date("d"))
    assert DQ.dq_future_dates(d, "d", F.to_date(F.lit("2024-06-01"))).count() == 1
    rep = DQ.dq_report({"nn": DQ.dq_not_null(df, "k"), "ok": DQ.dq_not_null(df, "n")})
    assert {r.check_name: r.failures for r in rep.collect()} == {"nn": 1, "ok": 0}
    try:
        DQ.dq_gate(rep)
        raise AssertionError("gate should fail")
    except DQ.DataQualityError as e:
        assert "nn" in str(e)


def test_freshness(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0),)], "_loaded_at timestamp")
    as_of = F.lit(dt.datetime(2024, 1, 2, 6, 0))
    r = DQ.dq_freshness(df, as_of=as_of, source="s").first()
    assert r.age_hours == 30 and r.status == "warn"
    r2 = DQ.dq_freshness(df, as_of=F.lit(dt.datetime(2024, 1, 3, 1, 0))).first()
    assert r2.status == "error"
