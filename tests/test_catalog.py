"""Layer databases and bucketed tables."""

import os
import time

import pytest

from tidemark.plans import catalog as C
from tidemark.plans import medallion as M


@pytest.fixture(scope="module")
def medallion(spark):
    from tidemark.plans.pipeline import standin_medallion
    return standin_medallion(spark, "/root/testdata/sf0.001")


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def _drop(spark):
    for layer in ("silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")


def test_bucketed_tables_need_no_exchange(spark, medallion, tmpdir_path):
    _drop(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too large to broadcast
    try:
        own = C.save_layers({n: medallion.ref(n) for n in ("stg_daily_prices", "dim_tickers")}, tmpdir_path, 4)
        technicals = M.prices_with_technicals(own["stg_daily_prices"])
        assert not _exchanges(technicals) and _exchanges(medallion.ref("prices_with_technicals"))
        technicals = C.save_table(technicals, tmpdir_path, "prices_with_technicals", 4)
        assert technicals.exceptAll(medallion.ref("prices_with_technicals")).count() == 0
        joined = technicals.join(own["dim_tickers"].select("ticker", "gics_sector"), "ticker")
        assert not _exchanges(joined)
        assert joined.count() == medallion.ref("prices_with_technicals").join(medallion.ref("dim_tickers"), "ticker").count()
        assert spark.sql("SELECT count(*) AS n FROM silver.prices_with_technicals").first()["n"] == technicals.count()
        files = [f for f in os.listdir(technicals.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]) if f.startswith("part-")]
        assert len(files) == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        _drop(spark)


def test_old_folders_go_when_no_name_points_to_them(spark, tmpdir_path):
    _drop(spark)
    for n in (3, 4, 5):
        table = C.save_table(spark.range(n).toDF("v"), tmpdir_path, "regime_analysis", 4)
    folder = f"{tmpdir_path}/GOLD/regime_analysis"
    assert table.count() == 5 and len(os.listdir(folder)) == 3
    assert C.drop_unread(spark, tmpdir_path, "regime_analysis") == []  # too young: someone may read them
    time.sleep(1.1)
    assert len(C.drop_unread(spark, tmpdir_path, "regime_analysis", min_age_hours=0.0003)) == 2
    assert len(os.listdir(folder)) == 1 and spark.table("gold.regime_analysis").count() == 5
    _drop(spark)
