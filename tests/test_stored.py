"""Stored tables: their columns, and row tests measured by the tasks that write them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import jobs as J
from tidemark.plans import medallion as M

# Names and order of the exported Gold columns.
GOLD = {
    "dim_tickers": "TICKER,COMPANY_NAME,YAHOO_SECTOR,GICS_SECTOR,INDUSTRY,MARKET_CAP,PE_RATIO",
    "daily_market_snapshot": "SNAPSHOT_DATE,SP500_CLOSE,SP500_RETURN,NASDAQ_CLOSE,DOW_CLOSE,ADVANCERS,DECLINERS,BTC_PRICE,"
                             "BTC_DOMINANCE,BTC_RETURN,FNG_VALUE,FNG_CLASSIFICATION,FED_FUNDS_RATE,TREASURY_10Y,TREASURY_2Y,"
                             "SPREAD_10Y_2Y,IS_INVERTED,VIX,WTI_CRUDE_OIL",
    "macro_asset_correlation": "ASSET,MACRO_INDICATOR,CORRELATION,N_OBS",
    "regime_analysis": "RATE_REGIME,VOL_REGIME,NUM_DAYS,AVG_SP500_RETURN,AVG_BTC_RETURN",
    "sector_performance": "GICS_SECTOR,PRICE_DATE,NUM_CONSTITUENTS,AVG_DAILY_RETURN,TOTAL_CLOSE_PRICE",
}


@pytest.fixture(scope="module")
def medallion(spark):
    from tidemark.plans.pipeline import standin_medallion
    return standin_medallion(spark, "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(GOLD))
def test_gold_columns(medallion, name):
    assert [c.upper() for c in medallion.ref(name).columns] == GOLD[name].split(",")


def _prices(spark):
    rows = [("A", dt.date(2020, 1, 1 + i), float(i - 2)) for i in range(20)] + [(None, dt.date(2020, 2, 1), 1.0), ("B", None, 5.0),
                                                                               ("B", dt.date(2999, 1, 1), 2.0), ("A", dt.date(2020, 1, 1), 1.0)]
    return spark.createDataFrame(rows, "ticker string, price_date date, close_price double")


@pytest.mark.parametrize("day", [None, "price_date"])
def test_row_tests_are_measured_while_storing(spark, tmpdir_path, day):
    tests, measured = [t for t in J.TESTS if t[0] == "stg_daily_prices"], {}
    df = _prices(spark)
    table = J.store(df, tmpdir_path + "/t", day, J.row_tests("stg_daily_prices"), measured)
    assert table.columns == df.columns and table.count() == df.count()
    want = {r["check_name"]: r["failures"] for r in J.quality_report({"stg_daily_prices": df}, tests).collect()}
    assert sorted(want.values()) == [1, 1, 1, 1, 2]
    assert measured == {k: v for k, v in want.items() if ".unique" not in k}
    report = J.quality_report({"stg_daily_prices": table}, tests, measured=measured)
    assert {r["check_name"]: r["failures"] for r in report.collect()} == want
    # what is left to read are the columns of the key
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("GROUP BY") == 0
    assert "ReadSchema: struct<ticker:string,price_date:date>" in report._jdf.queryExecution().executedPlan().toString()
    only = J.quality_report({"stg_daily_prices": table}, [t for t in tests if t[1] != "unique_combo"], measured=measured)
    assert "Relation [" not in only._jdf.queryExecution().optimizedPlan().toString()
    assert only.agg(F.sum("failures")).first()[0] == 5


def test_snapshot_columns_in_order():
    assert [c.upper() for c in M.SNAPSHOT_COLUMNS] == GOLD["daily_market_snapshot"].split(",")


def test_bronze_is_written_without_a_shuffle_and_scans_are_bounded(spark, tmpdir_path):
    """Records go to Bronze from the tasks that shaped them; scans are cut into at most the bound, smaller ones stay."""
    from tidemark.plans import pipeline as P
    key, own = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    for given, want in (("128m", str(P.SCAN_BYTES)), ("1gb", str(P.SCAN_BYTES)), ("134217728b", str(P.SCAN_BYTES)), ("1m", "1m"), ("4096", "4096")):
        spark.conf.set(key, given)
        P._bound_scans(spark)
        assert spark.conf.get(key) == want
    spark.conf.set(key, own)
    written = []
    spark.range(5).selectExpr("id", "'f' as _file_name").write.parquet(f"{tmpdir_path}/t")
    table = spark.read.parquet(f"{tmpdir_path}/t")
    original, tag, shared = P.standin_bronze, P._input_tag, P.shared_dir
    try:
        P.standin_bronze = lambda s, d: {n: table for n in P.BRONZE_TABLES}
        P._input_tag, P.shared_dir = (lambda s, d: "x"), (lambda s: tmpdir_path)
        table.repartition, table_repartition = lambda *a: written.append(a), table.repartition
        got = P.persisted_bronze(spark, "d")["raw_stock_prices"]()
        assert got.count() == 5 and not written
    finally:
        P.standin_bronze, P._input_tag, P.shared_dir = original, tag, shared
        table.repartition = table_repartition
        spark.conf.set(key, own)


def test_sector_constituents_without_distinct_keys(spark):
    """Repeated rows, seeds and days without a date count once; the plan holds no (sector, day, ticker) keys."""
    from pyspark.sql import functions as F

    from tidemark.plans import medallion as M
    t = spark.sql("""select * from values ('A', date'2024-01-02', 0.1d, 10.0d), ('A', date'2024-01-02', 0.3d, 12.0d), ('B', date'2024-01-02', null, 5.0d),
        ('A', null, 0.2d, 1.0d), ('C', date'2024-01-02', 0.5d, 9.0d), (null, date'2024-01-02', 0.5d, 9.0d)
        as t(ticker, price_date, daily_return, close_price)""")
    seeds = spark.sql("select * from values ('A'), ('A'), ('B'), ('C'), (null) as s(ticker)")
    dim = spark.sql("select * from values ('A', 'X'), ('A', 'X'), ('A', 'Y'), ('B', 'X'), ('C', null) as d(ticker, gics_sector)")
    got = M.sector_performance(t, seeds, dim)
    want = (t.join(seeds, "ticker").join(dim, "ticker").filter("gics_sector is not null").groupBy("gics_sector", "price_date")
            .agg(F.count_distinct("ticker").alias("num_constituents"), F.avg("daily_return").alias("avg_daily_return"),
                 F.sum("close_price").alias("total_close_price")))
    key = lambda f: sorted(((r[0], str(r[1]), r[2], round(r[3], 9), r[4]) for r in f.collect()), key=str)
    assert key(got) == key(want) and got.schema["num_constituents"] == want.schema["num_constituents"]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "distinct" not in plan.lower() and not [line for line in plan.split("\n") if "Aggregate" in line and "ticker" in line]


def test_macro_context_reads_its_days_once(spark):
    """The trading days' plan runs once, not for the spine and the result each."""
    import datetime as dt

    from tidemark.plans import extras as X
    macro = spark.sql("select 'DFF' as series_id, date'2024-01-02' as observation_date, 1.5d as value")
    days = spark.sql("select * from values (date'2024-01-02'), (date'2024-01-02'), (date'2024-01-03'), (null) as t(price_date)") \
        .selectExpr("price_date", "uuid() as own")
    got = X.macro_context(macro, days, {"DFF": "rate"})
    assert sorted(((r[0], r[1]) for r in got.collect()), key=str) == sorted(
        [(dt.date(2024, 1, 2), 1.5), (dt.date(2024, 1, 3), None), (None, None)], key=str)
    assert sum("trading-days" in f for f in got.inputFiles()) >= 1


def test_bronze_files_hold_a_bounded_number_of_records(spark, tmpdir_path):
    """A row group is one task's; a large one of the input must not become a large one of Bronze."""
    from tidemark.plans import pipeline as P
    table = spark.range(0, 1000, 1, 1).selectExpr("id", "'f' as _file_name")
    original, tag, shared, most = P.standin_bronze, P._input_tag, P.shared_dir, getattr(P, "FILE_RECORDS", 0)
    key, own = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        P.standin_bronze = lambda s, d: {n: table for n in P.BRONZE_TABLES}
        P._input_tag, P.shared_dir, P.FILE_RECORDS = (lambda s, d: "y"), (lambda s: tmpdir_path), 300
        got = P.persisted_bronze(spark, "d")["raw_stock_fundamentals"]()
        assert got.count() == 1000 and max(n for n, in got.groupBy("_metadata.file_path").count().select("count").collect()) == 300
    finally:
        P.standin_bronze, P._input_tag, P.shared_dir, P.FILE_RECORDS = original, tag, shared, most
        spark.conf.set(key, own)


def test_stored_columns_are_the_named_ones(spark):
    """A consumer of some columns stores these alone; other consumers still see the whole table."""
    from tidemark.plans.pipeline import Medallion
    m = Medallion({}, {})
    m._memo["stg_daily_prices"] = spark.sql("select 'A' as ticker, date'2024-01-02' as price_date, 1.5d as close_price, 7 as volume")
    got = m.stored_columns("stg_daily_prices", "ticker", "close_price")
    assert got.columns == ["ticker", "close_price"] and [tuple(r) for r in got.collect()] == [("A", 1.5)]
    assert len(got.inputFiles()) >= 1 and "volume" in m.ref("stg_daily_prices").columns
