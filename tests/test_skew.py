"""A key holding a third of all rows: results stay exact and whole."""

from pyspark.sql import functions as F

from tidemark.operators import relational as R
from tidemark.operators import windows as W


def _skewed(spark, n=30000):
    # key 'HOT' gets every third row; the rest spread over 1000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("K"), (F.col("id") % 1000).cast("string")))
        .alias("k"),
        (F.col("id") % 50).cast("int").alias("day"),
        F.col("id").alias("seq"),
        (F.col("id") % 97 - 48).cast("double").alias("v"))


def test_dedup_hot_key_exact(spark):
    df = _skewed(spark)
    out = W.dedup_latest(df, ["k", "day"], [F.col("seq").desc_nulls_first()])
    want = df.groupBy("k", "day").agg(F.max("seq").alias("seq"))
    assert out.count() == want.count()
    assert out.select("k", "day", "seq").exceptAll(want).count() == 0
    assert out.filter("k = 'HOT'").count() == df.filter("k = 'HOT'").select("day").distinct().count()


def test_share_and_breadth_hot_day(spark):
    df = _skewed(spark).withColumn("day", F.when(F.col("k") == "HOT", F.lit(0)).otherwise(F.col("day")))
    sh = W.share_of_total(df.withColumn("w", F.abs("v") + 1), "w", "day")
    sums = sh.groupBy("day").agg(F.sum("share_pct").alias("s")).collect()
    assert all(abs(r.s - 100) < 1e-6 for r in sums)
    b = {r.day: (r.advancers, r.decliners) for r in R.breadth(df, "v", "day").collect()}
    want = {r.day: (r.a, r.d) for r in df.groupBy("day").agg(
        F.sum((F.col("v") > 0).cast("int")).alias("a"), F.sum((F.col("v") < 0).cast("int")).alias("d")).collect()}
    assert b == want
    assert sh.count() == df.count()
