"""Large JSON files read by many tasks: the objects of one top-level array, or one after another.

Spark's text reader cuts such a file at closing braces, in byte ranges like any text. Whether a
brace is markup or part of a string depends on all quotes before it, so each range is summed up for
both cases (inside a string or not at its start); the sums are put in order per file, and with what
each range starts in, its fragments are numbered by the object they belong to and put together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

META = ["file_path", "file_name", "file_modification_time", "file_size"]


def _fragments(spark: SparkSession, paths: Sequence[str], glob: str, where: Column | None) -> DataFrame:
    """What stands between closing braces, with its order, quotes and opening braces.

    ``opens0`` counts those outside of strings if the fragment starts outside, ``opens1`` if inside.
    """
    rows = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(list(paths))
    if where is not None:
        rows = rows.filter(where)
    meta = [F.col(f"_metadata.{c}").alias(c) for c in META]
    rows = rows.select("value", *meta, F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("seq"))
    # A backslash takes the character after it; no escape spans a closing brace.
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')

    def opens(inside: int) -> Column:
        return F.length(F.regexp_replace(F.array_join(F.filter("parts", lambda x, i: i % 2 == inside), ""), r"[^{]", ""))

    rows = rows.withColumn("parts", parts)
    return rows.select("value", *META, "block", "seq", (F.size("parts") - 1).alias("quotes"),
                       opens(0).alias("opens0"), opens(1).alias("opens1"))


def _range() -> WindowSpec:
    return Window.partitionBy("file_path", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _steps(rows: DataFrame, inside: Column, tag: str) -> DataFrame:
    """``depth``: change of depth up to each fragment's end, from ``inside`` (1 in a string) at the range's
    start; ``closed``: whether the brace that ends it is markup."""
    rows = rows.withColumn("_q", F.sum("quotes").over(_range()))
    before, after = (F.col("_q") - F.col("quotes") + inside) % 2, (F.col("_q") + inside) % 2
    own = F.when(before == 0, F.col("opens0")).otherwise(F.col("opens1")) - F.when(after == 0, 1).otherwise(0)
    return rows.select("*", own.alias("_own"), (after == 0).alias(f"closed{tag}")) \
        .withColumn(f"depth{tag}", F.sum("_own").over(_range())).drop("_q", "_own")


def _carried(rows: DataFrame) -> DataFrame:
    """(file_path, bytes, starts): what each range of a file starts in, in order."""
    rows = _steps(_steps(rows, F.lit(0), "0"), F.lit(1), "1")
    kinds = rows.groupBy("file_path", "block", "depth0", "depth1", "closed0", "closed1").agg(
        F.count("*").alias("n"), F.sum("quotes").alias("quotes"), F.sum(F.octet_length("value") + 1).alias("bytes"),
        F.max(F.struct("seq", F.col("depth0").alias("net0"), F.col("depth1").alias("net1"))).alias("last"))
    ranges = kinds.groupBy("file_path", "block").agg(
        (F.sum("quotes") % 2).alias("odd"), F.sum("bytes").alias("bytes"), F.max("last").alias("last"),
        F.collect_list(F.struct("depth0", "depth1", "closed0", "closed1", "n")).alias("kinds"))
    ranges = ranges.groupBy("file_path").agg(F.sum("bytes").alias("bytes"), F.array_sort(F.collect_list(F.struct(
        "block", "odd", F.col("last.net0").alias("net0"), F.col("last.net1").alias("net1"), "kinds"))).alias("ranges"))
    start = F.struct(F.lit(0).cast("long").alias("inside"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("objects"),
                     F.array().cast("array<struct<block:bigint,inside:bigint,depth:bigint,objects:bigint>>").alias("starts"))

    def on(at: Column, r: Column) -> Column:
        ended = F.aggregate(F.filter(r["kinds"], lambda k: F.when(at["inside"] == 0, k["closed0"] & (k["depth0"] == -at["depth"]))
                                     .otherwise(k["closed1"] & (k["depth1"] == -at["depth"]))),
                            F.lit(0).cast("long"), lambda n, k: n + k["n"])
        return F.struct(((at["inside"] + r["odd"]) % 2).alias("inside"),
                        (at["depth"] + F.when(at["inside"] == 0, r["net0"]).otherwise(r["net1"])).alias("depth"),
                        (at["objects"] + ended).alias("objects"),
                        F.concat(at["starts"], F.array(F.struct(r["block"].alias("block"), at["inside"].alias("inside"),
                                                                at["depth"].alias("depth"), at["objects"].alias("objects")))).alias("starts"))

    return ranges.select("file_path", "bytes", F.aggregate("ranges", start, on)["starts"].alias("starts"))


def scan_objects(spark: SparkSession, path: str | Sequence[str], fail_fast: bool = True, glob: str = "*.json",
                 where: Column | None = None) -> DataFrame:
    """raw_data and file metadata of every object of files that hold one array of objects, or objects one
    after another; ``where`` is a condition on ``_metadata``.

    Files are read in ranges of ``spark.sql.files.maxPartitionBytes`` each, twice. What is left of a file
    behind its last whole object is one malformed record, unless it is the end of an array: it fails the
    scan (``fail_fast``) or gives NULL. Elements that are no objects are malformed, too.
    """
    paths = [path] if isinstance(path, str) else list(path)
    rows = _fragments(spark, paths, glob, where)
    starts = _carried(rows).select(F.col("file_path").alias("of"), "bytes", F.explode("starts").alias("at"))
    rows = rows.join(starts, (F.col("file_path") == F.col("of")) & (F.col("block") == F.col("at.block")))
    rows = _steps(rows, F.col("at.inside"), "")
    # The reader adds a byte for every fragment; one too many tells that the last one had no brace.
    last = F.max(F.struct("block", "seq")).over(Window.partitionBy("file_path"))
    cut = (F.col("bytes") > F.col("file_size")) & (last == F.struct("block", "seq"))
    rows = rows.withColumn("ends", F.col("closed") & (F.col("depth") + F.col("at.depth") == 0))
    rows = rows.withColumn("object", F.col("at.objects") + F.sum(F.col("ends").cast("long")).over(_range()) - F.col("ends").cast("long"))
    rows = rows.withColumn("whole", F.col("ends") & ~cut)
    objects = rows.groupBy("file_path", "object").agg(
        *[F.first(c).alias(c) for c in META[1:]], F.max("whole").alias("whole"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "seq", "value"))), lambda x: x["value"]), "}").alias("text"))
    text = F.concat(F.regexp_replace("text", r"^[\s,\[]+", ""), F.when(F.col("whole"), "}").otherwise(""))
    objects = objects.withColumn("text", text).filter(F.col("whole") | ~F.col("text").rlike(r"^[\s\]]*$"))
    # A rest is given to the parser with a brace that it lacks, so that it can not pass for an object.
    parse = F.parse_json if fail_fast else F.try_parse_json
    return objects.select(parse(F.when(F.col("whole"), F.col("text")).otherwise(F.concat(F.lit("{"), F.col("text")))).alias("raw_data"), *META)
