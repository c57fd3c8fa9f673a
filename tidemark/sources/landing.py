"""Landing-zone JSON -> append-only Bronze tables with load metadata.

Landing files hold one top-level JSON array each (``<source>/<date>.json``).
Bronze rows are ``raw_data VARIANT, source, _loaded_at TIMESTAMP_NTZ,
_file_name`` (plus the file's modification time and size when ingested from
files, which make Bronze its own load ledger) and are only ever appended.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.arrays import scan_objects
from tidemark.storage import has_data, listing

BRONZE_COLUMNS = ["raw_data", "source", "_loaded_at", "_file_name"]
#: Files that Spark's writers made hold one JSON object per line.
LINES_PREFIX = "part-"
#: Larger files of objects, in an array or one after another, are read by many tasks.
SPLIT_BYTES = 64 << 20
#: Files that one day's records are written to at most.
FILES_PER_DAY = 8
LEDGER_KEYS = ["file_path", "file_modification_time", "file_size"]

# Landing sub-folder -> Bronze table.
SUBDIR_TO_TABLE = {
    "stock-prices": "raw_stock_prices",
    "stock-fundamentals": "raw_stock_fundamentals",
    "fred-series": "raw_fred_series",
    "crypto-prices": "raw_crypto_prices",
    "fear-greed": "raw_fear_greed",
}


def load_time() -> Column:
    return F.current_timestamp().cast("timestamp_ntz")


def to_bronze(records: DataFrame, source: str, loaded_at: Column | None = None,
              file_name: Column | None = None, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Wrap typed records into the Bronze shape.

    Every column except ``exclude`` becomes a field of the VARIANT payload.
    """
    fields = [c for c in records.columns if c not in exclude]
    return records.select(
        F.to_variant_object(F.struct(*fields)).alias("raw_data"),
        F.lit(source).alias("source"),
        (loaded_at if loaded_at is not None else load_time()).cast("timestamp_ntz").alias("_loaded_at"),
        (file_name if file_name is not None else F.lit(None).cast("string")).alias("_file_name"))


def landing_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, modification time and size of every ``*.json`` file, contents unread."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.json").load(path))
    return files.select(F.col("path").alias("file_path"), F.col("modificationTime").alias("file_modification_time"),
                        F.col("length").alias("file_size"))


def scan_landing(spark: SparkSession, path: str | Sequence[str], fail_fast: bool = True,
                 where: Column | None = None) -> DataFrame:
    """Scan landing files; one row per array element, with file metadata.

    A file that Spark wrote is read line by line, so it is split like any text; any other of up
    to ``SPLIT_BYTES`` is read whole and its top-level array exploded (an empty array yields no
    rows; one JSON object per line is accepted too), and a larger one in byte ranges by
    ``arrays.scan_objects``. Sub-folders are listed recursively and only
    ``*.json`` files are taken. A malformed record fails the scan (``fail_fast``) or
    contributes no rows (``bad_records`` counts those). ``where`` is a condition on ``_metadata``
    alone: Spark tests it on the listing, and files that fail it are not opened.
    """
    rows = _parsed(spark, path, fail_fast, where=where)
    return rows.filter(F.col("raw_data").isNotNull())


def bad_records(spark: SparkSession, path: str | Sequence[str], glob: str = "*.json") -> DataFrame:
    """Malformed records per file (a malformed array file is one): file_path, n_bad."""
    return (_parsed(spark, path, False, glob).filter(F.col("raw_data").isNull())
            .groupBy("file_path").agg(F.count("*").alias("n_bad")))


def _parsed(spark: SparkSession, path: str | Sequence[str], fail_fast: bool, glob: str = "*.json",
            where: Column | None = None) -> DataFrame:
    """Records of all files; NULL ``raw_data`` stands for a malformed one (not ``fail_fast``)."""
    paths = [path] if isinstance(path, str) else list(path)
    mode = "FAILFAST" if fail_fast else "PERMISSIVE"
    parse = F.parse_json if fail_fast else F.try_parse_json
    meta = [F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_modification_time").alias("file_modification_time"),
            F.col("_metadata.file_size").alias("file_size")]

    def text(whole: bool) -> DataFrame:
        rows = (spark.read.option("recursiveFileLookup", True)
                .option("pathGlobFilter", glob).text(paths, wholetext=whole))
        lines = F.col("_metadata.file_name").startswith(LINES_PREFIX)
        return rows.filter(taken & (~lines & (F.col("_metadata.file_size") <= SPLIT_BYTES) if whole else lines))

    taken = where if where is not None else F.lit(True)
    filled = F.length(F.trim(F.col("value"))) > 0
    # Only lines of Spark's own files are parsed: a filter on the result is tested before the one on the name.
    line = F.when(F.col("_metadata.file_name").startswith(LINES_PREFIX), F.col("value"))
    by_line = text(False).filter(filled).select(parse(line).alias("raw_data"), *meta)
    lines = F.filter(F.split(F.col("value"), "\n"), lambda s: F.length(F.trim(s)) > 0)
    arr = F.when(F.regexp_replace("value", r"^\s+", "").startswith("["), F.coalesce(
        F.from_json(F.col("value"), "array<variant>", {"mode": mode}),
        F.array(F.lit(None).cast("variant")))) \
        .otherwise(F.transform(lines, lambda s: parse(s)))
    large = scan_objects(spark, paths, fail_fast, glob, taken & ~F.col("_metadata.file_name").startswith(LINES_PREFIX)
                         & (F.col("_metadata.file_size") > SPLIT_BYTES))
    return text(True).select(F.explode(arr).alias("raw_data"), *meta).unionByName(by_line).unionByName(large)


def read_landing(spark: SparkSession, path: str | Sequence[str], source: str, fail_fast: bool = True,
                 where: Column | None = None) -> DataFrame:
    """Landing files -> Bronze rows stamped with source, load time and file.

    ``_file_name`` holds the file's full path: file names alone repeat across
    the per-day folders of a landing zone.
    """
    scan = scan_landing(spark, path, fail_fast, where)
    return scan.select("raw_data", F.lit(source).alias("source"), load_time().alias("_loaded_at"),
                       F.col("file_path").alias("_file_name"), *LEDGER_KEYS)


def new_files_only(scanned: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Drop rows of files already recorded in the load ledger.

    A file counts as loaded when its path, modification time and size all
    match, so a re-delivered file with new content is loaded again.
    """
    if ledger is None:
        return scanned
    return scanned.join(ledger.select(*LEDGER_KEYS).distinct(), LEDGER_KEYS, "left_anti")


#: A landing file is named for a day: ``.../2024-01-31.json`` or ``.../date=2024-01-31/part-...``.
FILE_DAY = r"(?:date=|/)(\d{4}-\d{2}-\d{2})(?:/[^/]*|[^/]*)$"


def file_date(path: str) -> str | None:
    """The day a landing file is named for; None for no day."""
    found = re.search(FILE_DAY, path)
    return found[1] if found else None


#: Files older than the newest one loaded that are named to Spark at a time.
LATE_FILES = 1000


def _in_days(path: Column, start: str | None, end: str | None) -> Column:
    """Whether a file's day is in the bounds (inclusive); one named for no day is in none."""
    day, found = F.regexp_extract(path, FILE_DAY, 1), F.lit(True)
    if start or end:
        found = day != ""
        found = found & (day >= start) if start else found
        found = found & (day <= end) if end else found
    return found


def ingest(spark: SparkSession, landing_path: str, source: str, bronze_path: str,
           start: str | None = None, end: str | None = None) -> DataFrame:
    """Append new landing files to a Bronze table; return this run's per-file counts.

    Bronze's own file columns (path, modification time, size) are the load ledger. Files newer than
    the newest one loaded are taken by one condition on their listing, so no list of them passes
    through here; the others are held against the ledger, and the few that came late (older, but not
    loaded) are read by name, at most ``LATE_FILES`` at a time. ``start`` and ``end`` bound the days of
    the files taken (inclusive; a file named for no day is outside any bound). A re-run appends
    nothing. Each file's rows come with one append, so an interrupted run leaves either all of
    a file's rows or none.
    """
    counts = "file_path string, file_modification_time timestamp, file_size long, rows_loaded long"
    if listing(spark, landing_path) is None:
        return spark.createDataFrame([], counts)

    def append(path: str | Sequence[str], where: Column | None) -> None:
        rows = read_landing(spark, path, source, where=where)
        rows.select(*BRONZE_COLUMNS, *LEDGER_KEYS).write.mode("append").parquet(bronze_path)

    ledger = spark.read.parquet(bronze_path).select(*LEDGER_KEYS) if has_data(spark, bronze_path) else None
    mark = None if ledger is None else ledger.agg(F.max("file_modification_time")).first()[0]
    files = landing_files(spark, landing_path).filter(_in_days(F.col("file_path"), start, end))
    newer = F.lit(True) if mark is None else F.col("_metadata.file_modification_time") > F.lit(mark)
    late = [] if mark is None else new_files_only(files.filter(F.col("file_modification_time") <= F.lit(mark)), ledger)
    if mark is None or not files.filter(F.col("file_modification_time") > F.lit(mark)).isEmpty():
        append(landing_path, newer & _in_days(F.col("_metadata.file_path"), start, end))
    while late:  # a pass leaves its files in the ledger
        named = [r["file_path"] for r in late.orderBy("file_path").limit(LATE_FILES).collect()]
        if not named:
            break
        append(named, None)
        if len(named) < LATE_FILES:
            break
        late = new_files_only(files.filter((F.col("file_modification_time") <= F.lit(mark)) & (F.col("file_path") > named[-1])), ledger)
    if not has_data(spark, bronze_path):
        return spark.createDataFrame([], counts)
    loaded = new_files_only(spark.read.parquet(bronze_path).select(*LEDGER_KEYS), ledger)
    return loaded.groupBy(*LEDGER_KEYS).agg(F.count(F.lit(1)).alias("rows_loaded"))


def load_counts(bronze: Mapping[str, DataFrame]) -> DataFrame:
    """Files and rows per Bronze table, plus a total row."""
    parts = [df.agg(F.count_distinct("_file_name").alias("files"),
                    F.count(F.lit(1)).alias("rows_loaded")).select(
                        F.lit(name).alias("table_name"), "files", "rows_loaded")
             for name, df in bronze.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    total = out.agg(F.lit("TOTAL").alias("table_name"), F.sum("files").alias("files"),
                    F.sum("rows_loaded").alias("rows_loaded"))
    return out.unionByName(total)


def write_landing(records: DataFrame, root: str, date_col: str = "date",
                  run_date: str | None = None) -> None:
    """Write records as JSON under ``root/<date_col>=<day>/``.

    Dynamic partition overwrite: re-running a day replaces that day only.
    When there are no records and ``run_date`` is given, that day still gets
    an artifact (an empty JSON file, read back as zero rows) and a warning is
    issued, so an empty extract is visible rather than silently missing.
    """
    if run_date is not None and records.isEmpty():
        warnings.warn(f"no records for {run_date}; writing an empty landing file", stacklevel=2)
        (records.drop(date_col).coalesce(1).write.mode("overwrite")
         .json(f"{root.rstrip('/')}/{date_col}={run_date}"))
        return
    # A day's records meet in a few tasks, so that a day is a few files and not one per task.
    (records.repartition(F.col(date_col), F.pmod(F.xxhash64(*records.columns), F.lit(FILES_PER_DAY)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col).json(root))
