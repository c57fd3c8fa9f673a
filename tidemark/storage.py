"""Listing of tables through Hadoop's file systems, so that any store Spark reads will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()), where


def listing(spark: SparkSession, path: str) -> list[tuple[str, str, bool, int, int]] | None:
    """(name, path, is folder, bytes, modified ms) of a folder's entries by name; None if it is not there.

    Any other failure is raised: an unreadable folder is not an absent one.
    """
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return None
    found = [(s.getPath().getName(), s.getPath().toString(), s.isDirectory(), s.getLen(), s.getModificationTime())
             for s in fs.listStatus(where)]
    return sorted(found)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` ended: its committer leaves ``_SUCCESS`` last."""
    return any(name == "_SUCCESS" for name, *_ in listing(spark, path) or [])


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a table of one or more writes stands at ``path``."""
    return any(not name.startswith(("_", ".")) for name, *_ in listing(spark, path) or [])


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)
