"""Tables kept between the steps of one operator, in the folder that all executors share."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import tidemark

from tidemark.session import apply_core_conf, scratch_path


#: Bytes of rows that go to a Python worker at once (a longer row goes alone).
BATCH_BYTES = "4m"
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers where their import path may lack it:
    where it was neither submitted nor stands in the working folder or on PYTHONPATH."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(tidemark.__file__)))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or root in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] \
            or not os.path.isdir(root):
        return
    base = os.path.join(tempfile.mkdtemp(prefix="tidemark-package-"), "tidemark")
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", root, "tidemark"))
    _SHIPPED.add(app)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_core_conf(spark)
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    It cuts the lineage: a lost executor costs the steps after the table only.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, function: Callable, schema: StructType | str) -> DataFrame:
    """``mapInArrow`` in batches of bounded bytes, so that long texts do not add up in a worker.

    The bound is a setting of the session; it changes how rows are sent, not what comes out.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(function, schema)


def carried(df: DataFrame, **named: Column) -> DataFrame:
    """All columns of ``df`` packed into one struct ``row`` beside the columns ``named``,
    so that no column of the caller can clash with a name an operator uses."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     *[c.alias(n) for n, c in named.items()])


def row_hash(df: DataFrame) -> Column:
    """Hash of a carried row of ``df``; maps and variants have none."""
    if all("map<" not in kind and "variant" not in kind for _, kind in df.dtypes):
        return F.xxhash64("row")
    return F.xxhash64(*[F.col("row").getField(c) for c, kind in df.dtypes
                        if "map<" not in kind and "variant" not in kind])


def unpacked(df: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """The columns of a struct made by ``carried``, some of them replaced."""
    return df.select(*[replaced.get(c, F.col("row").getField(c)).alias(c) for c in columns])
