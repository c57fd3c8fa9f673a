"""Spark session construction and shared-storage helpers.

The library never hard-codes a master, a warehouse or a scratch path: on a
cluster those come from the submit configuration. ``build_session`` only fills
in defaults that are unset, so a cluster's own settings always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC calendar arithmetic (epoch -> date), ANSI
# semantics (guarded divisions and strict casts are written for it) and AQE
# (runtime coalescing, skew-join splitting and size-checked broadcast).
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Scratch folders of local sessions that name no shared one, by application.
_LOCAL_DIRS: dict[str, str] = {}


def build_session(app: str = "tidemark", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Return (or create) a session with the core settings applied.

    ``master`` and ``conf`` are only for local runs and tests; on a cluster
    leave them unset and let spark-submit decide.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CORE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in CORE_CONF.items():
        if not key.startswith("spark.ui."):
            spark.conf.set(key, value)
    return spark


def apply_core_conf(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the jobs rely on (UTC, ANSI, AQE) to a session
    created elsewhere. Runtime SQL settings only; nothing cluster-level."""
    for key, value in CORE_CONF.items():
        if not key.startswith("spark.ui."):
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Written tables and ``checkpoint()`` output go there so they survive the
    loss of an executor. Only a local session, whose driver is its only
    machine, gets a scratch folder when the setting is absent; on a cluster
    that is an error, since a folder of one machine is none to the others.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # The setting itself cannot be changed in a running session, so the folder is kept here.
        configured = _LOCAL_DIRS.get(sc.applicationId) or tempfile.mkdtemp(prefix="tidemark-ckpt-")
        _LOCAL_DIRS[sc.applicationId] = configured
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique table location under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str | None = None) -> SparkSession:
    """Local-mode session for tests and the benchmark."""
    conf = {"spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.driver.memory": driver_memory or os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"),
            "spark.sql.execution.arrow.pyspark.enabled": "true"}
    return build_session(master=f"local[{cores}]", conf=conf)
