"""Spark session helpers.

The library never creates machine-local scratch space on a cluster: lineage is
cut with ``DataFrame.checkpoint()`` into the shared folder the cluster names in
``spark.checkpoint.dir``.  Only local runs (tests, bench) fall back to a fresh
``mktemp`` folder, and only when that setting is unset.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every session of ours relies on.  Ratings carry epoch seconds and the
# event fixture has TIMESTAMP_NTZ columns, so the session time zone is pinned.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows may hold long texts or whole vectors: small batches bound a Python worker's memory
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "itemrank", driver_memory: str = "16g") -> SparkSession:
    """A local session for tests and benchmarks (not used on a cluster)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory)
               .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
               # checkpoint files of DataFrames that are garbage-collected are removed
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings the operators assume to an existing session."""
    for k, v in BASE_CONF.items():
        if k == "spark.ui.enabled":
            continue  # static; only meaningful at launch
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked conf on a managed cluster
            pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns spark.checkpoint.dir
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        # Unset is only right for a local run (tests, bench): elsewhere a folder
        # of one machine would be lost to the others.
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="itemrank-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def written(df, name: str):
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back (cuts the lineage, columnar)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
