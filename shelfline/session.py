"""Session helpers: a sane local session for tests/bench, and the shared
work folder that every written intermediate lives in.

On a cluster the work folder is the shared ``spark.checkpoint.dir`` the
cluster names; we never invent a machine-local folder there. Only when the
session has none (local tests, bench) do we create one under the system temp
folder and register it as the checkpoint dir.
"""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "shelfline") -> SparkSession:
    """Session for tests and the bench. Production code never calls this: it
    receives the cluster's session and only reads its settings."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _configured_dir(spark: SparkSession) -> str | None:
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        return None


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; set one only where unset."""
    path = _configured_dir(spark)
    if path:
        return path.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="shelfline-ckpt-")
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:
        pass
    spark.conf.set("spark.checkpoint.dir", path)
    return _configured_dir(spark).rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared work folder for one run."""
    return os.path.join(shared_dir(spark), "shelfline", f"{name}-{uuid.uuid4().hex[:12]}")


def release(spark: SparkSession, rounds: int = 3) -> None:
    """Have Spark's cleaner delete the shuffle files of plans that nobody holds any
    more: it follows the collection of garbage, which is asked for here, between
    two steps that each shuffle as much as they read. What Python lets go of, the
    JVM can collect only afterwards, hence the rounds."""
    for _ in range(rounds):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)
