"""Session settings the jobs rely on, and the shared folder they write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Skewed shuffle joins are split, small shuffle partitions merged, at run time.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

_local_root: str | None = None


def local_session(cores: int | str = "*", **settings: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("roomledger")
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
    }
    for key, value in {**defaults, **SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can write to: the session's checkpoint directory.

    Only a local master may go without the setting: a cluster's executors do not
    share the driver's temporary folder.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="roomledger-")
    return _local_root


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created there yet."""
    return f"{shared_root(spark)}/roomledger/{label}-{uuid.uuid4().hex}"
