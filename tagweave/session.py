"""Session helpers for tests, the bench and local use.

Library code never changes session settings it did not create; the helpers here
are for entry points that own the session.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "tagweave",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session with the settings the library is tuned for.

    AQE re-plans joins from runtime sizes, coalesces small shuffle partitions and
    splits skewed ones; the UI stays off (no server).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only where none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only a local session that has none gets a fresh temp folder; on a cluster, where
    executors could not see it, a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    target = configured or tempfile.mkdtemp(prefix="tagweave-ckpt-")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target
