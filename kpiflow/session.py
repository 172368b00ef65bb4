"""Session helpers: UTC clock, checkpoint folder, sane local defaults."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Session settings that results depend on.

    Event times are UTC (window bounds and partition columns), and of a key that
    comes twice in a JSON object the last value counts.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get("spark.sql.variant.allowDuplicateKeys", "false") != "true":
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised intermediates.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system). Only when it is unset on a local master -- tests -- a scratch
    folder is created and registered; on a cluster that would be a folder of
    one machine, so it is an error there.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="kpiflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "kpiflow") -> SparkSession:
    """Local session used by tests and the bench (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("KPIFLOW_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_utc(spark)
