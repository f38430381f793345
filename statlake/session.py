"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "12g",
                  **conf: str) -> SparkSession:
    """A single-JVM session; on a cluster the caller brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("statlake")
        .config("spark.driver.memory", os.environ.get("STATLAKE_DRIVER_MEMORY", memory))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        # Splits of a small input for every core; larger inputs are split by size anyway.
        .config("spark.sql.files.maxPartitionBytes", "16m")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine; on a cluster
    an unset folder is an error, because executors could not read it back.
    """
    root = (
        spark.conf.get(CHECKPOINT_CONF, None)
        or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
        or spark.sparkContext.getCheckpointDir()
    )
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="statlake-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared scratch root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def new_run_id() -> str:
    """A short run id; jobs take it as an argument, so a rerun can pass the old one."""
    return uuid.uuid4().hex[:12]


def process_date(today: date) -> str:
    """The day a daily run works on: yesterday, as ``YYYYMMDD``."""
    return (today - timedelta(days=1)).strftime("%Y%m%d")
