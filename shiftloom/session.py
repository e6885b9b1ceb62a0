"""Session and scratch-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Settings the jobs rely on. On a cluster they belong in spark-defaults; sizes
# (shuffle partitions, split size) are left to the cluster's own values there.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", app: str = "shiftloom", **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SHIFTLOOM_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**JOB_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is named by the cluster. Where it is unset on a single
    machine, as in tests, a local folder is made; on a cluster that would put each
    executor's files on its own disk, so it is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        base = _local_folder()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="shiftloom-")
