"""Spark session settings and the shared folder of a cluster."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on. A cluster submits with its own master, memory and checkpoint folder.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = 8, memory: str = "12g", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rolefit")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.checkpoint.dir", os.path.join(tempfile.gettempdir(), "rolefit"))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor of a cluster sees.

    Where the setting is missing, the session's warehouse takes its place: executors share it as well. The path names its
    file system, so that other libraries in the tasks write to the same one as Spark.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
