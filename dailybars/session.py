"""Session and shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Correctness depends on these two, whatever the cluster's defaults are.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def local_session(app_name: str = "dailybars", cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session for tests and the bench. On a cluster the session comes from spark-submit."""
    partitions = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(shuffled_bytes: int, cores: int, partition_bytes: int = 192 * 1024**2) -> dict[str, str]:
    """Settings for a run that shuffles about ``shuffled_bytes``.

    Adaptive execution can join small shuffle partitions and split skewed ones, but the number it
    starts from is fixed when the plan is made; it has to be large enough that one partition fits
    into a task's share of memory. Fewer, larger scan splits keep the task count down.
    """
    partitions = max(2 * cores, -(-shuffled_bytes // partition_bytes))
    return {
        **REQUIRED_CONF,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024**2),
    }


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, or else below the warehouse; executors reach both."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/dailybars/{purpose}-{uuid.uuid4().hex}"
