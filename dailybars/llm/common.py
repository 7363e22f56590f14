"""Shared small helpers: work folders, stored intermediate tables, reading inputs."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, the folder that the whole cluster shares.

    Where that is unset (tests), the warehouse folder is used, which is shared as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write df once and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_held: dict[str, Callable[[], None]] = {}


def holds(owner: str, clear: Callable[[], None]) -> None:
    """Say how to empty what a module keeps in a Python worker between tasks."""
    _held[owner] = clear


def release_others(owner: str) -> None:
    """Empty what other modules keep in this Python worker, which serves one stage after another."""
    for name, clear in _held.items():
        if name != owner:
            clear()


def on_workers(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package from the same place."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *filter(None, paths)])


def texts_of(docs: DataFrame) -> DataFrame:
    """The two columns that every operator reads; others cannot clash. A null text is empty."""
    on_workers(docs.sparkSession)
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
