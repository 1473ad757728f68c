"""Driver tables: one parquet file per table under a scale-factor folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; column pruning and filters reach the scan via Catalyst."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``ts`` as a session-zone TIMESTAMP.

    The files store wall-clock TIMESTAMP_NTZ; watermarks and time windows on
    streams need TIMESTAMP, so it is cast once here (session zone is UTC).
    """
    return read_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
