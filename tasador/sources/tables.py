"""Parquet table access for a scale-factor directory."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy per-row work at least one partition per core.

    A source stored as a single row group scans as one task, so every
    projection on top of it (15 haversines, JSON parsing) would run on one
    core. When the scan has fewer partitions than the cluster's default
    parallelism, rows are redistributed round-robin; a normally partitioned
    source (thousands of splits at scale) is returned untouched, so no
    shuffle is added there. The check reads plan metadata only."""
    want = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df
