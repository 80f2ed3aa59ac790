"""Scans of the driver's parquet tables (one file or folder per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``spark.read.parquet`` of ``<sf_dir>/<name>.parquet``; filters and projections applied
    later are pushed into this scan by Catalyst."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
