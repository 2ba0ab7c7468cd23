"""Readers for Parquet table folders (one ``<name>.parquet`` per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Lazy scan of ``folder/name.parquet``; column pruning and filters reach the
    Parquet reader through Catalyst."""
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def scan_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Whole-table read (``SELECT * FROM t``)."""
    return read_table(spark, folder, name)
