"""Sinks: Parquet tables (partitioned, overwrite = idempotent reload) and CSV."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tillsight.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's checkpoint folder (shared storage on a
    cluster), for jobs that need to write intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tillsight-scratch/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """Parquet write; ``mode='overwrite'`` makes a reload idempotent, ``append``
    adds a batch.  Facts are partitioned by ``year, month`` so date filters prune."""
    if partition_by:
        # AQE keeps each partition value together but splits a hot one into files
        w = df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by)
    else:
        w = df.write.mode(mode)
    w.parquet(path)


def roundtrip_parquet(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, "parquet")
    write_table(df, path, partition_by)
    back = spark.read.parquet(path)
    return back.select(*df.columns)


def roundtrip_csv(df: DataFrame, schema) -> DataFrame:
    from tillsight.sources.csv import read_csv, write_csv
    spark = df.sparkSession
    path = scratch_path(spark, "csv")
    write_csv(df, path)
    return read_csv(spark, path, schema)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written or collected in here deletes its shuffle files when it ends; else these
    stay on disk until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
