"""Versioned tables: a load of several tables becomes visible at once, or not at all.

Data files are written first, to folders that no reader knows::

    <root>/<table>/batch=<id>/[year=…/]part-….parquet
    <root>/_manifest/v=<n>/part-….parquet      one row per table and batch

A version is its manifest: the one file that names the batches of every table.  It is written
last, by a single task, and appears when Spark's committer renames it.  A load that stops before
has changed nothing; its folders are never read.  Two loads that start from one version write one
manifest path, and the second fails (``errorifexists``) instead of overwriting the first.

Readers take the newest version, or any earlier one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.sources.sinks import write_table

_MANIFEST = "name string, batch string, columns string, version long"


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def version(self) -> int:
        """Number of the newest version; 0 before the first load."""
        newest = self._manifests().agg(F.max("version")).first()[0]
        return newest or 0

    def tables(self, version: int | None = None) -> dict[str, DataFrame]:
        """Every table of a version (default: the newest), read lazily."""
        batches: dict[str, list[str]] = {}
        schemas: dict[str, T.StructType] = {}
        for e in self._entries(self.version() if version is None else version):
            batches.setdefault(e["name"], []).append(e["batch"])
            schemas[e["name"]] = T.StructType.fromJson(json.loads(e["columns"]))
        return {name: self._read(name, batches[name], schemas[name]) for name in batches}

    def replace(self, tables: Mapping[str, DataFrame],
                partition_by: Mapping[str, Sequence[str]] | None = None) -> int:
        """A version of exactly these tables (truncate and reload); its number."""
        base = self.version()
        return self._commit(base, self._write(tables, partition_by))

    def append(self, tables: Mapping[str, DataFrame],
               partition_by: Mapping[str, Sequence[str]] | None = None) -> int:
        """A version that adds these rows to the newest one's tables; its number."""
        base = self.version()
        old = [tuple(e[c] for c in ("name", "batch", "columns")) for e in self._entries(base)]
        return self._commit(base, old + self._write(tables, partition_by))

    def _manifests(self) -> DataFrame:
        try:
            return self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/_manifest")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], _MANIFEST)

    def _entries(self, version: int) -> list:
        # one row per table and batch of that version
        return self._manifests().filter(F.col("version") == version) \
            .orderBy("name", "batch").collect() if version else []

    def _read(self, name: str, batches: list[str], schema: T.StructType) -> DataFrame:
        base = f"{self.root}/{name}"
        with_batch = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
        return self.spark.read.option("basePath", base).schema(with_batch) \
            .parquet(*[f"{base}/batch={b}" for b in batches]).select(*schema.fieldNames())

    def _write(self, tables: Mapping[str, DataFrame], partition_by) -> list[tuple]:
        batch = uuid.uuid4().hex
        entries = []
        for name, df in tables.items():
            parts = list((partition_by or {}).get(name, [])) or None
            write_table(df, f"{self.root}/{name}/batch={batch}", parts, mode="errorifexists")
            entries.append((name, batch, df.schema.json()))
        return entries

    def _commit(self, base: int, entries: list[tuple]) -> int:
        rows = [(*e, base + 1) for e in entries]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write \
            .mode("errorifexists").parquet(f"{self.root}/_manifest/v={base + 1}")
        return base + 1
