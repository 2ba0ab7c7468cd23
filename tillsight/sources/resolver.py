"""Where a flat table comes from: a database if one is named and answers, else files.

The order is fixed — database, Parquet, CSV — and a source that was named but cannot be read is
reported, never passed over in silence: the error of the last resort lists them all, and a
source that steps in is returned with the reasons why those before it did not.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillsight.sources.csv import read_csv
from tillsight.sources.jdbc import read_jdbc


class SourceError(RuntimeError):
    """No named source could be read."""


@dataclass(frozen=True)
class Resolved:
    table: DataFrame
    kind: str                # "database", "parquet" or "csv"
    skipped: dict[str, str]  # kind → why it was not used


def resolve(spark: SparkSession, name: str, *, url: str | None = None,
            parquet: str | None = None, csv: str | None = None,
            schema: StructType | None = None, fallback: bool = True) -> Resolved:
    """Table ``name`` from the first source that can be read.

    ``url``: JDBC address; ``parquet``, ``csv``: folders that hold ``<name>`` (``schema`` is
    needed for CSV).  ``fallback=False``: a named database must answer.  Reading stays lazy:
    a source is tried by asking for its schema (a database also opens a connection for that)."""
    tries = {}
    if url:
        tries["database"] = lambda: read_jdbc(spark, url, name)
    if parquet:
        tries["parquet"] = lambda: spark.read.parquet(f"{parquet}/{name}")
    if csv:
        if schema is None:
            raise ValueError("a CSV source needs a schema")
        tries["csv"] = lambda: read_csv(spark, f"{csv}/{name}", schema)
    skipped: dict[str, str] = {}
    for kind, read in tries.items():
        try:
            table = read()
            table.schema  # noqa: B018 - analyses the plan: a missing source fails here
            return Resolved(table, kind, skipped)
        except (PySparkException, Py4JError) as e:
            skipped[kind] = str(e).splitlines()[0]
            if kind == "database" and not fallback:
                break
    told = "; ".join(f"{kind}: {why}" for kind, why in skipped.items()) or "no source named"
    raise SourceError(f"table {name!r} cannot be read ({told})")
