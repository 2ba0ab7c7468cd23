"""Shared helpers of the training-data operators: stored intermediates and words.

A *word* is a maximal run of bytes other than the ASCII blanks ``\\x20 \\x09-\\x0D``.
``bytes.split()`` splits on exactly these blanks and ``bytes.lower()`` lowers
exactly A-Z, so Python tasks work on UTF-8 bytes; :func:`words` is the same rule
as a Spark expression.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.sources.sinks import scratch_path

BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship(spark) -> None:
    """Make this package importable in Python workers (once per application), however
    the driver found it: Spark serves the archive to all executors.  Call it
    before building a plan with Python functions.  Where the session has Spark's default,
    Arrow batches are also cut to ``BATCH_ROWS`` rows, as rows hold whole texts."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="tillsight-code-"), "tillsight.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: a lineage
    cut that survives lost executors and gives the planner real sizes."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_tag(text: Column | str) -> Column:
    """64-bit hash of a text (null: empty), to tell rows of one id apart.  Rows with one id
    and one text are copies, for which any decision on the text is the same."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text,
                                 F.lit(b"")))


def words(text: Column) -> Column:
    """The words of a text as an array (null or blank text: empty array)."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(F.length(inner) == 0, F.array().cast("array<string>")) \
        .otherwise(F.split(inner, BLANK_RUN))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    """64-bit hash per word."""
    return np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))


def mix64(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (a bijection, so it adds no collisions)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of every run of ``n`` consecutive word hashes."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out = mix64(out + h[k:len(h) - n + 1 + k] + np.uint64(k + 1))
    return out
