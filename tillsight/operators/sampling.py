"""Seeded fixed-size sampling by bottom-k selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Hexadecimal digits of the row digest read per pass (4,096 cells).
DIGITS = 3
#: A cut-off cell of up to so many rows is sorted instead of being cut again.
SMALL = 1000


def row_digest(df: DataFrame, seed: int, columns: list[str]) -> Column:
    """MD5 of the seed and the columns' texts (32 hexadecimal digits).  Nulls are written as
    ``-`` and strings with their length, so different rows have different texts."""
    strings = {f.name for f in df.schema if isinstance(f.dataType, StringType)}

    def part(c: str) -> Column:
        text = F.col(f"`{c}`").cast("string")
        if c in strings:
            text = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        return F.coalesce(text, F.lit("-"))
    return F.md5(F.concat_ws(",", F.lit(str(seed)), *map(part, columns)).cast("binary"))


def sample_fixed_n(df: DataFrame, n: int, seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the same ones on every run and layout.

    Kept are the ``n`` rows with the smallest digests of ``key`` (default: all columns), ties
    by the digest of all columns.  Passes count rows per leading digits until the cell that
    holds the n-th row is small; the digests of that cell alone give the cut-off, and the
    sample is one filter, whatever ``n`` is: nothing is sorted and no row is shuffled.  Rows
    whose digests agree to the last digit are copies of one another: if the cut-off falls
    among copies, one of them is repeated as often as is missing.
    """
    if n <= 0:
        return df.limit(0)
    digest = row_digest(df, seed, key or df.columns)
    if key:
        digest = F.concat(digest, row_digest(df, seed, df.columns))
    length = 64 if key else 32
    prefix, missing, held = "", n, None
    while held is None or (held > SMALL and len(prefix) < length):
        cell = df.filter(digest.startswith(prefix)) if prefix else df
        width = min(DIGITS, length - len(prefix))
        counts = cell.groupBy(F.substring(digest, len(prefix) + 1, width).alias("c")).count()
        counts = sorted(counts.collect())
        if not prefix and sum(c["count"] for c in counts) <= n:
            return df
        for c in counts:
            held = c["count"]
            if held >= missing:
                break
            missing -= held
        prefix += c["c"]
    last = df.filter(digest.startswith(prefix)).groupBy(digest.alias("d")).count()
    for cut, held in sorted(last.collect()):
        if held >= missing:
            break
        missing -= held
    if held == missing:
        return df.filter(digest <= cut)
    copies = df.filter(digest == cut).limit(1) \
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.lit(missing)))).drop("__copy")
    return df.filter(digest < cut).unionByName(copies)
