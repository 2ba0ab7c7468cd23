"""Surrogate keys that stay: a registry of the rows that have been numbered.

A row is known by a 128-bit hash of its natural columns and its place among rows that agree in
them (two equal lines of an invoice get two keys).  Known rows keep their key; new ones are
numbered past the largest stored one, in the order of their hashes.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.operators.ordered import with_row_numbers

_ROW = ["__k1", "__k2", "__nth"]
#: Copies of a row are written out in runs of this many.
_RUN = 1000


def _hashed(df: DataFrame, natural: Sequence[str]) -> DataFrame:
    # nulls are hashed as such: the hash function itself skips them
    parts = [c for n in natural for c in (F.col(n), F.col(n).isNull())]
    return df.withColumns({"__k1": F.xxhash64(F.lit(1), *parts),
                           "__k2": F.xxhash64(F.lit(2), *parts)})


def _identified(df: DataFrame, natural: Sequence[str]) -> DataFrame:
    same = Window.partitionBy("__k1", "__k2").orderBy("__k1")
    return _hashed(df, natural).withColumn("__nth", F.row_number().over(same))


def _copies(groups: DataFrame) -> DataFrame:
    """``groups`` with a row for each of their ``__n`` copies, numbered in ``__nth``."""
    runs = groups.withColumn("__from", F.explode(F.sequence(
        F.lit(1).cast("long"), F.col("__n"), F.lit(_RUN).cast("long"))))
    return runs.withColumn("__nth", F.explode(F.sequence(
        "__from", F.least(F.col("__n"), F.col("__from") + (_RUN - 1))))) \
        .withColumn("__nth", F.col("__nth").cast("int")).drop("__from")


def _by_first_hash(df: DataFrame) -> Column:
    """Equal ranges of the first hash, about one a shuffle partition: a hash is spread evenly,
    so nothing needs to be sampled."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return F.shiftright("__k1", 64 - max(1, min(ceil(log2(max(partitions, 2))), 10)))


def extend_registry(df: DataFrame, natural: Sequence[str], registry: DataFrame | None = None,
                    key: str = "id") -> DataFrame:
    """The registry (``__k1, __k2, __nth, key``) with the new rows of ``df`` numbered.  Equal
    rows are counted first, so they are numbered as one."""
    groups = _hashed(df, natural).groupBy("__k1", "__k2").agg(F.count(F.lit(1)).alias("__n"))
    if registry is None:
        placed = with_row_numbers(groups, [("__k1", True), ("__k2", True)], "__place",
                                  {"__upto": "__n"}, buckets=_by_first_hash(df))
        return _copies(placed).select(
            *_ROW, (F.col("__upto") - F.col("__n") + F.col("__nth")).alias(key))
    last = F.coalesce(registry.agg(F.max(key)).scalar(), F.lit(0))
    new = _copies(groups).select(*_ROW).join(registry, _ROW, "left_anti")
    fresh = with_row_numbers(new, [(c, True) for c in _ROW], "__place",
                             buckets=_by_first_hash(df)) \
        .select(*_ROW, (F.col("__place") + last).alias(key))
    return registry.select(*_ROW, key).unionByName(fresh)


def with_surrogate_keys(df: DataFrame, natural: Sequence[str], registry: DataFrame,
                        key: str = "id") -> DataFrame:
    """``df`` with the key that the registry holds for each row."""
    return _identified(df, natural).join(registry.select(*_ROW, key), _ROW).drop(*_ROW)
