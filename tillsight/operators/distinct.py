"""Exact distinct counts as mergeable bitmaps.

``COUNT(DISTINCT a), COUNT(DISTINCT b), …`` in one aggregate multiplies the input by the number of
columns (Expand) and cannot be merged later.  Here each column's keys get dense numbers, and every
slice of the table (a month, say) holds one bitmap per 32,768 numbers.  Bitmaps of any slices of
one call merge with ``bitmap_or_agg``, so the count over any range of slices needs no second
look at the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def distinct_bitmaps(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """(column, *by, part, bucket, bitmap) of the non-null keys of each column in each slice.

    Rows are reduced to distinct (slice, key) pairs first, so a key with a third of all rows is
    one row a slice.  Keys are dealt into hash parts and numbered inside them: a number needs
    to be dense only among the numbers that share its bitmaps."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def one(column: str) -> DataFrame:
        pairs = df.filter(F.col(column).isNotNull()).select(*by, F.col(column).alias("__key")).distinct()
        number = F.dense_rank().over(Window.partitionBy("part").orderBy("__key"))
        return pairs.withColumn("part", F.pmod(F.xxhash64("__key"), F.lit(parts)).cast("int")) \
            .withColumn("__number", number) \
            .groupBy(F.lit(column).alias("column"), *by, "part",
                     F.bitmap_bucket_number("__number").alias("bucket")) \
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("__number")).alias("bitmap"))
    return reduce(DataFrame.unionByName, map(one, columns))


def merged_counts(bitmaps: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(column, *by, n): distinct keys over all slices, or over the slices of each ``by``."""
    by = by or []
    return bitmaps.groupBy("column", *by, "part", "bucket") \
        .agg(F.bitmap_or_agg("bitmap").alias("bitmap")) \
        .groupBy("column", *by).agg(F.sum(F.bitmap_count("bitmap")).alias("n"))
