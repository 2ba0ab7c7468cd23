"""Median and mode of groups of any size, from counts per (group, value).

Spark's ``median`` and ``mode`` keep a group's value → count map in one task.  Here a group
with a third of all rows and millions of values is spread like any other: the counts are
grouped by (group, value), and what follows are aggregates that merge partial results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.operators.ordered import bucketed


def grouped_mode(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """(key, out): most frequent non-null ``value`` per ``key``, ties → smallest value.
    The second level is an arg-max over the counts, one candidate per partial result."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(key, F.col(value).alias("__v")) \
        .agg((-F.count(F.lit(1))).alias("__less"))
    best = counts.groupBy(key).agg(F.min(F.struct("__less", "__v")).alias("__best"))
    return best.select(key, F.col("__best.__v").alias(out or value))


def grouped_median(df: DataFrame, key: str, value: str, out: str | None = None,
                   partitions: int | None = None) -> DataFrame:
    """(key, out): exact median (double) of the non-null ``value`` per ``key``.

    The distinct (value, key) pairs are cut into buckets of the value order
    (:func:`tillsight.operators.ordered.bucketed`), so a group becomes as many segments as
    it has buckets.  A window per segment gives running counts, the group's segment totals
    what stands before it, and an aggregate picks the one or two middle values."""
    return median_of_counts(value_counts(df, key, value), key, out or value, partitions)


def value_counts(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, __v, __n): rows of each non-null ``value`` per ``key``."""
    return df.filter(F.col(value).isNotNull()).groupBy(key, F.col(value).alias("__v")) \
        .agg(F.count(F.lit(1)).alias("__n"))


def median_of_counts(counts: DataFrame, key: str, out: str,
                     partitions: int | None = None) -> DataFrame:
    """:func:`grouped_median` of values counted by :func:`value_counts`, which it reads more
    than once."""
    cut = bucketed(counts, {"__b": [("__v", True), (key, True)]}, partitions)
    # one row per group and bucket: the window is bounded by the number of buckets
    group = Window.partitionBy(key)
    segments = cut.groupBy(key, "__b").agg(F.sum("__n").alias("__c")).select(
        key, "__b", F.sum("__c").over(group).alias("__all"),
        F.coalesce(F.sum("__c").over(group.orderBy("__b").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    running = F.sum("__n").over(Window.partitionBy(key, "__b").orderBy("__v"))
    placed = cut.withColumn("__r", running).join(segments, [key, "__b"]) \
        .withColumn("__upto", F.col("__before") + F.col("__r"))

    def at(position) -> F.Column:
        return F.min(F.when(F.col("__upto") > position, F.col("__v"))).cast("double")
    last = F.col("__all") - 1
    return placed.groupBy(key).agg(
        (at(F.floor(last / 2)) * 0.5 + at(F.ceil(last / 2)) * 0.5).alias(out))
