"""Tables that keep an order: sorted files and a reader that gives it back.

A row's place is stored with it (``__position``, 1-based, without gaps).  Files hold ranges of places
and are sorted, so Parquet's statistics prune all but the first files when only the head is read,
and the reader does not depend on file names or on the order in which files are listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tillsight.operators.ordered import Order, with_row_numbers
from tillsight.sources.sinks import scratch_path, write_table

POSITION = "__position"


def write_ordered(df: DataFrame, path: str, order: Order, files: int | None = None) -> None:
    """Write ``df`` in ``order``; ties are broken by the other columns, ascending.

    ``df`` is computed once, into a scratch table: numbering it reads its sort columns twice."""
    spark = df.sparkSession
    plain = scratch_path(spark, "unordered")
    write_table(df, plain)
    rows = spark.read.schema(df.schema).parquet(plain)
    named = {c for c, _ in order}
    rest = [(f.name, True) for f in df.schema
            if f.name not in named and not isinstance(f.dataType, MapType)]
    placed = with_row_numbers(rows, [*order, *rest], POSITION, partitions=files)
    ranges = placed.repartitionByRange(files, POSITION) if files \
        else placed.repartitionByRange(POSITION)
    write_table(ranges.sortWithinPartitions(POSITION), path)


def read_ordered(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """The rows in their stored order; ``first``: only so many (other files are skipped)."""
    df = spark.read.parquet(path)
    if first is not None:
        df = df.filter(F.col(POSITION) <= first)
    return df.orderBy(POSITION).drop(POSITION)
