"""Database tables through Spark's JDBC source (for deployments that keep the star
schema or the flat tables in a database).

Reads are split into ``num_partitions`` range queries on a numeric or date
column, so no single task pulls the table; writes go out in ``batchsize``-row
inserts from every partition in parallel.  No database runs in this repository's
test container, so only the option building is tested here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_read_options(url: str, table: str, partition_column: str | None = None,
                      lower: int | str | None = None, upper: int | str | None = None,
                      num_partitions: int = 64, fetchsize: int = 10_000,
                      **extra: str) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetchsize), **extra}
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("a partitioned read needs lower and upper bounds")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower),
                     "upperBound": str(upper), "numPartitions": str(num_partitions)})
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, **kw) -> DataFrame:
    """``SELECT * FROM table`` (or a subquery passed as ``table``) as a DataFrame;
    filters and column pruning on the result are pushed into the SQL sent."""
    return spark.read.format("jdbc").options(**jdbc_read_options(url, table, **kw)).load()


def jdbc_write_options(url: str, table: str, batchsize: int = 10_000,
                       **extra: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batchsize), **extra}


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               batchsize: int = 10_000, **extra: str) -> None:
    """``append`` adds rows; ``overwrite`` replaces the table (with
    ``truncate='true'`` in ``extra`` the table definition is kept)."""
    df.write.format("jdbc").mode(mode).options(
        **jdbc_write_options(url, table, batchsize, **extra)).save()
