"""Ordered tables and the source resolver."""

import glob

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tillsight.sources.csv import CLEAN_SCHEMA, write_csv
from tillsight.sources.ordered import read_ordered, write_ordered
from tillsight.sources.resolver import SourceError, resolve


def test_order_survives_several_files(spark, tmp_path):
    lines = spark.read.parquet(f"{SF_MID}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.when(F.col("l_partkey") % 5 > 0,
                                                           F.col("l_partkey")).alias("p"))
    path = str(tmp_path / "t")
    write_ordered(lines, path, [("p", False), ("l_quantity", True)], files=5)
    assert len(glob.glob(f"{path}/part-*.parquet")) == 5
    got = [tuple(r) for r in read_ordered(spark, path).collect()]
    want = [tuple(r) for r in lines.orderBy(
        F.col("p").desc(), "l_quantity", "l_orderkey", "l_linenumber").collect()]
    assert got == want
    head = read_ordered(spark, path, 7)
    assert [tuple(r) for r in head.collect()] == want[:7]
    assert "PushedFilters: [IsNotNull(__position), LessThanOrEqual(__position,7)" in \
        head._jdf.queryExecution().executedPlan().toString()


def test_source_branches(spark, tmp_path):
    row = spark.createDataFrame([("1", "10001", "A", 1, None, None, 1.0, "X", False, None, 2011, 1)],
                                CLEAN_SCHEMA)
    parquet, csv = str(tmp_path / "p"), str(tmp_path / "c")
    write_csv(row, f"{csv}/sales")
    # nothing listens there, and no driver is installed: the files step in, with the reason
    url = "jdbc:nosuchdb://127.0.0.1:1/retail"
    got = resolve(spark, "sales", url=url, parquet=parquet, csv=csv, schema=CLEAN_SCHEMA)
    assert got.kind == "csv" and set(got.skipped) == {"database", "parquet"}
    assert got.table.first().stock_code == "10001"
    row.write.parquet(f"{parquet}/sales")
    got = resolve(spark, "sales", parquet=parquet, csv=csv, schema=CLEAN_SCHEMA)
    assert (got.kind, got.skipped, got.table.count()) == ("parquet", {}, 1)
    with pytest.raises(SourceError, match="database: .*; parquet: .*PATH_NOT_FOUND"):
        resolve(spark, "returns", url=url, parquet=parquet)
    with pytest.raises(SourceError, match="database"):
        resolve(spark, "sales", url=url, parquet=parquet, fallback=False)
    with pytest.raises(SourceError, match="no source named"):
        resolve(spark, "sales")
    with pytest.raises(ValueError, match="schema"):
        resolve(spark, "sales", csv=csv)
