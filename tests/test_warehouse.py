"""What a query stores, and that the tables it gets are those of the whole warehouse."""

import datetime

import pytest
from pyspark.sql import functions as F

from tillsight import warehouse
from tillsight.operators.keys import extend_registry, with_surrogate_keys
from tillsight.registry import QUERIES


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("tables")

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{base}/{name}.parquet")
    day = datetime.datetime
    write("nation", [(1, "A"), (2, "UNITED KINGDOM")], "n_nationkey int, n_name string")
    write("customer", [(1, 1), (2, 2), (2, 2), (None, 1), (3, None)],
          "c_custkey long, c_nationkey int")
    write("part", [(10, "red", 1.0), (11, "blue", 2.0), (11, "blue", 2.0), (None, "x", 3.0)],
          "p_partkey long, p_name string, p_retailprice double")
    # a header twice, one with another date, one without lines, one without a customer
    write("orders", [(100, 1, day(2000, 1, 5), "2-HIGH"), (100, 1, day(2000, 1, 5), "2-HIGH"),
                     (100, 1, day(2001, 2, 6), "2-HIGH"), (101, 2, day(2000, 3, 7), "1-URGENT"),
                     (102, 2, None, None), (103, 1, day(2000, 1, 5), "2-HIGH"),
                     (104, 9, day(2000, 1, 5), "2-HIGH"), (None, 1, day(2000, 1, 5), "2-HIGH")],
          "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string")
    write("lineitem", [(o, p, n, 2.0, 7.5, flag) for o, p, n, flag in (
        (100, 10, 1, "N"), (100, 10, 1, "N"), (100, 11, 2, "R"), (101, 11, 1, "A"),
        (102, 10, 1, "N"), (102, None, 2, "R"), (104, 10, 1, "N"), (None, 10, 1, "N"),
        (101, 10, 2, None))],
          "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, "
          "l_extendedprice double, l_returnflag string")
    return str(base)


def rows(df):
    return sorted(map(str, df.collect()))


def built(spark, folder):
    return {kind for app, kind, at in warehouse._BUILT if at == folder}


@pytest.mark.parametrize("key, kept", [
    ("top10_products", {"etl-raw"}), ("price_volume_top200", {"etl-raw"}),
    ("roundtrip_parquet", {"etl-raw"}), ("clean_returns", {"etl-raw"}),
    ("returns_reassign_orphans", {"etl-raw"}), ("surrogate_keys", {"etl-raw"}),
    ("hist_orders_per_customer", {"etl-raw", "etl-eda"}),
    ("return_rate", set()), ("top10_countries", {"canonical-totals"}),
    ("new_customers_monthly", {"canonical-totals"})])
def test_a_query_builds_what_it_reads(spark, folder, key, kept):
    before = built(spark, folder)
    QUERIES[key](spark, folder).collect()
    assert built(spark, folder) - before <= kept


def test_tables_are_those_of_the_whole_warehouse(spark, folder):
    whole = warehouse.synthetic(spark, folder)
    part = warehouse.synthetic(spark, folder, ("totals", "customers", "items", "returns"))
    plans = warehouse.synthetic(spark, folder, ())
    assert whole.totals.filter("invoice_no = 100").count() == 2
    for name in ("totals", "customers", "items", "returns", "products", "invoices"):
        want = getattr(whole, name)
        for got in (getattr(part, name), getattr(plans, name)):
            assert got.dtypes == want.dtypes
            assert rows(got) == rows(want), name


def test_equal_rows_are_counted_before_they_are_numbered(spark):
    df = spark.createDataFrame([("a", None)] * 2500 + [(None, "a")] + [(f"b{i}", "x")
                                                                       for i in range(200)],
                               "p string, q string")
    registry = extend_registry(df, ["p", "q"], None, "id")
    got = [tuple(r) for r in registry.orderBy("__k1", "__k2", "__nth").collect()]
    assert [r[3] for r in got] == list(range(1, 2702))
    keyed = with_surrogate_keys(df, ["p", "q"], registry, "id")
    assert keyed.select("id").distinct().count() == keyed.count() == 2701
    # a larger batch keeps the known keys and numbers the rest past them
    more = df.union(df.limit(3)).union(spark.createDataFrame([("new", "n")], df.schema))
    wider = extend_registry(more, ["p", "q"], registry, "id")
    assert {tuple(r) for r in wider.collect()} > set(got)
    assert wider.agg(F.max("id")).first()[0] == wider.count() == 2705
    # the rows are not sampled, and copies reach the numbering as one row
    plan = registry._jdf.queryExecution().optimizedPlan().toString()
    assert "GlobalLimit" not in plan and "row_number() windowspecdefinition(__k1" not in plan


@pytest.mark.parametrize("key, tables", [
    ("dq_not_null", {"customers", "products", "invoices"}),
    ("load_checks", {"products", "invoices"}), ("quarantined_lines", {"products", "invoices"})])
def test_a_check_stores_the_parents_it_reads(spark, folder, tmp_path, monkeypatch, key, tables):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    copy, write, during = tmp_path / "tables", warehouse._write, []
    copy.symlink_to(folder)
    monkeypatch.setattr(warehouse, "_write", lambda df, *a: (
        during.append(spark.conf.get(setting)), write(df, *a))[1])
    before = spark.conf.get(setting, None)
    QUERIES[key](spark, str(copy)).collect()
    kept = built(spark, str(copy))
    parts = {"prices", "medians", "descriptions"}
    assert kept == {f"etl-{t}" for t in {"raw", *tables, *parts}}
    # what a table was shuffled for goes with its write
    assert during == ["true"] * len(kept) and spark.conf.get(setting, None) == before
