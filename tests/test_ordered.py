"""Distributed global windows equal Spark's single-partition windows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tillsight.operators.ordered import (ntile_from_row_number, top_k_with_ties, with_ntile,
                                         with_rank, with_row_numbers)


@pytest.fixture(scope="module")
def lines(spark):
    # heavy ties: ~60k rows, 50 distinct quantities
    return spark.read.parquet(f"{SF_MID}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("q"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("p"))


def _same(a, b):
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0


def test_row_number_and_rows_sum(spark, lines):
    order = [("q", False), ("l_orderkey", True), ("l_linenumber", True)]
    mine = with_row_numbers(lines, order, "rn", running_sums={"run": "p"}, partitions=7)
    w = Window.orderBy(F.col("q").desc(), "l_orderkey", "l_linenumber")
    ref = lines.withColumn("rn", F.row_number().over(w).cast("long")) \
        .withColumn("run", F.sum("p").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    _same(mine.select("l_orderkey", "l_linenumber", "rn", F.col("run").cast("decimal(30,2)")),
          ref.select("l_orderkey", "l_linenumber", "rn", F.col("run").cast("decimal(30,2)")))


def test_rank_and_range_sum_with_ties(spark, lines):
    mine = with_rank(lines, "q", ascending=False, rank="rk", range_sums={"cum": "p"},
                     partitions=5)
    w = Window.orderBy(F.col("q").desc())
    ref = lines.withColumn("rk", F.rank().over(w)).withColumn("cum", F.sum("p").over(w))
    cols = ["l_orderkey", "l_linenumber", "rk", F.col("cum").cast("decimal(30,2)")]
    _same(mine.select(*cols), ref.select(*cols))


@pytest.mark.parametrize("k", [5, 7])
def test_ntile(spark, lines, k):
    order = [("q", True), ("l_orderkey", True), ("l_linenumber", True)]
    mine = with_ntile(lines, order, k, "t", partitions=6)
    ref = lines.withColumn("t", F.ntile(k).over(Window.orderBy("q", "l_orderkey", "l_linenumber")))
    _same(mine.select("l_orderkey", "l_linenumber", "t"),
          ref.select("l_orderkey", "l_linenumber", "t"))


def test_ntile_formula_small_counts(spark):
    # fewer rows than tiles, and every remainder
    for n in range(1, 13):
        df = spark.range(n).withColumn("rn", F.col("id") + 1).withColumn("n", F.lit(n))
        mine = df.select("id", ntile_from_row_number("rn", "n", 5).alias("t"))
        ref = df.select("id", F.ntile(5).over(Window.orderBy("id")).alias("t"))
        _same(mine, ref)


def test_top_k_keeps_ties(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([9, 9, 8, 8, 8, 7, 6, 6])],
                               "id int, v int")
    got = {(r.id, r.rk) for r in top_k_with_ties(df, "v", 3, rank="rk").collect()}
    assert got == {(0, 1), (1, 1), (2, 3), (3, 3), (4, 3)}


def _jobs_of(spark, build):
    """Spark jobs that ``build`` runs."""
    sc = spark.sparkContext
    group = f"plan-{id(build)}"
    sc.setJobGroup(group, "plan")
    try:
        build()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_planning_runs_no_job(spark, lines):
    order = [("q", False), ("l_orderkey", True), ("l_linenumber", True)]
    assert _jobs_of(spark, lines.count) > 0
    assert _jobs_of(spark, lambda: with_row_numbers(lines, order, "rn", {"run": "p"})) == 0
    assert _jobs_of(spark, lambda: with_rank(lines, "q", range_sums={"cum": "p"})) == 0
    assert _jobs_of(spark, lambda: with_ntile(lines, order, 5, "t")) == 0
    assert _jobs_of(spark, lambda: top_k_with_ties(lines, "p", 5)) == 0


def test_every_mart_and_view_is_lazy(spark):
    from tillsight.jobs import marts
    from tillsight.plans.views import register_views
    from tillsight.sources.synthetic import load
    r = load(spark, SF_MID)
    assert _jobs_of(spark, lambda: register_views(r)) == 0
    assert _jobs_of(spark, lambda: marts(r)) == 0
    assert spark.sql("select count(*) n from vw_customer_rfm").first()["n"] > 0
    assert spark.sql("select max(revenue_rank) n from vw_top_products").first()["n"] > 0


def test_data_rows_never_meet_in_one_partition(spark, lines):
    """Single-partition exchanges carry the bounded sample or one row per bucket."""
    order = [("q", False), ("l_orderkey", True), ("l_linenumber", True)]
    plan = with_row_numbers(lines, order, "rn")._jdf.queryExecution().executedPlan().toString()
    rows = plan.splitlines()
    gathered = [i for i, line in enumerate(rows) if "Exchange SinglePartition" in line]
    for i in gathered:
        assert any(op in rows[i + 1] for op in
                   ("Aggregate", "TakeOrderedAndProject", "Window", "Sort")), rows[i + 1]
    assert "__ord_b" in plan and "TakeOrderedAndProject(limit=" in plan


@pytest.mark.parametrize("parts", [1, 2, 9, 30])
def test_mixed_directions_nulls_and_texts(spark, parts):
    """Boundaries are whole sort keys of any type; nulls stand where Spark puts them."""
    rows = [(i, None if i % 7 == 0 else float(i % 5) if i % 11 else float("nan"),
             None if i % 6 == 1 else "xyzé"[i % 4] * (i % 3), i * i % 17) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, v double, s string, w int")
    order = [("v", False), ("s", True), ("w", False), ("id", True)]
    w = Window.orderBy(F.col("v").desc(), F.col("s").asc(), F.col("w").desc(), "id")
    ref = df.select("id", F.row_number().over(w).alias("rn"),
                    F.sum("w").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    mine = with_row_numbers(df, order, "rn", {"run": "w"}, "n", parts)
    _same(mine.select("id", F.col("rn").cast("int"), "run"), ref)
    assert mine.select("n").distinct().collect()[0][0] == 300
    assert with_row_numbers(df.filter("false"), order, "rn").count() == 0


def test_a_hot_value_is_split(spark):
    """A third of all rows under one sort value still spreads over buckets."""
    from tillsight.operators.ordered import _with_buckets
    df = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 7)
                                    .otherwise(F.col("id")).alias("v"))
    order = [("v", True), ("id", True)]
    sizes = _with_buckets(df, {"b": order}, 5).groupBy("b").count().collect()
    assert len(sizes) == 25 and max(r["count"] for r in sizes) < 2 * 30_000 / 25


def test_sample_fixed_n_is_exact_and_layout_independent(spark, lines):
    from tillsight.operators.sampling import sample_fixed_n
    a = sample_fixed_n(lines, 500, seed=7)
    b = sample_fixed_n(lines.repartition(13), 500, seed=7)
    assert a.count() == 500
    _same(a, b)
    assert sample_fixed_n(lines, 10 ** 9).count() == lines.count()


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(min_value=0, max_value=6), min_size=1, max_size=40),
       st.integers(min_value=1, max_value=5))
def test_rank_ntile_property(spark, values, parts):
    """Random inputs with many ties, any partition count: equal to plain windows."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int")
    w = Window.orderBy(F.col("v").desc())
    ref = df.withColumn("rk", F.rank().over(w)).withColumn("cum", F.sum("v").over(w)) \
        .withColumn("t", F.ntile(3).over(Window.orderBy("v", "id")))
    mine = with_rank(df, "v", ascending=False, rank="rk", range_sums={"cum": "v"},
                     partitions=parts)
    mine = with_ntile(mine, [("v", True), ("id", True)], 3, "t", partitions=parts)
    cols = ["id", "rk", F.col("cum").cast("long"), "t"]
    _same(mine.select(*cols), ref.select(*cols))
