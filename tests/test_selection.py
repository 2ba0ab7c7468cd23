"""Percentiles, samples, grouped median and mode, distinct bitmaps against plain computations."""

import random
import statistics
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tillsight.operators.distinct import distinct_bitmaps, merged_counts
from tillsight.operators.grouped import grouped_median, grouped_mode
from tillsight.operators.sampling import sample_fixed_n
from tillsight.operators.selection import exact_percentiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def _long(spark, columns):
    return spark.createDataFrame([(c, v) for c, vs in columns.items() for v in vs],
                                 "column string, v double")


@pytest.mark.parametrize("cells", [2, 7, 2048])
def test_percentiles_of_wild_distributions(spark, cells):
    rnd = random.Random(3)
    columns = {
        "even": [float(i) for i in range(500)],
        "ties": [1.0] * 300 + [2.0] * 200 + [7.5],
        "skewed": [rnd.lognormvariate(0, 3) for _ in range(400)] + [1e12],
        "signs": [rnd.uniform(-1e6, 1e6) for _ in range(300)] + [0.0, -0.0],
        "tiny": [5e-324 * i for i in range(20)] + [1e-300],
        "one": [4.25],
    }
    got = exact_percentiles(_long(spark, columns), PROBS, cells=cells)
    for c, vs in columns.items():
        assert got[c] == pytest.approx(np.percentile(vs, [p * 100 for p in PROBS]), rel=1e-12), c


def test_percentiles_skip_missing_values(spark):
    got = exact_percentiles(_long(spark, {"a": [1.0, None, float("nan"), 3.0], "b": [None]}),
                            [0.5])
    assert got == {"a": [2.0]}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1,
                max_size=50))
def test_percentiles_property(spark, values):
    got = exact_percentiles(_long(spark, {"a": values}), PROBS, cells=16)["a"]
    assert got == pytest.approx(np.percentile(np.array(values, np.float64),
                                              [p * 100 for p in PROBS]), rel=1e-9, abs=1e-300)


def test_percentiles_shuffle_no_rows(spark):
    """Nothing but histogram cells crosses an exchange."""
    from tillsight.operators import selection
    long = spark.read.parquet(f"{SF_MID}/lineitem.parquet").select(
        F.lit("p").alias("column"), F.col("l_extendedprice").cast("double").alias("v"))
    cell = selection._cell(F.col("v"), F.lit(0.0), F.lit(1e5), selection.CELLS)
    plan = selection._values(long).groupBy(cell.alias("c")).count() \
        ._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "partial_count" in plan
    prices = [r["v"] for r in long.collect()]
    assert exact_percentiles(long, [0.5])["p"] == [statistics.median(prices)]


def test_sample_is_the_same_on_every_layout(spark):
    lines = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    for n in (1, 500, 20_000):
        picks = [sorted(map(tuple, sample_fixed_n(df, n, 7).select(
            "l_orderkey", "l_linenumber").collect()))
            for df in (lines, lines.repartition(13), lines.repartition(3, "l_partkey"))]
        assert len(picks[0]) == n and picks[0] == picks[1] == picks[2]
    assert picks[0] != sorted(map(tuple, sample_fixed_n(lines, 20_000, 8).select(
        "l_orderkey", "l_linenumber").collect()))


def test_sample_of_copies_and_by_key(spark):
    """A row that is most of the table, and keys that many rows share."""
    df = spark.createDataFrame([(1, "x")] * 3000 + [(i, None) for i in range(50)], "a int, b string")
    for n in (0, 1, 10, 2000, 3049, 3050, 9999):
        assert sample_fixed_n(df, n).count() == min(n, 3050)
    top = Counter(map(tuple, sample_fixed_n(df, 3010).collect()))
    assert top[1, "x"] >= 2960
    wide = spark.range(5000).select(F.col("id"), (F.col("id") % 2).alias("k"))
    picks = [sorted(r["id"] for r in sample_fixed_n(d, 700, key=["k"]).collect())
             for d in (wide, wide.repartition(5))]
    assert len(picks[0]) == 700 and picks[0] == picks[1] and len({i % 2 for i in picks[0]}) == 1
    assert sample_fixed_n(df.filter("false"), 5).count() == 0


rows = st.lists(st.tuples(st.sampled_from(["hot", "hot", "a", "b", None]),
                          st.one_of(st.none(), st.integers(-3, 9))), max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows, st.integers(1, 9))
def test_grouped_median_and_mode(spark, data, parts):
    df = spark.createDataFrame(data, "k string, v int")
    groups = defaultdict(list)
    for k, v in data:
        if v is not None:
            groups[k].append(v)
    # rows without a group are no group of the joins that read these, but are one here
    median = {r["k"]: r["m"] for r in grouped_median(df.filter("k is not null"), "k", "v", "m",
                                                     parts).collect()}
    groups.pop(None, None)
    assert median == {k: statistics.median(vs) for k, vs in groups.items()}
    mode = {r["k"]: r["v"] for r in grouped_mode(df, "k", "v").collect() if r["k"] is not None}
    assert mode == {k: min(vs, key=lambda v: (-vs.count(v), v)) for k, vs in groups.items()}


def test_hot_group_is_spread(spark):
    """One group with a third of all rows and 100,000 values: no segment holds much of it."""
    df = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000 + 1).alias("k"),
        ((F.col("id") * 7919) % 1_000_003 / 100).cast("decimal(12,2)").alias("v"))
    got = {r["k"]: r["v"] for r in grouped_median(df, "k", "v").collect()}
    pdf = df.toPandas()
    want = pdf.assign(v=pdf["v"].astype(float)).groupby("k")["v"].median()
    assert len(got) == len(want)
    assert all(abs(got[k] - v) < 1e-9 for k, v in want.items())
    from tillsight.operators.ordered import bucketed
    counts = df.groupBy("k", "v").count()
    sizes = bucketed(counts, {"b": [("v", True), ("k", True)]}, 16).filter("k = 0") \
        .groupBy("b").count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 100_000 / 8


def test_no_value_map_in_the_plan(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    for out in (grouped_median(df, "k", "v"), grouped_mode(df, "k", "v")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "median(" not in plan and "mode(" not in plan and "percentile" not in plan


def test_distinct_bitmaps_merge(spark):
    rnd = random.Random(5)
    data = [(rnd.randint(1, 4), rnd.choice(["a", "b", None, "hot", "hot"]), rnd.randint(0, 90_000))
            for _ in range(4000)]
    df = spark.createDataFrame(data, "m int, s string, n int")
    maps = distinct_bitmaps(df, ["s", "n"], ["m"]).cache()
    total = {r["column"]: r["n"] for r in merged_counts(maps).collect()}
    assert total == {"s": 3, "n": len({x[2] for x in data})}
    monthly = {(r["column"], r["m"]): r["n"] for r in merged_counts(maps, ["m"]).collect()}
    assert monthly == {(c, m): len({x[i] for x in data if x[0] == m and x[i] is not None})
                       for c, i in (("s", 1), ("n", 2)) for m in (1, 2, 3, 4)}
    # any range of slices merges
    part = {r["column"]: r["n"] for r in merged_counts(maps.filter("m in (2, 3)")).collect()}
    assert part["n"] == len({x[2] for x in data if x[0] in (2, 3)})
    plan = merged_counts(distinct_bitmaps(df, ["s", "n"], ["m"]))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Expand" not in plan
