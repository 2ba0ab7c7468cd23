"""What the driver holds for the pipeline's later stages: plans and broadcasts."""

import os

from tests.conftest import spark  # noqa: F401

SCHEMA = "doc_id long, text string, lang string, source string"


def _docs(spark):  # noqa: F811
    return spark.createDataFrame(
        [(i, " ".join(["w"] * (i % 9 + 1)), ["en", "fr", None][i % 3], f"s{i % 4}")
         for i in range(200)], SCHEMA)


def _numbered_inputs(monkeypatch, module):
    """Optimized plans of all tables that ``module`` numbers from now on."""
    plans, number = [], module.with_row_numbers

    def watched(df, *a, **b):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return number(df, *a, **b)

    monkeypatch.setattr(module, "with_row_numbers", watched)
    return plans


def test_mix_plans_each_pass_once(spark, monkeypatch):  # noqa: F811
    from pyspark.sql import functions as F

    from tillsight.llm import mixing
    from tillsight.llm.common import word_count
    plans, written, store = _numbered_inputs(monkeypatch, mixing), [], mixing.stored
    monkeypatch.setattr(mixing, "stored", lambda df, name: (written.append(
        df._jdf.queryExecution().optimizedPlan().toString()), store(df, name))[1])
    mixed = mixing.mix_sources(_docs(spark), F.array("source"), word_count(F.col("text"))).collect()
    assert len(plans) == 4 and not any("Join" in p for p in plans)
    # no stored table, nor the result, holds more than one numbering and the joins of one pass
    assert max(p.count("Join") for p in written) <= 6
    assert sorted(r["doc_id"] for r in mixed) == list(range(200))
    assert abs(sum(r["taken"] for r in mixed) - sum(r["size"] for r in mixed)) <= 9 * 4


def test_bins_count_the_rows_once(spark, monkeypatch):  # noqa: F811
    from tillsight.llm import sharding
    plans = _numbered_inputs(monkeypatch, sharding)
    got = sharding.equal_depth_bins(_docs(spark), "lang", 2, "bin").collect()
    assert not any("Aggregate" in p for p in plans)
    assert {r["lang"]: r["bin"] for r in got} == {None: 0, "en": 1, "fr": 2}
    empty = spark.createDataFrame([], SCHEMA)
    assert sharding.equal_depth_bins(empty, "lang", 2, "bin").collect() == []


def test_decontaminate_gives_its_broadcasts_back(spark, monkeypatch):  # noqa: F811
    from pyspark import SparkContext

    from tillsight.llm.decontaminate import contaminated
    made, share = [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast",
                        lambda self, value: (made.append(share(self, value)), made[-1])[1])
    passage = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"before it {passage} after it"), (2, "other words here")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(7, passage)], "item_id long, text string")
    found = contaminated(docs, items)
    assert made and not any(os.path.exists(b._path) for b in made)
    assert [(r["doc_id"], r["item_id"]) for r in found.collect()] == [(1, 7)]
