"""The plan that the driver holds for the shards."""

from tests.conftest import spark  # noqa: F401


def test_curve_is_planned_once(spark):  # noqa: F811
    from tillsight.llm.sharding import document_dims, hilbert_shards
    rows = [(i, f"t{i % 7}" * (i % 5), ["en", "fr", None][i % 3], "s") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = hilbert_shards(docs, document_dims())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # the numbering's subqueries do not repeat the joins with the bins
    assert "Join" not in plan and "__v0" not in plan
    got = out.collect()
    assert sorted(r["doc_id"] for r in got) == list(range(60))
    assert all(sorted(r["slot"] for r in got if r["shard"] == s) == list(range(
        sum(r["shard"] == s for r in got))) for s in range(16))
