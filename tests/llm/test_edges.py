"""Every query and the pipeline on messy and on empty tables."""

import pytest

import __spark_entry__ as E
from tests.llm.conftest import messy_rows

QUERIES = {k: q for k, q in E.queries().items() if k.startswith("op") and k[2].isdigit()}
PER_DOCUMENT = {k for k in QUERIES if k.split("_")[0] in
                ("op1", "op4", "op5", "op6", "op7", "op8", "op9", "op10", "op11")}


def test_one_query_per_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_messy(spark, messy, name):
    rows = QUERIES[name](spark, messy).collect()
    if name in PER_DOCUMENT:
        assert len(rows) == len(messy_rows())
        assert sum(r["doc_id"] is None for r in rows) == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


def test_pipeline(spark, messy, empty):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_dedup", "decontaminate", "mix", "shard"]
    docs = spark.read.parquet(f"{messy}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, messy)
        assert out.columns == docs.columns
    assert corpus_pipeline.run(spark, messy).count() > 0
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_defined_results(spark, messy):
    of = lambda name: {r["doc_id"]: r for r in QUERIES[name](spark, messy).collect()}
    by = {k.split("_")[0]: k for k in QUERIES}
    lang = of(by["op4"])
    assert lang[0]["lang_pred"] == lang[1]["lang_pred"] == lang[5]["lang_pred"] == "und"
    assert lang[13]["lang_pred"] in ("en", "fr")
    size = of(by["op8"])
    assert size[0]["size"] == 1 and size[0]["text_crc32"] is None and size[3]["size"] == 4
    near = of(by["op9"])
    assert near[0]["n_shingles"] == 0 and near[0]["kept"]
    assert near[4]["component_id"] == 3 and near[7]["component_id"] == 6
    score = of(by["op1"])
    assert score[0]["n_tokens"] == 1 and score[3]["n_tokens"] == 2
    gone = of(by["op7"])
    assert gone[7]["n_removed"] == 40 and gone[6]["n_removed"] == 0 and gone[9]["n_removed"] == 39
    quality = of(by["op6"])
    assert quality[0]["base_failed"] and not quality[0]["kept"]
    leaks = {(r["doc_id"], r["item_id"]) for r in QUERIES[by["op3"]](spark, messy).collect()}
    assert {(8, 0), (9, 0)} <= leaks
