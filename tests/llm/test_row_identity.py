"""Rows with equal or null ids: nothing that an operator decides for one text touches another."""

import pytest

import corpus_pipeline
from tillsight.llm.line_dedup import drop_repeated_chunks
from tillsight.llm.substring_dedup import drop_repeated_windows

A = " ".join(f"alpha{i}" for i in range(20))
Z = " ".join(f"zeta{i}" for i in range(20))
LINES = "common one\ncommon two\ncommon three"


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_substring_dedup_by_row(spark):
    rows = [(1, A), (5, A), (5, Z), (5, A), (None, A), (None, Z), (7, Z)]
    got = [(r["doc_id"], r["kept_text"], r["n_removed"])
           for r in drop_repeated_windows(table(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([
        (1, A, 0), (5, "", 20), (5, Z, 0), (5, "", 20), (None, A, 0), (None, Z, 0), (7, "", 20)],
        key=str)


def test_line_dedup_by_row(spark):
    rows = [(1, LINES), (5, LINES + "\nown"), (5, "k1\nk2\nk3"), (None, "n1\nn2"),
            (None, "m1\nm2"), (None, "n1\nn2\nn3"), (9, None)]
    got = {}
    for r in drop_repeated_chunks(table(spark, rows)).collect():
        got.setdefault(r["doc_id"], []).append(r["kept_text"])
    assert got[1] == [LINES] and sorted(got[5]) == ["k1\nk2\nk3", "own"] and got[9] == [None]
    # one of the two texts that share lines keeps them, the third is untouched
    assert "m1\nm2" in got[None] and len(got[None]) == 3
    assert sorted(t for t in got[None] if t != "m1\nm2") in (
        ["", "n1\nn2\nn3"], ["n1\nn2", "n3"])


DOCS = "doc_id long, text string, lang string, source string"


def stage(name, spark, rows, folder):
    fn = dict(corpus_pipeline.STAGES)[name]
    out = fn(spark, spark.createDataFrame(rows, DOCS), folder)
    assert out.columns == [c.split()[0] for c in DOCS.split(", ")]
    return sorted((r["doc_id"], r["text"][:6], r["lang"]) if r["doc_id"] is not None
                  else (-1, r["text"][:6], r["lang"]) for r in out.collect())


def test_near_dedup_keeps_one_row_of_each_group(spark, messy):
    rows = [(1, A, "en", "s"), (2, A, "en", "s"), (2, Z, "en", "s"), (None, A, "en", "s"),
            (None, Z + " more", "en", "s"), (None, Z + " more", "en", "s"), (1, A, "en", "s")]
    assert stage("near_dedup", spark, rows, messy) == [(1, "alpha0", "en"), (2, "zeta0 ", "en")]
    # no id at all: still one of each
    assert stage("near_dedup", spark, [(None, A, "en", "s")] * 3 + [(None, Z, "en", "s")], messy) \
        == [(-1, "alpha0", "en"), (-1, "zeta0 ", "en")]


def test_decontamination_judges_texts(spark, messy):
    leak = spark.read.parquet(f"{messy}/benchmark.parquet").filter("item_id = 0").first()["text"]
    rows = [(None, leak, "en", "s"), (None, A, "en", "s"), (3, leak, "en", "s"), (3, Z, "en", "s")]
    assert stage("decontaminate", spark, rows, messy) == [(-1, "alpha0", "en"), (3, "zeta0 ", "en")]


@pytest.mark.parametrize("ids", [[None] * 6, [4] * 6, list(range(6))])
def test_mix_takes_what_the_flow_allots(spark, messy, ids):
    texts = [A, A, Z, Z, A + " x", Z + " y"]
    rows = [(i, t, "en", s) for i, t, s in zip(ids, texts, ["a", "a", "a", "b", "b", "b"])]
    from pyspark.sql import functions as F

    from tillsight.llm import mixing
    from tillsight.llm.common import word_count
    want = mixing.mix_sources(spark.createDataFrame(rows, DOCS), F.array("source"),
                              word_count(F.col("text"))).agg(F.sum("copies")).first()[0]
    assert abs(len(stage("mix", spark, rows, messy)) - want) <= 1


def test_mix_of_identical_rows(spark, messy):
    rows = [(1, A, "en", "a")] * 5 + [(2, Z, "en", "b")]
    assert len(stage("mix", spark, rows, messy)) >= 5
