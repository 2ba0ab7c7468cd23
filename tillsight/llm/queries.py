"""Queries over the whole test tables, one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm import (
    decontaminate,
    langid,
    line_dedup,
    lm_score,
    mixing,
    near_dedup,
    prefix_trie,
    quality_rules,
    sharding,
    simhash,
    spelling,
    substring_dedup,
    warc,
)
from tillsight.llm.oracle import SQL  # noqa: F401
from tillsight.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op5_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_documents(read_table(spark, folder, "documents"))


@query
def op8_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return sharding.hilbert_shards(docs, sharding.document_dims()) \
        .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard",
                "curve_index")


@query
def op4_langid(spark: SparkSession, folder: str) -> DataFrame:
    out = langid.identify_documents(read_table(spark, folder, "documents"))
    return out.select("doc_id", "held_out", "lang_pred", "score",
                      F.size("spans").alias("n_spans"))


@query
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge_documents(read_table(spark, folder, "documents"),
                                         read_table(spark, folder, "labels"))


@query
def op2_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    out = warc.derive(warc.page_responses(read_table(spark, folder, "pages")), "page_id")
    return out.select("page_id", "record_type", "record_id", "refers_to", "target_uri",
                      "content_length", "block_digest", "source_payload_digest", "n_words",
                      F.size("headers").alias("n_headers"))


@query
def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, folder, "documents"), shingle=2)


@query
def op10_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    out = line_dedup.drop_repeated_chunks(read_table(spark, folder, "documents"))
    return out.select("doc_id", "n_lines", "n_removed",
                      F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query
def op1_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score_documents(read_table(spark, folder, "documents"))


@query
def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.drop_repeated_windows(
        read_table(spark, folder, "documents"), digests=True)


@query
def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, folder, "documents"),
                                      read_table(spark, folder, "benchmark"))


@query
def op11_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_groups(read_table(spark, folder, "documents"))


@query
def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variant_groups(read_table(spark, folder, "documents"))


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.conversation_trie(read_table(spark, folder, "conversations"))
