"""The corpus pipeline: five stages from raw documents to shards.

``STAGES`` lists (name, function); each function takes (spark, docs, folder) and returns
a DataFrame.  :func:`run` stores every stage's result in the shared checkpoint folder and
reads it back as the next one's input.  All stages but the last return the columns of the
documents; columns beyond doc_id, text, lang and source are passed on untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm import decontaminate, langid, mixing, near_dedup, sharding
from tillsight.llm.common import stored, text_tag, word_count
from tillsight.sources.tables import read_table

#: Share of a document's letters that its main language must hold.
MAIN_LANGUAGE = 0.5
#: The stages have no SQL form (a Viterbi pass, a flow, an SVD); see the tests.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a main language; texts without letters or without one go.  A missing
    ``lang`` is filled with the predicted one."""
    model = langid.fit(docs.filter(~langid.held_out()))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = langid.label_languages(docs, model, keep={"row": row}) \
        .filter((F.col("lang_pred") != "und") & (F.col("score") >= MAIN_LANGUAGE))
    return found.select(*[
        (F.coalesce(F.col("row.lang"), F.col("lang_pred")) if c == "lang"
         else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def row_key(docs: DataFrame) -> Column:
    """64-bit hash of a whole row, which tells rows with equal or null ids apart (nulls are
    hashed as such).  Only identical rows share it; for them every decision is the same."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    return F.xxhash64(*cols, *[c.isNull() for c in cols])


def _copies_apart(docs: DataFrame, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (with ``__key``) that stand alone, and one row for each set of identical ones;
    ``repeated``: the keys that several rows have."""
    again = docs.join(repeated.select("__key"), "__key", "left_semi")
    return docs.join(repeated.select("__key"), "__key", "left_anti"), \
        again.dropDuplicates()


def near_dedup_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of near copies (five-word shingles, 0.8): that of the smallest
    id, of several such rows the one with the smallest hash, of identical ones any."""
    keyed = docs.withColumn("__key", row_key(docs))
    rows = keyed.groupBy("__key").agg(F.min("doc_id").alias("__id"), F.count(F.lit(1)).alias("__n"))
    found = near_dedup.near_duplicates(keyed, shingle=5, percent=80, id_col="__key") \
        .select(F.col("doc_id").alias("__key"), "component_id").distinct()
    rows = stored(rows.join(found, "__key"), "pipeline-groups")
    kept = rows.groupBy("component_id").agg(
        F.min(F.struct(F.col("__id").isNull().alias("no_id"), "__id", "__key")).alias("best")) \
        .select(F.col("best.__key").alias("__key"))
    keyed = keyed.join(kept, "__key", "left_semi")
    alone, once = _copies_apart(keyed, rows.filter("__n > 1").join(kept, "__key", "left_semi"))
    return alone.union(once).select(*[F.col(f"`{c}`") for c in docs.columns])


def decontaminate_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no benchmark passage; a text decides for all its rows."""
    keyed = docs.withColumn("__key", text_tag(F.col("text").cast("binary")))
    leaks = decontaminate.contaminated(keyed, read_table(spark, folder, "benchmark"),
                                       id_col="__key") \
        .select(F.col("doc_id").alias("__key")).distinct()
    return keyed.join(leaks, "__key", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every row as often as the mix takes it (0 to 3 times).  Identical rows are taken as
    often as the mix takes them together."""
    keyed = docs.withColumn("__key", row_key(docs))
    mixed = mixing.mix_sources(keyed, F.array("source"), word_count(F.col("text")), id_col="__key")
    taken = stored(mixed.groupBy("__key").agg(
        F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__n"))
        .filter("__copies > 0"), "pipeline-taken")
    keyed = keyed.join(taken.select("__key", "__copies"), "__key")
    alone, once = _copies_apart(keyed, taken.filter("__n > 1"))
    return alone.union(once) \
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))) \
        .select(*[F.col(f"`{c}`") for c in docs.columns])


def shard_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Shard and slot of every row along the Hilbert curve of language, source and size."""
    return sharding.hilbert_shards(docs, sharding.document_dims(), keep=("lang", "source"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mix", mix_stage),
    ("shard", shard_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
