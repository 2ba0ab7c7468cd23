"""Incremental cleaning: raw CSV drops → clean sales / returns tables.

The batch job cleans one export at a time.  When exports arrive as a stream of
files, the same rules run per micro-batch:

* ``readStream`` over the landing folder with the raw schema (no inference) and
  the same CSV dialect as the batch reader (doubled quotes; over-long rows are
  dropped through the surplus column);
* ``foreachBatch`` applies the cleaning rules of
  :mod:`tillsight.operators.cleaning` and writes each batch into its own
  ``batch_id=<n>`` folder with ``overwrite`` (sales further partitioned by year,
  month).  A batch that is retried after a failure rewrites the same folder, so
  the tables hold every batch exactly once; readers see ``batch_id`` as a
  partition column.

Description imputation is the one rule that looks beyond a line: in the stream
a missing description takes the most frequent description of its stock code
among the lines cleaned so far plus the current batch (the batch job uses the
whole export).  Each batch stores its (code, description) counts next to the
sales (``<sales>_description_counts/batch_id=<n>``); imputation sums those
counts for the codes that need one, so it never re-reads past lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillsight.operators import cleaning
from tillsight.sources.csv import RAW_COLUMNS, RAW_SCHEMA, TIMESTAMP_FORMAT, _na_to_null

_EXTRA = "__extra_field"


def read_raw_stream(spark: SparkSession, landing: str, max_files: int = 100) -> DataFrame:
    schema = T.StructType(RAW_SCHEMA.fields + [T.StructField(_EXTRA, T.StringType())])
    df = (spark.readStream.option("header", True).option("escape", '"')
          .option("mode", "PERMISSIVE").option("timestampNTZFormat", TIMESTAMP_FORMAT)
          .option("maxFilesPerTrigger", max_files)
          .schema(schema).csv(landing))
    df = df.filter(F.col(_EXTRA).isNull()).drop(_EXTRA)
    strings = {f.name for f in RAW_SCHEMA.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[_na_to_null(F.col(f"`{c}`")).alias(c) if c in strings
                       else F.col(f"`{c}`") for c in RAW_SCHEMA.fieldNames()]) \
        .withColumnsRenamed(RAW_COLUMNS)


def _counts_path(sales_path: str) -> str:
    return f"{sales_path.rstrip('/')}_description_counts"


def _clean_batch(batch: DataFrame, batch_id: int, sales_path: str, returns_path: str) -> None:
    spark = batch.sparkSession
    sales, returns = cleaning.split_sales_returns(batch)
    sales = cleaning.filter_valid_lines(cleaning.filter_product_codes(sales))
    # (code, description) counts of this batch: the state the imputation reads,
    # one row per pair instead of every line seen so far
    counts = sales.filter(F.col("description").isNotNull()) \
        .groupBy("stock_code", "description").agg(F.count(F.lit(1)).alias("n"))
    counts.write.mode("overwrite").parquet(f"{_counts_path(sales_path)}/batch_id={batch_id}")
    missing_codes = sales.filter(F.col("description").isNull()).select("stock_code").distinct()
    all_counts = spark.read.parquet(_counts_path(sales_path)) \
        .filter(F.col("batch_id") <= batch_id) \
        .join(missing_codes, "stock_code", "left_semi") \
        .groupBy("stock_code", "description").agg(F.sum("n").alias("n"))
    # most frequent description, ties to the smallest text
    desc_map = all_counts.groupBy("stock_code").agg(
        F.min_by("description", F.struct(-F.col("n"), F.col("description"))).alias("__modal"))
    filled = sales.filter(F.col("description").isNull()).join(desc_map, "stock_code", "left") \
        .withColumn("description", F.col("__modal")).drop("__modal")
    sales = sales.filter(F.col("description").isNotNull()).unionByName(filled.select(*sales.columns))
    sales = cleaning.add_revenue_calendar(cleaning.filter_country(cleaning.flag_guests(sales)))
    sales.select(*cleaning.CLEAN_COLUMNS).write.mode("overwrite") \
        .partitionBy("year", "month").parquet(f"{sales_path}/batch_id={batch_id}")
    returns.select(*cleaning.RETURN_COLUMNS).write.mode("overwrite") \
        .parquet(f"{returns_path}/batch_id={batch_id}")


def start_ingest(spark: SparkSession, landing: str, sales_path: str, returns_path: str,
                 checkpoint: str, available_now: bool = False,
                 max_files: int = 100) -> StreamingQuery:
    """Start the ingest; ``available_now`` processes the files present and stops."""
    writer = read_raw_stream(spark, landing, max_files).writeStream \
        .foreachBatch(lambda b, i: _clean_batch(b, i, sales_path, returns_path)) \
        .option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
