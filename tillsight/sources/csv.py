"""CSV sources: the raw transaction export and the flat clean tables.

Schemas are explicit (no inference pass).  RFC-4180 quoting is read with
``escape='"'`` so doubled quotes and quoted commas survive.  Rows with *too
many* fields are dropped and rows with too few are kept null-padded — the
reader gets one surplus string column; a row that fills it had an extra field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw export columns (reference names) → canonical snake_case names.
RAW_COLUMNS = {
    "Invoice": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "unit_price",
    "Customer ID": "customer_id",
    "Country": "country",
}

RAW_SCHEMA = T.StructType([
    T.StructField("Invoice", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.IntegerType()),
    T.StructField("InvoiceDate", T.TimestampNTZType()),
    # wider than the stored price: the cleaning filters the price before rounding it
    T.StructField("Price", T.DecimalType(18, 6)),
    # customer ids are exported as float text ("13668.0")
    T.StructField("Customer ID", T.DoubleType()),
    T.StructField("Country", T.StringType()),
])

# Flat tables written by the cleaning job (snake_case names).
RETURNS_SCHEMA = T.StructType([
    T.StructField(RAW_COLUMNS[f.name],
                  T.DecimalType(10, 2) if f.name == "Price" else f.dataType)
    for f in RAW_SCHEMA.fields])

CLEAN_SCHEMA = T.StructType(RETURNS_SCHEMA.fields + [
    T.StructField("is_guest", T.BooleanType()),
    T.StructField("revenue", T.DecimalType(12, 2)),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])

# --- Fixed values: text read as missing by the reference's CSV reader -------------
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null"]
# ------------------------------------------------------------------------------------

_EXTRA = "__extra_field"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _na_to_null(col: Column) -> Column:
    return F.when(col.isin(*NA_TOKENS), F.lit(None)).otherwise(col)


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             timestamp_format: str = TIMESTAMP_FORMAT) -> DataFrame:
    """CSV with a header, explicit schema and the too-many-fields rule.

    All fields are read as text: missing-value tokens become NULL in columns of every type
    (``NaN`` is no number here), and so does text that is not of the column's type."""
    text = _read_text(spark, path, schema)
    return text.select(*[_typed(f, timestamp_format).alias(f.name) for f in schema.fields])


def _read_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    with_extra = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]
                              + [T.StructField(_EXTRA, T.StringType())])
    df = (spark.read
          .option("header", True)
          .option("escape", '"')
          .option("encoding", "UTF-8")
          .option("mode", "PERMISSIVE")
          .option("enforceSchema", True)
          .schema(with_extra)
          .csv(path))
    df = df.filter(F.col(_EXTRA).isNull()).drop(_EXTRA)
    return df.select(*[_na_to_null(F.col(f"`{c}`")).alias(c) for c in schema.fieldNames()])


def _typed(field: T.StructField, timestamp_format: str = TIMESTAMP_FORMAT) -> Column:
    """The column's text as its type, NULL if it is none."""
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return col
    if isinstance(field.dataType, T.TimestampNTZType):
        return F.try_to_timestamp(col, F.lit(timestamp_format)).cast(field.dataType)
    return col.try_cast(field.dataType)


def malformed_values(spark: SparkSession, path: str,
                     schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """``(column, malformed)``: values of each typed column that are neither missing nor
    of its type.  :func:`read_csv` reads them as NULL; this report makes them visible."""
    df = _read_text(spark, path, schema)
    typed = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    counts = df.agg(*[F.count_if(F.col(f"`{f.name}`").isNotNull()
                                 & _typed(f).isNull())
                      .alias(f.name) for f in typed])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(RAW_COLUMNS.get(f.name, f.name)).alias("column"),
                 F.col(f"`{f.name}`").alias("malformed")) for f in typed])).alias("x")) \
        .select("x.column", "x.malformed")


def read_raw_transactions(spark: SparkSession, path: str) -> DataFrame:
    """The raw export, renamed to snake_case."""
    return read_csv(spark, path, RAW_SCHEMA).withColumnsRenamed(RAW_COLUMNS)


def read_clean_sales(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, CLEAN_SCHEMA)


def read_clean_returns(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, RETURNS_SCHEMA)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header + RFC-4180 quoting; one file per partition (no driver collect)."""
    (df.write.mode(mode).option("header", True).option("escape", '"')
     .option("timestampNTZFormat", TIMESTAMP_FORMAT).csv(path))
