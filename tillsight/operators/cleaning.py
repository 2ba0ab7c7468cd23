"""Cleaning rules for raw transaction lines (snake_case columns).

``clean(raw)`` returns ``(sales, returns)``:

1. returns are the lines whose invoice starts with ``C``; the rest are sales;
2. sales keep product codes only: not a service code, first character a digit;
3. sales keep ``unit_price > 0`` (before it is rounded to cents) and ``quantity > 0``;
4. a missing description is filled with the code's most frequent description
   (ties → smallest text);
5. ``is_guest`` flags a missing customer id;
6. country ``Unspecified`` is dropped (missing countries are kept);
7. ``revenue = quantity × unit_price`` (exact decimal, 2 places), ``year``, ``month``.

The imputation join only carries the lines that lack a description; all other
lines bypass it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight import params as P
from tillsight.functions.numeric import MONEY, PRICE
from tillsight.operators.distinct import distinct_bitmaps, merged_counts
from tillsight.operators.grouped import grouped_mode


def is_return(df: DataFrame) -> F.Column:
    return F.coalesce(F.col("invoice_no").startswith(P.RETURN_PREFIX), F.lit(False))


def split_sales_returns(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    return raw.filter(~is_return(raw)), raw.filter(is_return(raw))


def filter_product_codes(sales: DataFrame) -> DataFrame:
    code = F.col("stock_code")
    return sales.filter(~code.isin(*P.SERVICE_CODES)) \
        .filter(F.coalesce(code.rlike(P.PRODUCT_CODE_PATTERN), F.lit(False)))


def filter_valid_lines(sales: DataFrame) -> DataFrame:
    return sales.filter((F.col("unit_price") > 0) & (F.col("quantity") > 0))


def modal_value(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """Most frequent non-null ``value`` per ``key`` (ties → smallest value)."""
    return grouped_mode(df, key, value, out)


def impute_description(sales: DataFrame) -> DataFrame:
    """Fill missing descriptions from the modal description of the stock code."""
    desc_map = modal_value(sales, "stock_code", "description", "__modal")
    missing = sales.filter(F.col("description").isNull())
    filled = missing.join(desc_map, "stock_code", "left") \
        .withColumn("description", F.col("__modal")).drop("__modal")
    return sales.filter(F.col("description").isNotNull()) \
        .unionByName(filled.select(*sales.columns))


def flag_guests(sales: DataFrame) -> DataFrame:
    return sales.withColumn("is_guest", F.col("customer_id").isNull())


def filter_country(sales: DataFrame, dropped: str = P.UNSPECIFIED_COUNTRY) -> DataFrame:
    """Drop ``country == dropped``; a missing country is kept."""
    return sales.filter(~F.col("country").eqNullSafe(dropped))


def add_revenue_calendar(sales: DataFrame) -> DataFrame:
    return sales.withColumns({
        "revenue": F.round(F.col("quantity") * F.col("unit_price"), 2).cast(MONEY),
        "year": F.year("invoice_date"),
        "month": F.month("invoice_date"),
    })


CLEAN_COLUMNS = ["invoice_no", "stock_code", "description", "quantity", "invoice_date",
                 "unit_price", "customer_id", "country", "is_guest", "revenue", "year", "month"]
RETURN_COLUMNS = ["invoice_no", "stock_code", "description", "quantity", "invoice_date",
                  "unit_price", "customer_id", "country"]


def clean(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    sales, returns = split_sales_returns(raw)
    sales = filter_valid_lines(filter_product_codes(sales))
    sales = impute_description(sales)
    sales = filter_country(flag_guests(sales))
    sales = add_revenue_calendar(sales)
    price = F.round("unit_price", 2).cast(PRICE)
    return sales.withColumn("unit_price", price).select(*CLEAN_COLUMNS), \
        returns.withColumn("unit_price", price).select(*RETURN_COLUMNS)


def cleaning_report(raw: DataFrame, sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Rows kept / returned / dropped, distinct customers, products, invoices, revenue.
    The distinct counts are merged from one set of bitmaps a month."""
    n_raw = raw.agg(F.count(F.lit(1))).scalar()
    n_ret = returns.agg(F.count(F.lit(1))).scalar()
    names = {"customer_id": "customers", "stock_code": "products", "invoice_no": "invoices"}
    keys = merged_counts(distinct_bitmaps(sales, list(names), ["year", "month"]))
    # one row, also without sales; ``keys`` has one row per column
    distinct = keys.agg(*[F.coalesce(F.max(F.when(F.col("column") == c, F.col("n"))), F.lit(0))
                          .alias(out) for c, out in names.items()]) \
        .select(F.struct(*names.values())).scalar()
    agg = sales.agg(
        F.count(F.lit(1)).alias("clean_rows"),
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("rev")) \
        .withColumns({out: distinct[out] for out in names.values()})
    return agg.select(
        n_raw.alias("raw_rows"), "clean_rows", n_ret.alias("return_rows"),
        (n_raw - F.col("clean_rows")).alias("dropped_rows"),
        F.round(((F.lit(1.0) - F.col("clean_rows").cast("double") / n_raw.cast("double"))
                 * F.lit(100.0)).cast("decimal(38,9)"), 1).cast("double").alias("dropped_pct"),
        "customers", "products", "invoices", F.col("rev").cast("double").alias("revenue"))
