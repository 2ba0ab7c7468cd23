"""Data-quality checks that stand in for database constraints, and profiles.

Every check is an aggregation that returns a small report DataFrame; nothing
fails the job, so a caller decides what to do with violations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.numeric import dround, pct
from tillsight.model import Retail
from tillsight.operators.selection import exact_percentiles

# NOT NULL columns of each star table
NOT_NULL = {
    "customers": ["customer_id", "country", "is_guest"],
    "products": ["stock_code", "unit_price"],
    "invoices": ["invoice_no", "customer_id", "country", "invoice_date", "year", "month",
                 "is_guest"],
    "invoice_items": ["invoice_no", "stock_code", "quantity", "unit_price"],
    "returns": ["invoice_no", "quantity", "invoice_date"],
}
PRIMARY_KEYS = {"customers": "customer_id", "products": "stock_code", "invoices": "invoice_no"}


def _tables(r: Retail) -> dict[str, DataFrame]:
    return {"customers": r.customers, "products": r.products, "invoices": r.invoices,
            "invoice_items": r.items, "returns": r.returns}


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dq_not_null(r: Retail) -> DataFrame:
    """``(table, column, nulls)`` for every NOT NULL column."""
    parts = []
    for table, df in _tables(r).items():
        cols = NOT_NULL[table]
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        parts.append(counts.unpivot([], cols, "column", "nulls")
                     .select(F.lit(table).alias("table"), "column", "nulls"))
    return _union(parts)


def dq_check(r: Retail) -> DataFrame:
    """``(table, check, violations)`` for the CHECK constraints."""
    checks = [
        ("invoice_items", "quantity > 0", r.items, F.col("quantity") > 0),
        ("invoice_items", "unit_price > 0", r.items, F.col("unit_price") > 0),
        ("products", "unit_price > 0", r.products, F.col("unit_price") > 0),
    ]
    return _union([df.agg(F.count_if(~F.coalesce(cond, F.lit(True))).alias("violations"))
                   .select(F.lit(t).alias("table"), F.lit(c).alias("check"), "violations")
                   for t, c, df, cond in checks])


def dq_pk_dups(r: Retail) -> DataFrame:
    """``(table, key, rows, distinct_keys, duplicate_keys)`` per primary key."""
    tables = _tables(r)
    parts = []
    for table, key in PRIMARY_KEYS.items():
        per_key = tables[table].groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count(F.lit(1)).alias("distinct_keys"),
            F.count_if(F.col("n") > 1).alias("duplicate_keys"))
            .select(F.lit(table).alias("table"), F.lit(key).alias("key"), "rows",
                    "distinct_keys", "duplicate_keys"))
    return _union(parts)


def dq_fk_orphans(r: Retail) -> DataFrame:
    """``(table, fk, parent, orphans)``: non-null keys without a parent row."""
    links = [
        ("invoices", "customer_id", "customers", r.invoices, r.customers),
        ("invoice_items", "invoice_no", "invoices", r.items, r.invoices),
        ("invoice_items", "stock_code", "products", r.items, r.products),
        ("returns", "customer_id", "customers", r.returns, r.customers),
        ("returns", "stock_code", "products", r.returns, r.products),
    ]
    parts = []
    for table, fk, parent, child, par in links:
        # rows per key first (partial aggregation), so the anti-join moves one
        # row per distinct key instead of every child row
        per_key = child.filter(F.col(fk).isNotNull()).groupBy(fk) \
            .agg(F.count(F.lit(1)).alias("n"))
        orphans = per_key.join(par.select(fk), fk, "left_anti")
        parts.append(orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans")).select(
            F.lit(table).alias("table"), F.lit(fk).alias("fk"), F.lit(parent).alias("parent"),
            "orphans"))
    return _union(parts)


def dq_profile(raw: DataFrame) -> DataFrame:
    """Rows, and count and % of ``quantity <= 0``, ``unit_price <= 0``, no customer."""
    return raw.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("quantity") <= 0).alias("qty_le_0"),
        F.count_if(F.col("unit_price") <= 0).alias("price_le_0"),
        F.count_if(F.col("customer_id").isNull()).alias("no_customer"),
    ).select("rows",
             "qty_le_0", pct("qty_le_0", "rows", 1).alias("qty_le_0_pct"),
             "price_le_0", pct("price_le_0", "rows", 1).alias("price_le_0_pct"),
             "no_customer", pct("no_customer", "rows", 1).alias("no_customer_pct"))


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, 25 %, 50 %, 75 %, max per column (one row each).

    The columns are unpivoted into one long table (a single scan); sums stay
    exact decimals, the spread is computed on doubles.  Percentiles are exact, by
    :func:`tillsight.operators.selection.exact_percentiles`."""
    long = df.select(*[F.col(c).cast("decimal(38,6)").alias(c) for c in columns]) \
        .unpivot([], columns, "column", "x") \
        .select("column", "x", F.col("x").cast("double").alias("v"))
    moments = long.groupBy("column").agg(
        F.count("x").alias("count"),
        F.sum("x").alias("s"),
        F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"))
    # one row per column
    rows = moments.collect()
    q = exact_percentiles(long.select("column", "v"), [0.25, 0.5, 0.75], {
        r["column"]: (r["count"], r["min"], r["max"]) for r in rows if r["count"]})
    nothing = [None] * 3
    schema = moments.schema.add("p0", "double").add("p1", "double").add("p2", "double")
    found = df.sparkSession.createDataFrame([(*r, *q.get(r["column"], nothing)) for r in rows],
                                            schema)
    return found.select(
        "column", "count",
        dround(F.col("s").cast("double") / F.col("count").cast("double"), 6).alias("mean"),
        dround("std", 6).alias("std"), "min",
        dround("p0", 6).alias("p25"), dround("p1", 6).alias("p50"),
        dround("p2", 6).alias("p75"), "max")


def customer_orphans(customers: DataFrame) -> DataFrame:
    """Registered customers with sales vs those seen only in returns."""
    return customers.agg(
        F.count_if(~F.col("is_guest") & F.col("first_purchase").isNotNull())
        .alias("with_sales"),
        F.count_if(~F.col("is_guest") & F.col("first_purchase").isNull()).alias("returns_only"),
        F.count(F.lit(1)).alias("total"))
