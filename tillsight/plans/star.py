"""Star schema from the flat clean tables (customers, products, invoices, items,
returns), with the loader's rules:

* customers: registered ids from sales, then ids seen only in returns (first
  occurrence wins: sales before returns, then by invoice date, invoice, code);
  first / last purchase from sales; plus the guest member;
* products: every code in sales or returns; price = exact median of line prices;
  description = modal sales description (ties → smallest);
* invoices: one row per sales invoice (first line wins), guest id → ``GUEST_ID``;
* items: sales lines of kept invoices, ``revenue = quantity × unit_price``;
* sales lines without an invoice or a code, and return lines without a code, are not
  loaded;
* returns: lines of known codes, ``|quantity|``, unknown or missing customer →
  ``GUEST_ID``, ``revenue_lost = quantity × unit_price``.

Keep-first is ``min_by`` over an explicit order — an aggregate with partial
aggregation, so no group is sorted in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight import params as P
from tillsight.functions.numeric import MONEY, PRICE
from tillsight.model import Retail
from tillsight.operators.grouped import grouped_mode, median_of_counts, value_counts


def _customer_key(col: F.Column) -> F.Column:
    return col.cast("long")


def loadable(sales: DataFrame, returns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines that have the keys the star needs."""
    return sales.filter(F.col("invoice_no").isNotNull() & F.col("stock_code").isNotNull()), \
        returns.filter(F.col("stock_code").isNotNull())


def dim_customers(sales: DataFrame, returns: DataFrame) -> DataFrame:
    spark = sales.sparkSession
    from_sales = sales.filter(~F.col("is_guest") & F.col("customer_id").isNotNull()).select(
        _customer_key(F.col("customer_id")).alias("customer_id"), "country",
        F.lit(0).alias("src"), "invoice_date", "invoice_no", "stock_code")
    from_returns = returns.filter(F.col("customer_id").isNotNull()
                                  & (F.col("customer_id") != P.GUEST_ID)).select(
        _customer_key(F.col("customer_id")).alias("customer_id"), "country",
        F.lit(1).alias("src"), "invoice_date", "invoice_no", "stock_code")
    order = F.struct("src", "invoice_date", "invoice_no", "stock_code")
    sale_date = F.when(F.col("src") == 0, F.col("invoice_date"))
    # one aggregation (one shuffle) gives the keep-first country and the purchase
    # dates, which come from the sales side only
    customers = from_sales.unionByName(from_returns).groupBy("customer_id").agg(
        F.min_by("country", order).alias("country"),
        F.min(sale_date).alias("first_purchase"),
        F.max(sale_date).alias("last_purchase"))
    return customers.select(
        "customer_id", "country", F.lit(False).alias("is_guest"),
        "first_purchase", "last_purchase").unionByName(guest_member(spark))


def guest_member(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(P.GUEST_ID, P.GUEST_COUNTRY, True, None, None)],
        T.StructType([
            T.StructField("customer_id", T.LongType(), False),
            T.StructField("country", T.StringType(), True),
            T.StructField("is_guest", T.BooleanType(), False),
            T.StructField("first_purchase", T.TimestampNTZType(), True),
            T.StructField("last_purchase", T.TimestampNTZType(), True),
        ]))


def _priced_lines(sales: DataFrame, returns: DataFrame) -> DataFrame:
    return sales.select("stock_code", "unit_price").unionByName(
        returns.select("stock_code", "unit_price"))


def price_counts(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """How often each code has each price."""
    return value_counts(_priced_lines(sales, returns), "stock_code", "unit_price")


def dim_products(sales: DataFrame, returns: DataFrame,
                 keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> DataFrame:
    # the median takes every line's price, the mode only sales descriptions
    prices = keep("prices", price_counts(sales, returns))
    medians = keep("medians", median_of_counts(prices, "stock_code", "median_price"))
    descriptions = keep("descriptions", grouped_mode(sales, "stock_code", "description"))
    per_code = _priced_lines(sales, returns).select("stock_code").distinct() \
        .join(medians, "stock_code", "left") \
        .join(descriptions, "stock_code", "left")
    return per_code.select(
        "stock_code", "description",
        F.round(F.col("median_price").cast("decimal(38,9)"), 2).cast(PRICE).alias("unit_price"))


def dim_invoices(sales: DataFrame) -> DataFrame:
    order = F.struct("invoice_date", "stock_code", "quantity", "unit_price")
    attrs = F.struct("customer_id", "country", "invoice_date", "year", "month", "is_guest")
    first = sales.groupBy("invoice_no").agg(F.min_by(attrs, order).alias("a"))
    return first.select(
        "invoice_no",
        F.coalesce(_customer_key(F.col("a.customer_id")), F.lit(P.GUEST_ID).cast("long"))
        .alias("customer_id"),
        "a.country", "a.invoice_date", "a.year", "a.month", "a.is_guest")


def fact_items(sales: DataFrame, invoices: DataFrame | None = None) -> DataFrame:
    """Sales lines whose invoice is in ``invoices`` (no filter when ``None``)."""
    kept = sales if invoices is None else \
        sales.join(invoices.select("invoice_no"), "invoice_no", "left_semi")
    return kept.select(
        "invoice_no", "stock_code", "quantity", "unit_price",
        (F.col("quantity") * F.col("unit_price")).cast(MONEY).alias("revenue"))


def reassign_orphans(returns: DataFrame, customers: DataFrame) -> DataFrame:
    """Customer ids missing from the customer dimension become the guest id.

    Guest lines (no id) skip the lookup: the guest member is always present and
    the guest id is the hottest key, so only identified lines are joined."""
    cid = F.coalesce(_customer_key(F.col("customer_id")), F.lit(P.GUEST_ID).cast("long"))
    tagged = returns.withColumn("__cid", cid)
    guests = tagged.filter(F.col("__cid") == P.GUEST_ID) \
        .withColumn("reassigned", F.lit(False))
    known = customers.select(F.col("customer_id").alias("__known"))
    others = tagged.filter(F.col("__cid") != P.GUEST_ID) \
        .join(known, F.col("__cid") == F.col("__known"), "left") \
        .withColumn("reassigned", F.col("__known").isNull()) \
        .withColumn("__cid", F.when(F.col("__known").isNull(), F.lit(P.GUEST_ID).cast("long"))
                    .otherwise(F.col("__cid"))) \
        .drop("__known")
    return guests.unionByName(others).withColumn("customer_id", F.col("__cid")).drop("__cid")


def fact_returns(returns: DataFrame, products: DataFrame | None,
                 customers: DataFrame) -> DataFrame:
    """Returns of known codes (no code filter when ``products`` is ``None``)."""
    known = returns if products is None else \
        returns.join(products.select("stock_code"), "stock_code", "left_semi")
    fixed = reassign_orphans(known.withColumn("quantity", F.abs("quantity")), customers)
    text = ["description"] if "description" in returns.columns else []
    return fixed.select(
        "invoice_no", "customer_id", "stock_code", "country", "quantity", "unit_price",
        "invoice_date",
        (F.col("quantity") * F.col("unit_price")).cast(MONEY).alias("revenue_lost"), *text)


def flat_lines(sales: DataFrame) -> DataFrame:
    """The dashboard's line table: the line's own description and country."""
    return sales.select(
        "invoice_no", "stock_code", "description", "quantity", "unit_price", "revenue",
        _customer_key(F.col("customer_id")).alias("customer_id"), "country", "invoice_date",
        "year", "month", "is_guest")


def build(sales: DataFrame, returns: DataFrame,
          keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> Retail:
    """All five tables.

    ``keep`` may store a table under its name, or one of the products' parts (``prices``,
    ``medians``, ``descriptions``); later ones then read it.

    The loader's membership filters are satisfied by construction here, so they
    are not re-run as joins over the facts: every sales invoice is in the invoice
    table (it is built from those lines) and every returned code is in the product
    table (built from sales ∪ returns codes).  ``dq_fk_orphans`` checks both.
    Customer reassignment stays a lookup, for returns loaded beside an older dimension.
    """
    sales, returns = loadable(sales, returns)
    customers = keep("customers", dim_customers(sales, returns))
    products = keep("products", dim_products(sales, returns, keep))
    invoices = keep("invoices", dim_invoices(sales))
    return Retail(invoices=invoices, items=keep("items", fact_items(sales)),
                  returns=keep("fact_returns", fact_returns(returns, None, customers)),
                  products=products, customers=customers)


def row_counts(r: Retail) -> DataFrame:
    """Post-load reconciliation: ``(table, rows)`` for the five tables."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
             for name, df in (("customers", r.customers), ("products", r.products),
                              ("invoices", r.invoices), ("invoice_items", r.items),
                              ("returns", r.returns))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
