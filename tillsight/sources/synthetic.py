"""Canonical star schema from the TPC-H-style test tables.

Mapping (see FIXTURES.md §2):

* invoices  ← orders ⋈ customer ⋈ nation; guest ⇔ ``o_orderpriority = GUEST_PRIORITY``
* items     ← lineitem with ``l_returnflag <> 'R'``; revenue = extended price
* returns   ← lineitem with ``l_returnflag = 'R'`` ⋈ its invoice (date, customer, country)
* products  ← part
* customers ← customer ⋈ nation, first/last purchase from non-guest invoices with
  sale lines, plus the guest member

``nation`` is a fixed 25-row table; every other join is left to the planner
(broadcast under the size threshold, sort-merge above it, AQE re-plans at run time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.functions.numeric import MONEY, PRICE
from tillsight.model import Retail
from tillsight.params import GUEST_ID, GUEST_PRIORITY, UNSPECIFIED_COUNTRY
from tillsight.sources.tables import read_table


def _unit_price(revenue_dbl: F.Column, qty: F.Column) -> F.Column:
    # price per unit, fixed to cents half-up (same rule as functions.numeric.dround)
    return F.round((revenue_dbl / qty).cast("decimal(38,9)"), 2).cast(PRICE)


def _customer_country(spark: SparkSession, folder: str) -> DataFrame:
    c = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, folder, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name")


def invoices(spark: SparkSession, folder: str) -> DataFrame:
    o = read_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    guest = F.col("o_orderpriority") == F.lit(GUEST_PRIORITY)
    return o.join(_customer_country(spark, folder), o.o_custkey == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("invoice_no"),
        F.when(guest, F.lit(GUEST_ID).cast("long")).otherwise(F.col("o_custkey"))
        .alias("customer_id"),
        F.col("n_name").alias("country"),
        F.col("o_orderdate").alias("invoice_date"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        guest.alias("is_guest"),
    )


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_returnflag")


def items(spark: SparkSession, folder: str) -> DataFrame:
    li = _lines(spark, folder).filter(F.col("l_returnflag") != F.lit("R"))
    return li.select(
        F.col("l_orderkey").alias("invoice_no"),
        F.col("l_partkey").alias("stock_code"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _unit_price(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
        F.col("l_extendedprice").cast(MONEY).alias("revenue"),
    )


def returns(spark: SparkSession, folder: str, inv: DataFrame | None = None) -> DataFrame:
    inv = inv if inv is not None else invoices(spark, folder)
    li = _lines(spark, folder).filter(F.col("l_returnflag") == F.lit("R"))
    joined = li.join(inv.select("invoice_no", "customer_id", "country", "invoice_date"),
                     li.l_orderkey == F.col("invoice_no"))
    return joined.select(
        "invoice_no",
        "customer_id",
        F.col("l_partkey").alias("stock_code"),
        "country",
        F.col("l_quantity").cast("int").alias("quantity"),
        _unit_price(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
        "invoice_date",
        F.col("l_extendedprice").cast(MONEY).alias("revenue_lost"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("stock_code"),
        F.col("p_name").alias("description"),
        F.col("p_retailprice").cast(PRICE).alias("unit_price"),
    )


def customer_base(spark: SparkSession, folder: str) -> DataFrame:
    """Registered customers with their country, plus the guest member (no dates)."""
    from tillsight.plans.star import guest_member
    registered = _customer_country(spark, folder).select(
        F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("country"),
        F.lit(False).alias("is_guest"))
    return registered.unionByName(guest_member(spark).select(*registered.columns))


def add_purchase_dates(base: DataFrame, invoices_with_sales: DataFrame) -> DataFrame:
    """First / last purchase of each customer over invoices that have sale lines
    (guest invoices excluded; the guest member keeps NULL dates)."""
    dates = invoices_with_sales.filter(~F.col("is_guest")).groupBy("customer_id").agg(
        F.min("invoice_date").alias("first_purchase"),
        F.max("invoice_date").alias("last_purchase"))
    return base.join(dates, "customer_id", "left").select(
        "customer_id", "country", "is_guest", "first_purchase", "last_purchase")


def customers(spark: SparkSession, folder: str, inv: DataFrame | None = None,
              itm: DataFrame | None = None) -> DataFrame:
    inv = inv if inv is not None else invoices(spark, folder)
    itm = itm if itm is not None else items(spark, folder)
    with_sales = inv.join(itm.select("invoice_no"), "invoice_no", "left_semi")
    return add_purchase_dates(customer_base(spark, folder), with_sales)


def load(spark: SparkSession, folder: str) -> Retail:
    inv = invoices(spark, folder)
    itm = items(spark, folder)
    return Retail(
        invoices=inv,
        items=itm,
        returns=returns(spark, folder, inv),
        products=products(spark, folder),
        customers=customers(spark, folder, inv, itm),
    )


def raw_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """The test tables as a raw transaction export (snake_case columns).

    Return lines (``l_returnflag = 'R'``) get a ``C`` invoice prefix and a
    negative quantity, as the export writes them; guests have no customer id
    (float id otherwise); the description is the part name.

    The tables themselves break no cleaning rule, so key remainders put every
    kind of bad line into the export: service, letter and missing codes, missing
    and second descriptions, sales without invoice or with a negative quantity,
    zero prices, unspecified and missing countries, and customers that only return.
    """
    ret = F.col("l_returnflag") == F.lit("R")
    o = read_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    header = o.join(_customer_country(spark, folder), o.o_custkey == F.col("c_custkey"))
    part = read_table(spark, folder, "part").select("p_partkey", "p_name")
    # parts first, while the lines are narrow; the lines of an order then come out together
    lines = _lines(spark, folder) \
        .join(part, F.col("l_partkey") == F.col("p_partkey"), "left") \
        .join(header, F.col("l_orderkey") == F.col("o_orderkey"))
    qty = F.col("l_quantity").cast("int")
    order, part_key, customer = F.col("l_orderkey"), F.col("l_partkey"), F.col("o_custkey")
    line = F.col("l_linenumber")
    null = F.lit(None)
    no_id = (F.col("o_orderpriority") == F.lit(GUEST_PRIORITY)) | (~ret & (customer % 23 == 3))
    return lines.select(
        F.when(ret, F.concat(F.lit("C"), order.cast("string")))
        .when(order % 83 == 9, null)
        .otherwise(order.cast("string")).alias("invoice_no"),
        F.when((order + line) % 89 == 0, null)
        .when(part_key % 97 == 5, F.lit("POST"))
        .when(part_key % 97 == 6, F.concat(F.lit("GIFT"), part_key.cast("string")))
        .otherwise(part_key.cast("string")).alias("stock_code"),
        F.when((order * 7 + line) % 13 == 0, null)
        .when((order + line) % 5 == 1, F.concat("p_name", F.lit(" NEW")))
        .otherwise(F.col("p_name")).alias("description"),
        F.when(ret | ((order + line * 3) % 31 == 4), -qty).otherwise(qty).alias("quantity"),
        F.col("o_orderdate").alias("invoice_date"),
        F.when(((order + line * 5) % 37 == 6) | (part_key % 97 == 6), F.lit(0).cast(PRICE))
        .otherwise(_unit_price(F.col("l_extendedprice"), F.col("l_quantity")))
        .alias("unit_price"),
        F.when(no_id, null.cast("double")).otherwise(customer.cast("double"))
        .alias("customer_id"),
        F.when(customer % 29 == 7, F.lit(UNSPECIFIED_COUNTRY))
        .when(customer % 31 == 8, null)
        .otherwise(F.col("n_name")).alias("country"),
    )
