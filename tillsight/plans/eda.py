"""The exploratory analysis: headline KPIs and the five business questions.

It looks at all lines of the raw export with a positive quantity and price: service lines, letter
codes and lines without an invoice count as well, and every line has its own date, country and
customer.  The reports read the lines summed per (invoice, customer, country, date)
(:func:`tillsight.plans.etl.eda_totals`), which loses nothing that they ask for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight import params as P
from tillsight.functions.labels import weekday_name, year_month
from tillsight.functions.numeric import as_double, ddiv, pct
from tillsight.operators.histogram import equal_width_histogram


def _keys(summary: DataFrame, column: str) -> F.Column:
    """Number of distinct non-null keys; partial counts per key, no Expand."""
    return summary.filter(F.col(column).isNotNull()).select(column).distinct() \
        .agg(F.count(F.lit(1))).scalar()


def kpi_overview(summary: DataFrame) -> DataFrame:
    """Total revenue, orders, identified customers and average ticket.  Lines without an
    invoice count in the total, but belong to no ticket."""
    agg = summary.agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("rev"),
        F.sum(F.when(F.col("invoice_no").isNotNull(), F.col("revenue"))).alias("ticketed")) \
        .withColumns({"total_orders": _keys(summary, "invoice_no"),
                      "total_customers": _keys(summary, "customer_id")})
    return agg.select(as_double("rev").alias("total_revenue"), "total_orders",
                      "total_customers", ddiv("ticketed", "total_orders").alias("avg_ticket"))


def _monthly(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("invoice_date").isNotNull()) \
        .groupBy(year_month("invoice_date").alias("year_month")) \
        .agg(F.sum("revenue").alias("rev"))


def peak_month(summary: DataFrame) -> DataFrame:
    """Month with the highest revenue (earliest month on a tie)."""
    return (_monthly(summary).orderBy(F.col("rev").desc(), "year_month").limit(1)
            .select("year_month", as_double("rev").alias("revenue")))


def _by_country(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("country").isNotNull()).groupBy("country") \
        .agg(F.sum("revenue").alias("rev"))


def home_market_share(summary: DataFrame, home: str = P.HOME_COUNTRY) -> DataFrame:
    """Home market vs the rest of the world: revenue and share of revenue (lines without a
    country are in neither)."""
    countries = _by_country(summary)
    market = F.when(F.col("country") == home, F.lit("home")).otherwise(F.lit("rest"))
    parts = countries.groupBy(market.alias("market")).agg(F.sum("rev").alias("rev"))
    total = countries.agg(F.sum("rev")).scalar()
    return parts.select("market", as_double("rev").alias("revenue"),
                        pct("rev", total, 2).alias("share_pct"))


def intl_markets(summary: DataFrame, home: str = P.HOME_COUNTRY, k: int = 9) -> DataFrame:
    """The k largest markets outside the home market."""
    return (_by_country(summary).filter(F.col("country") != home)
            .orderBy(F.col("rev").desc(), "country").limit(k)
            .select("country", as_double("rev").alias("revenue")))


def revenue_by_weekday(summary: DataFrame, days: list[str] = P.REPORTED_WEEKDAYS) -> DataFrame:
    """Revenue per reported weekday in display order (NULL for a day without sales)."""
    spark = summary.sparkSession
    order = spark.createDataFrame([(d, i + 1) for i, d in enumerate(days)],
                                  "weekday string, day_order int")
    by_day = summary.select(weekday_name("invoice_date").alias("weekday"), "revenue") \
        .filter(F.col("weekday").isin(list(days))) \
        .groupBy("weekday").agg(F.sum("revenue").alias("rev"))
    # the day list is a fixed handful of rows
    return order.join(by_day, "weekday", "left").select(
        "day_order", "weekday", as_double("rev").alias("revenue"))


def weekday_extremes(summary: DataFrame) -> DataFrame:
    """The weekday chart with the best and the worst day flagged."""
    days = revenue_by_weekday(summary)
    hi = days.agg(F.max("revenue")).scalar()
    lo = days.agg(F.min("revenue")).scalar()
    return days.select("day_order", "weekday", "revenue",
                       F.coalesce(F.col("revenue") == hi, F.lit(False)).alias("is_max"),
                       F.coalesce(F.col("revenue") == lo, F.lit(False)).alias("is_min"))


def _orders_per_customer(summary: DataFrame) -> DataFrame:
    """Invoices of each identified customer (none if no line of theirs has one)."""
    return summary.filter(F.col("customer_id").isNotNull()) \
        .select("customer_id", "invoice_no").distinct() \
        .groupBy("customer_id").agg(F.count("invoice_no").alias("orders"))


def retention_split(summary: DataFrame) -> DataFrame:
    """Repeat vs one-time buyers, mean and maximum orders per identified customer."""
    agg = _orders_per_customer(summary).agg(
        F.count_if(F.col("orders") > 1).alias("repeat_customers"),
        F.count_if(F.col("orders") == 1).alias("single_customers"),
        F.count(F.lit(1)).alias("customers"),
        F.sum("orders").alias("orders"),
        F.max("orders").alias("max_orders"))
    return agg.select("repeat_customers", "single_customers", "customers",
                      pct("repeat_customers", "customers", 2).alias("repeat_pct"),
                      ddiv("orders", "customers").alias("avg_orders"), "max_orders")


def hist_orders_per_customer(summary: DataFrame, cap: int = 20, bins: int = 20) -> DataFrame:
    """Orders per customer clipped at ``cap``, in ``bins`` equal-width bins."""
    clipped = _orders_per_customer(summary).select(F.least(F.col("orders"), F.lit(cap)).alias("orders"))
    return equal_width_histogram(clipped, "orders", bins, count_name="customers")
