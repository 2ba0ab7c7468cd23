"""The executive dashboard's numbers: KPI layer and the four report tabs.

Every function takes a :class:`Retail` that may already carry the dashboard
filter (:meth:`Retail.filtered`: years and countries, applied to invoice headers
and returns alike, so the predicates reach the Parquet scans).  Line-level
reports group by the line's own description where the line table has it; else by stock
code, and only then meet the product dimension for the description, so the wide line
table is never joined with products.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight import params as P
from tillsight.functions.labels import customer_name, ellipsize, year_month
from tillsight.functions.numeric import as_double, ddiv, pct
from tillsight.model import Retail
from tillsight.operators.histogram import equal_width_histogram
from tillsight.operators.ordered import with_row_numbers


# -- KPI cards -----------------------------------------------------------------------

def _units_returned(r: Retail) -> F.Column:
    return r.returns.agg(F.coalesce(F.sum(F.abs("quantity")), F.lit(0)).cast("long")).scalar()


def _return_rate(sold: F.Column, returned: F.Column) -> F.Column:
    """returned / (sold + returned) · 100, or 0 when both are 0."""
    total = (sold + returned).cast("double")
    return F.when(total > 0, returned.cast("double") / total * F.lit(100.0)).otherwise(F.lit(0.0))


def kpi_cards(r: Retail) -> DataFrame:
    """Revenue, orders, registered customers, average order value, return rate."""
    inv = r.invoice_totals()
    sold = inv.agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("rev"),
        F.count(F.lit(1)).alias("total_orders"),
        F.count_distinct(F.when(~F.col("is_guest"), F.col("customer_id")))
        .alias("total_customers"),
        F.coalesce(F.sum("units"), F.lit(0)).cast("long").alias("units_sold"))
    # the returned units are a scalar subquery, bound once as a column
    return sold.withColumn("units_returned", _units_returned(r)).select(
        as_double("rev").alias("total_revenue"), "total_orders", "total_customers",
        ddiv("rev", "total_orders").alias("avg_order_value"),
        "units_sold", "units_returned",
        _return_rate(F.col("units_sold"), F.col("units_returned")).alias("return_rate_pct"))


# -- tab 1: revenue trends -----------------------------------------------------------

def monthly_rolling_avg(r: Retail, window_rows: int = 3) -> DataFrame:
    """Revenue per ``yyyy-MM`` and the mean of the last ``window_rows`` months shown
    (rows, not calendar months; fewer rows at the start)."""
    monthly = r.invoice_totals().groupBy(year_month("invoice_date").alias("year_month")) \
        .agg(F.sum("revenue").alias("rev"))
    # one row per calendar month: bounded
    w = Window.orderBy("year_month").rowsBetween(-(window_rows - 1), Window.currentRow)
    return monthly.select(
        "year_month", as_double("rev").alias("revenue"),
        (as_double(F.sum("rev").over(w)) / F.count(F.lit(1)).over(w)).alias("rolling_avg"))


def revenue_by_year(r: Retail) -> DataFrame:
    yearly = r.invoice_totals().groupBy("year").agg(F.sum("revenue").alias("rev"))
    total = r.invoice_totals().agg(F.sum("revenue")).scalar()
    return yearly.select("year", as_double("rev").alias("revenue"),
                         pct("rev", total, 2).alias("share_pct"))


def top10_countries(r: Retail, k: int = 10) -> DataFrame:
    return (r.invoice_totals().filter(F.col("country").isNotNull())
            .groupBy("country").agg(F.sum("revenue").alias("rev"))
            .orderBy(F.col("rev").desc(), "country").limit(k)
            .select("country", as_double("rev").alias("revenue")))


def heatmap_month_year(r: Retail) -> DataFrame:
    """Year × month revenue matrix; all twelve month columns, NULL where no sales."""
    months = list(range(1, 13))
    piv = r.invoice_totals().groupBy("year").pivot("month", months).agg(F.sum("revenue"))
    names = {str(m): _month_name(m) for m in months}
    return piv.select("year", *[as_double(F.col(str(m))).alias(names[str(m)]) for m in months])


def _month_name(m: int) -> str:
    # English three-letter month names, as date_format(…, 'MMM') prints them
    return ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov",
            "Dec"][m - 1]


# -- tab 2: products -----------------------------------------------------------------

def by_description(r: Retail, lines: DataFrame | None = None) -> DataFrame:
    """Line measures per product description (NULL descriptions dropped):
    revenue, units, sum of unit prices and line count."""
    lines = lines if lines is not None else r.sales()
    if "description" in lines.columns:  # the line's own text, as in the flat export
        return lines.filter(F.col("description").isNotNull()).groupBy("description").agg(
            F.sum("revenue").alias("rev"), F.sum("quantity").alias("qty"),
            F.sum("unit_price").alias("price_sum"), F.count(F.lit(1)).alias("n_lines"))
    per_code = lines.groupBy("stock_code").agg(
        F.sum("revenue").alias("rev"), F.sum("quantity").alias("qty"),
        F.sum("unit_price").alias("price_sum"), F.count(F.lit(1)).alias("n_lines"))
    named = per_code.join(r.products.select("stock_code", "description"), "stock_code") \
        .filter(F.col("description").isNotNull())
    return named.groupBy("description").agg(
        F.sum("rev").alias("rev"), F.sum("qty").alias("qty"),
        F.sum("price_sum").alias("price_sum"), F.sum("n_lines").alias("n_lines"))


def top10_products(r: Retail, k: int = 10) -> DataFrame:
    """Top products by revenue with a chart label cut at 28 characters."""
    return (by_description(r).orderBy(F.col("rev").desc(), "description").limit(k)
            .select("description", ellipsize("description").alias("label"),
                    as_double("rev").alias("revenue")))


def top10_units(r: Retail, k: int = 10) -> DataFrame:
    return (by_description(r).orderBy(F.col("qty").desc(), "description").limit(k)
            .select("description", F.col("qty").cast("long").alias("quantity")))


def pareto_ranked(r: Retail) -> DataFrame:
    """Descriptions by revenue with row rank and ROWS-frame cumulative share."""
    desc = by_description(r).select("description", "rev")
    total = desc.agg(F.sum("rev")).scalar()
    ranked = with_row_numbers(desc, [("rev", False), ("description", True)],
                              row_number="rank", running_sums={"cum": "rev"})
    return ranked.select(
        F.col("rank").cast("long").alias("rank"), "description",
        as_double("rev").alias("revenue"),
        (as_double("cum") / as_double(total) * F.lit(100.0)).alias("cumulative_pct"))


def pareto_rows(r: Retail, head: int = 300) -> DataFrame:
    """The first ``head`` ranks of the row-wise Pareto curve (the chart's window): a bounded
    top-k, ranked and summed over its ``head`` rows alone."""
    desc = by_description(r).select("description", "rev")
    order = [F.col("rev").desc(), F.col("description")]
    top = Window.orderBy(*order)
    total = desc.agg(F.sum("rev")).scalar()
    return desc.orderBy(*order).limit(head).select(
        F.row_number().over(top).cast("long").alias("rank"), "description",
        as_double("rev").alias("revenue"),
        (as_double(F.sum("rev").over(top.rowsBetween(Window.unboundedPreceding, 0)))
         / as_double(total) * F.lit(100.0)).alias("cumulative_pct"))


def pareto_cutoff(r: Retail, threshold: float = P.PARETO_PCT) -> DataFrame:
    """Highest rank whose cumulative share is still ≤ threshold (NULL if none)."""
    return pareto_ranked(r).agg(
        F.max(F.when(F.col("cumulative_pct") <= threshold, F.col("rank"))).alias("cutoff_rank"),
        F.count(F.lit(1)).alias("products"))


def price_volume_top200(r: Retail, k: int = 200) -> DataFrame:
    """Revenue, units and mean line price per description, top k by revenue."""
    return (by_description(r).orderBy(F.col("rev").desc(), "description").limit(k)
            .select("description", as_double("rev").alias("total_revenue"),
                    F.col("qty").cast("long").alias("total_qty"),
                    ddiv("price_sum", "n_lines").alias("avg_price")))


# -- tab 3: customers ----------------------------------------------------------------

def revenue_guest_split(r: Retail) -> DataFrame:
    g = r.invoice_totals().groupBy("is_guest").agg(F.sum("revenue").alias("rev"))
    total = r.invoice_totals().agg(F.sum("revenue")).scalar()
    return g.select("is_guest",
                    F.when(F.col("is_guest"), F.lit("Guest")).otherwise(F.lit("Registered"))
                    .alias("type"),
                    as_double("rev").alias("revenue"), pct("rev", total, 2).alias("share_pct"))


def _registered_revenue(r: Retail) -> DataFrame:
    return r.invoice_totals().filter(~F.col("is_guest")).groupBy("customer_id") \
        .agg(F.sum("revenue").alias("rev"), F.min("invoice_date").alias("first_date"))


def top10_customers(r: Retail, k: int = 10) -> DataFrame:
    return (_registered_revenue(r).orderBy(F.col("rev").desc(), "customer_id").limit(k)
            .select("customer_id", customer_name("customer_id").alias("label"),
                    as_double("rev").alias("revenue")))


def new_customers_monthly(r: Retail) -> DataFrame:
    """Customers by month of their first purchase within the selection."""
    return _registered_revenue(r).groupBy(year_month("first_date").alias("year_month")) \
        .agg(F.count(F.lit(1)).alias("new_customers"))


def hist_customer_revenue(r: Retail, bins: int = 50) -> DataFrame:
    per_customer = _registered_revenue(r).select(as_double("rev").alias("revenue"))
    return equal_width_histogram(per_customer, "revenue", bins, count_name="customers")


# -- tab 4: returns ------------------------------------------------------------------

def returns_kpis(r: Retail) -> DataFrame:
    """Return lines, revenue lost (|qty| × price) and return rate; no row when the
    selection has no returns."""
    sold = r.invoice_totals().agg(F.coalesce(F.sum("units"), F.lit(0))).scalar()
    agg = r.returns.agg(
        F.count(F.lit(1)).alias("total_returns"),
        F.sum(F.abs("quantity") * F.col("unit_price")).alias("lost"),
        F.coalesce(F.sum(F.abs("quantity")), F.lit(0)).cast("long").alias("units_returned"))
    return agg.filter(F.col("total_returns") > 0).withColumn("__sold", sold).select(
        "total_returns", as_double("lost").alias("revenue_lost"), "units_returned",
        _return_rate(F.col("__sold"), F.col("units_returned")).alias("return_rate_pct"))


def returns_by_country(r: Retail, k: int = 10) -> DataFrame:
    return (r.returns.filter(F.col("country").isNotNull()).groupBy("country")
            .agg(F.count(F.lit(1)).alias("return_count"))
            .orderBy(F.col("return_count").desc(), "country").limit(k))


def returns_by_product(r: Retail, k: int = 10) -> DataFrame:
    if "description" in r.returns.columns:
        return (r.returns.filter(F.col("description").isNotNull()).groupBy("description")
                .agg(F.count(F.lit(1)).alias("return_count"))
                .orderBy(F.col("return_count").desc(), "description").limit(k))
    per_code = r.returns.groupBy("stock_code").agg(F.count(F.lit(1)).alias("n"))
    named = per_code.join(r.products.select("stock_code", "description"), "stock_code") \
        .filter(F.col("description").isNotNull())
    return (named.groupBy("description").agg(F.sum("n").alias("return_count"))
            .orderBy(F.col("return_count").desc(), "description").limit(k))


def returns_monthly(r: Retail) -> DataFrame:
    return r.returns.groupBy(year_month("invoice_date").alias("year_month")) \
        .agg(F.count(F.lit(1)).alias("returns"))


def filter_options(r: Retail) -> DataFrame:
    """Distinct years and countries offered by the filter (invoices with sales)."""
    inv = r.invoice_totals()
    years = inv.select(F.lit("year").alias("field"), F.col("year").cast("string").alias("value"))
    countries = inv.filter(F.col("country").isNotNull()) \
        .select(F.lit("country").alias("field"), F.col("country").alias("value"))
    return years.union(countries).distinct()

