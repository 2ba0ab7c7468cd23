"""The batch ETL: raw export → clean flat tables → star schema, plus its reports."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.labels import currency_short, delta_arrow, short_period, weekday_name, \
    year_month
from tillsight.functions.numeric import dround
from tillsight.model import Retail
from tillsight.operators import cleaning
from tillsight.plans import star, views


@dataclass(frozen=True)
class Cleaned:
    raw: DataFrame
    sales: DataFrame
    returns: DataFrame
    stored_star: Retail | None = None

    # optional stored summary of the exploratory lines
    eda: DataFrame | None = None

    def star(self) -> Retail:
        if self.stored_star is not None:
            return self.stored_star
        return star.build(self.sales, self.returns)

    def line_star(self) -> Retail:
        """The star whose line table is the flat export: a line has its own description."""
        lines = star.flat_lines(star.loadable(self.sales, self.returns)[0])
        return replace(self.star(), lines=lines)

    def eda_summary(self) -> DataFrame:
        return self.eda if self.eda is not None else eda_totals(self.raw)


def run_cleaning(raw: DataFrame) -> Cleaned:
    sales, returns = cleaning.clean(raw)
    return Cleaned(raw, sales, returns)


def eda_lines(raw: DataFrame) -> DataFrame:
    """The exploratory rule set: positive quantity and price only."""
    return raw.filter((F.col("quantity") > 0) & (F.col("unit_price") > 0)) \
        .withColumn("revenue", F.col("quantity") * F.col("unit_price"))


EDA_SUMMARY = ["invoice_no", "customer_id", "country", "invoice_date", "revenue", "units",
               "n_lines"]


def eda_totals(raw: DataFrame) -> DataFrame:
    """The exploratory lines summed per invoice, customer, country and date, each the line's
    own (usually one row an invoice; a null is a value of its own)."""
    return eda_lines(raw).groupBy(
        "invoice_no", F.col("customer_id").cast("long").alias("customer_id"), "country",
        "invoice_date").agg(
        F.sum("revenue").alias("revenue"), F.sum("quantity").alias("units"),
        F.count(F.lit(1)).alias("n_lines"))


def invoice_calendar(sales: DataFrame) -> DataFrame:
    """Calendar attributes of each sales invoice: year, month, yyyy-MM, weekday."""
    inv = sales.select("invoice_no", "invoice_date").distinct()
    return inv.select("invoice_no", F.year("invoice_date").alias("year"),
                      F.month("invoice_date").alias("month"),
                      year_month("invoice_date").alias("year_month"),
                      weekday_name("invoice_date").alias("weekday"))


def guest_flag(sales: DataFrame) -> DataFrame:
    """Per line: guest flag and the star-schema customer key (guest → GUEST_ID)."""
    from tillsight import params as P
    return sales.select("invoice_no", "stock_code", "is_guest",
                        F.coalesce(F.col("customer_id").cast("long"),
                                   F.lit(P.GUEST_ID).cast("long")).alias("customer_key"))


def split_summary(raw: DataFrame) -> DataFrame:
    """Lines, units and invoices on each side of the sales / returns split."""
    sales, returns = cleaning.split_sales_returns(raw)
    def side(df, name):
        return df.agg(F.count(F.lit(1)).alias("lines"),
                      F.coalesce(F.sum(F.abs("quantity")), F.lit(0)).cast("long").alias("units"),
                      F.count_distinct("invoice_no").alias("invoices")) \
            .select(F.lit(name).alias("part"), "lines", "units", "invoices")
    return side(sales, "sales").unionByName(side(returns, "returns"))


def scalar_labels(r: Retail) -> DataFrame:
    """Display labels of the monthly chart: period, tick label, £ text, growth arrow."""
    m = views.monthly_revenue(r).join(views.monthly_growth(r).select(
        "year", "month", "growth_pct"), ["year", "month"])
    return m.select(
        "year", "month", "period",
        short_period("period").alias("tick_label"),
        dround(F.col("revenue") / F.lit(1000.0), 1).alias("revenue_k"),
        currency_short("revenue").alias("revenue_text"),
        currency_short("avg_order_value").alias("aov_text"),
        F.when(F.col("growth_pct").isNotNull(), delta_arrow("growth_pct")).alias("growth_text"))


def describe_columns() -> list[str]:
    return ["quantity", "unit_price", "revenue", "customer_id"]

