"""The canonical star schema every mart reads.

``Retail`` bundles five lazy DataFrames:

=============  =====================================================================
invoices       invoice_no, customer_id, country, invoice_date, year, month, is_guest
items          invoice_no, stock_code, line_no, quantity, unit_price, revenue
returns        invoice_no, customer_id, stock_code, country, quantity, unit_price,
               invoice_date, revenue_lost
products       stock_code, description, unit_price
customers      customer_id, country, is_guest, first_purchase, last_purchase
=============  =====================================================================

Money columns are ``decimal(12,2)`` (``revenue``, ``revenue_lost``) and
``decimal(10,2)`` (prices).  Guests carry ``customer_id = GUEST_ID`` and
``is_guest = true``.

Two derived shapes are shared by many marts:

* :meth:`Retail.invoice_totals` – one row per invoice that has sale lines, with its
  revenue and units.  Lines are summed per invoice *before* the join with the
  invoice header (map-side partial aggregation, and the join then runs at invoice
  grain on the aggregate's hash partitioning).  ``COUNT(DISTINCT invoice_no)``
  over the line join becomes a plain ``count`` here.
* :meth:`Retail.sales` – the flat line table of the dashboard (line + header
  attributes), filtered by year / country below the join.

Both can be stored (``totals``, ``lines``; see :mod:`tillsight.warehouse`), in
which case marts scan them instead of re-running the joins, and
:meth:`Retail.filtered` prunes their year partitions.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Retail:
    invoices: DataFrame
    items: DataFrame
    returns: DataFrame
    products: DataFrame
    customers: DataFrame
    # optional stored forms of the two derived shapes (see tillsight.warehouse)
    totals: DataFrame | None = None
    lines: DataFrame | None = None
    # optional stored views read by several marts (see tillsight.warehouse): RFM
    # scores at the default reference date, and the product ranking
    rfm: DataFrame | None = None
    ranking: DataFrame | None = None
    # optional stored churn holdout scores per model (default parameters)
    churn: dict[str, DataFrame] = field(default_factory=dict)

    def invoice_totals(self) -> DataFrame:
        if self.totals is not None:
            return self.totals
        per_invoice = self.items.groupBy("invoice_no").agg(
            F.sum("revenue").alias("revenue"),
            F.sum("quantity").alias("units"),
            F.count(F.lit(1)).alias("n_lines"),
        )
        return self.invoices.join(per_invoice, "invoice_no")

    def sales(self) -> DataFrame:
        """Sale lines with invoice attributes (``customer_id`` NULL for guests)."""
        if self.lines is not None:
            return self.lines
        inv = self.invoices.select(
            "invoice_no",
            F.when(F.col("is_guest"), F.lit(None)).otherwise(F.col("customer_id"))
            .alias("customer_id"),
            "country", "invoice_date", "year", "month", "is_guest")
        return self.items.join(inv, "invoice_no")

    def filtered(self, years=None, countries=None) -> "Retail":
        """Dashboard filter applied to the invoice headers, their lines and the returns.

        ``years``: list of years to keep (``None`` = all; an empty list keeps
        nothing).  ``countries``: list of countries (``None`` or empty = all).
        """
        inv, ret, tot, lin = self.invoices, self.returns, self.totals, self.lines
        if years is not None:
            keep_year = F.col("year").isin(list(years))
            inv = inv.filter(keep_year)
            ret = ret.filter(_in_years(F.col("invoice_date"), years))
            tot = tot.filter(keep_year) if tot is not None else None
            lin = lin.filter(keep_year) if lin is not None else None
        if countries:
            keep_country = F.col("country").isin(list(countries))
            inv = inv.filter(keep_country)
            ret = ret.filter(keep_country)
            tot = tot.filter(keep_country) if tot is not None else None
            lin = lin.filter(keep_country) if lin is not None else None
        items = self.items
        if years is not None or countries:
            items = items.join(inv.select("invoice_no"), "invoice_no", "left_semi") \
                .select(*items.columns)
        # stored views describe the unfiltered tables: drop them
        return replace(self, invoices=inv, items=items, returns=ret, totals=tot, lines=lin, rfm=None,
                       ranking=None, churn={})


def _in_years(ts: F.Column, years) -> F.Column:
    """``year(ts) IN years`` written as timestamp ranges, so Parquet row-group
    statistics can skip data (a function of the column cannot be pushed down)."""
    cond = F.lit(False)
    for y in sorted(set(int(y) for y in years)):
        lo = F.lit(f"{y:04d}-01-01 00:00:00").cast("timestamp_ntz")
        hi = F.lit(f"{y + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
        cond = cond | ((ts >= lo) & (ts < hi))
    return cond
