"""The warehouse's analytic queries and views as lazy DataFrames.

Each function takes the canonical :class:`~tillsight.model.Retail` tables.
Customer-, country- and month-level marts start from
:meth:`Retail.invoice_totals` (lines pre-summed per invoice, so distinct-invoice
counts are plain counts); product-level marts pre-aggregate lines per stock code
before meeting the product dimension.  Orderings over one row per product or
customer use :mod:`tillsight.operators.ordered`; orderings over calendar months or
countries (bounded domains) use plain windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight import params as P
from tillsight.functions.labels import customer_label, period_label
from tillsight.functions.numeric import as_double, ddiv, dround, pct
from tillsight.model import Retail
from tillsight.operators.ordered import top_k_with_ties, with_ntiles, with_rank


# -- monthly -------------------------------------------------------------------------

def _registered_invoices(r: Retail) -> DataFrame:
    return r.invoice_totals().filter(~F.col("is_guest"))


def monthly_growth(r: Retail) -> DataFrame:
    """Revenue per month with the previous month and month-over-month growth %."""
    monthly = _registered_invoices(r).groupBy("year", "month").agg(
        F.sum("revenue").alias("rev"))
    # one row per calendar month: the global window is bounded by the calendar
    w = Window.orderBy("year", "month")
    prev = F.lag(as_double("rev")).over(w)
    cur = as_double("rev")
    return monthly.select(
        "year", "month",
        cur.alias("revenue"),
        prev.alias("revenue_prev_month"),
        dround((cur - prev) / F.nullif(prev, F.lit(0.0)) * F.lit(100.0), 1).alias("growth_pct"),
    )


def monthly_revenue(r: Retail) -> DataFrame:
    """Orders, active customers, revenue and average order value per month."""
    monthly = _registered_invoices(r).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_distinct("customer_id").alias("active_customers"),
        F.sum("revenue").alias("rev"))
    return monthly.select(
        "year", "month",
        period_label("year", "month").alias("period"),
        "total_orders", "active_customers",
        as_double("rev").alias("revenue"),
        dround(ddiv("rev", "total_orders"), 2).alias("avg_order_value"),
    )


# -- customers -----------------------------------------------------------------------

def _customer_base(r: Retail) -> DataFrame:
    """Registered customers: invoices, items, revenue, last date.

    Invoices are summed per customer first (partial aggregation), so the join
    with the customer dimension is one row to one row.  Guest invoices are
    dropped before any grouping by customer: the guest id is the hottest key."""
    cust = r.customers.filter(~F.col("is_guest")).select("customer_id", "country")
    per_customer = _registered_invoices(r).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_invoices"),
        F.sum("units").alias("total_items"),
        F.sum("revenue").alias("rev"),
        F.max("invoice_date").alias("last_date"))
    return per_customer.join(cust, "customer_id").select(
        "customer_id", "country", "total_invoices", "total_items", "rev", "last_date")


def top_customers(r: Retail, k: int = 10) -> DataFrame:
    """Registered customers with revenue rank ≤ k (ties kept) and average order value."""
    base = _customer_base(r)
    top = top_k_with_ties(base, "rev", k, rank="rank")
    return top.select(
        "rank", "customer_id", "country", "total_invoices", "total_items",
        as_double("rev").alias("total_revenue"),
        dround(ddiv("rev", "total_invoices"), 2).alias("avg_order_value"))


def recency_days(reference_date: str, last: F.Column) -> F.Column:
    """Whole days of ``reference - last`` truncated toward zero (the day field of
    the interval, not a calendar-date difference): -12 h → 0, 3.5 days → 3."""
    ref = F.lit(reference_date).cast("timestamp_ntz")
    return F.extract(F.lit("DAY"), ref - last).cast("int")


def rfm_base(r: Retail, reference_date: str = P.RFM_REFERENCE_DATE) -> DataFrame:
    return _customer_base(r).select(
        "customer_id", "country",
        recency_days(reference_date, F.col("last_date")).alias("recency_days"),
        F.col("total_invoices").alias("frequency"),
        F.col("rev").alias("monetary_dec"))


def segment_of(r: F.Column, f: F.Column, m: F.Column) -> F.Column:
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), P.SEGMENT_CHAMPIONS)
            .when((r >= 3) & (f >= 3) & (m >= 3), P.SEGMENT_LOYAL)
            .when((r >= 4) & (f <= 2), P.SEGMENT_NEW)
            .when((r <= 2) & (f >= 3), P.SEGMENT_AT_RISK)
            .when((r <= 2) & (f <= 2), P.SEGMENT_LOST)
            .otherwise(P.SEGMENT_POTENTIAL))


def rfm_scored(r: Retail, reference_date: str = P.RFM_REFERENCE_DATE) -> DataFrame:
    """RFM with ``monetary_dec`` kept as a decimal for exact downstream sums."""
    if r.rfm is not None and reference_date == P.RFM_REFERENCE_DATE:
        return r.rfm
    base = rfm_base(r, reference_date)
    # ties inside one metric are broken by customer_id, so the scores are deterministic
    scored = with_ntiles(base, {
        "r_score": ([("recency_days", False), ("customer_id", True)], 5),
        "f_score": ([("frequency", True), ("customer_id", True)], 5),
        "m_score": ([("monetary_dec", True), ("customer_id", True)], 5)})
    rs, fs, ms = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.select(
        "customer_id", "country", "recency_days", "frequency",
        as_double("monetary_dec").alias("monetary"), "monetary_dec",
        "r_score", "f_score", "m_score",
        dround((rs + fs + ms).cast("double") / F.lit(3.0), 1).alias("rfm_avg"),
        segment_of(rs, fs, ms).alias("segment"))


def rfm_segments(r: Retail, reference_date: str = P.RFM_REFERENCE_DATE) -> DataFrame:
    return rfm_scored(r, reference_date).drop("monetary_dec")


def rfm_at_risk(r: Retail) -> DataFrame:
    return rfm_segments(r).filter(F.col("segment") == P.SEGMENT_AT_RISK)


def rfm_segment_summary(r: Retail) -> DataFrame:
    """Customers and average revenue per segment (average rounded to whole pounds)."""
    g = rfm_scored(r).groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("monetary_dec").alias("rev"))
    return g.select("segment", "customers", dround(ddiv("rev", "customers"), 0)
                    .alias("avg_revenue"))


def rfm_segment_share(r: Retail) -> DataFrame:
    """Share of customers and of revenue per segment, in percent."""
    scored = rfm_scored(r)
    n_all = scored.agg(F.count(F.lit(1))).scalar()
    g = scored.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("monetary_dec").alias("rev"))
    rev_all = scored.agg(F.sum("monetary_dec")).scalar()
    return g.select("segment", "customers", as_double("rev").alias("revenue"),
                    pct("customers", n_all, 2).alias("pct_customers"),
                    pct("rev", rev_all, 2).alias("pct_revenue"))


def top10_customers_rfm(r: Retail, k: int = 10) -> DataFrame:
    """Top customers by monetary value (``ORDER BY monetary DESC LIMIT k``)."""
    return (rfm_segments(r)
            .select("customer_id", "country", F.col("monetary").alias("total_revenue"),
                    F.col("frequency").alias("total_invoices"),
                    customer_label("customer_id", "country").alias("label"))
            .orderBy(F.col("total_revenue").desc(), F.col("customer_id"))
            .limit(k))


def topn_customer_share(r: Retail, k: int = 10) -> DataFrame:
    """Revenue of the k best registered customers as a share of all revenue."""
    base = _customer_base(r)
    top = base.orderBy(F.col("rev").desc(), F.col("customer_id")).limit(k) \
        .agg(F.sum("rev").alias("top_rev"), F.count(F.lit(1)).alias("customers"))
    total = r.invoice_totals().agg(F.sum("revenue")).scalar()
    return top.select("customers", as_double("top_rev").alias("top_revenue"),
                      as_double(total).alias("total_revenue"),
                      pct("top_rev", total, 2).alias("share_pct"))


# -- countries -----------------------------------------------------------------------

def _country_base(r: Retail) -> DataFrame:
    return _registered_invoices(r).groupBy("country").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.sum("units").alias("units_sold"),
        F.sum("revenue").alias("rev"))


def _country_measures() -> list:
    return [as_double("rev").alias("total_revenue"),
            dround(ddiv("rev", "total_orders"), 2).alias("avg_order_value"),
            dround(ddiv("rev", "unique_customers"), 2).alias("revenue_per_customer")]


def country_revenue(r: Retail, min_orders: int = P.MIN_COUNTRY_ORDERS) -> DataFrame:
    """Countries with at least ``min_orders`` orders."""
    return _country_base(r).filter(F.col("total_orders") >= min_orders).select(
        "country", "total_orders", "unique_customers", *_country_measures())


def country_ranking(r: Retail) -> DataFrame:
    """All countries with units and revenue rank (one row per country: bounded)."""
    w = Window.orderBy(F.col("rev").desc())
    return _country_base(r).select(
        "country", "total_orders", "unique_customers", "units_sold", *_country_measures(),
        F.rank().over(w).alias("revenue_rank"))


def intl_top10(r: Retail, home: str = P.HOME_COUNTRY, k: int = 10) -> DataFrame:
    """Top k countries outside the home market by revenue."""
    return (country_ranking(r).filter(F.col("country") != home)
            .select("country", "total_revenue", "avg_order_value", "unique_customers")
            .orderBy(F.col("total_revenue").desc(), F.col("country")).limit(k))


# -- products ------------------------------------------------------------------------

def product_ranking(r: Retail) -> DataFrame:
    """Every sold product: units, orders, revenue, share, cumulative share, rank."""
    if r.ranking is not None:
        return r.ranking
    per_code = r.items.groupBy("stock_code").agg(
        F.sum("quantity").alias("units_sold"),
        F.count_distinct("invoice_no").alias("times_ordered"),
        F.sum("revenue").alias("rev"))
    sold = per_code.join(r.products.select("stock_code", "description"), "stock_code")
    total = sold.agg(F.sum("rev")).scalar()
    ranked = with_rank(sold, "rev", ascending=False, rank="revenue_rank",
                       range_sums={"cum_rev": "rev"})
    return ranked.select(
        "stock_code", "description", "units_sold", "times_ordered",
        as_double("rev").alias("total_revenue"),
        pct("rev", total, 2).alias("revenue_pct"),
        pct("cum_rev", total, 2).alias("cumulative_pct"),
        "revenue_rank")


def pareto_80(r: Retail, threshold: float = P.PARETO_PCT) -> DataFrame:
    """Products inside the first ``threshold`` % of revenue (``<=``, SQL form)."""
    return product_ranking(r).filter(F.col("cumulative_pct") <= threshold).select(
        F.col("revenue_rank").alias("rank"), "stock_code", "description",
        F.col("total_revenue").alias("revenue"), "units_sold", "cumulative_pct")


def pareto_count(r: Retail, threshold: float = P.PARETO_PCT) -> DataFrame:
    """How many products make up ``threshold`` % of revenue, out of how many, and
    the highest revenue rank inside the threshold."""
    inside = F.col("cumulative_pct") <= threshold
    return product_ranking(r).agg(
        F.count_if(inside).alias("products_in_pareto"),
        F.count(F.lit(1)).alias("total_products"),
        # the chart's cut line: highest rank still inside (NULL if none)
        F.max(F.when(inside, F.col("revenue_rank"))).alias("cutoff_rank"))


def pareto_curve_85(r: Retail, threshold: float = P.PARETO_PLOT_PCT) -> DataFrame:
    return product_ranking(r).filter(F.col("cumulative_pct") <= threshold).select(
        "revenue_rank", F.col("total_revenue").alias("revenue"), "cumulative_pct")


def return_rate(r: Retail) -> DataFrame:
    """Returned units over sold units per product (products that sold)."""
    sold = r.items.groupBy("stock_code").agg(
        F.sum("quantity").alias("units_sold"), F.sum("revenue").alias("revenue"))
    returned = r.returns.groupBy("stock_code").agg(
        F.sum("quantity").alias("units_returned"), F.sum("revenue_lost").alias("revenue_lost"))
    out = (r.products.select("stock_code", "description")
           .join(sold, "stock_code", "left")
           .join(returned, "stock_code", "left")
           .filter(F.coalesce(F.col("units_sold"), F.lit(0)) > 0))
    units_ret = F.coalesce(F.col("units_returned"), F.lit(0)).cast("long")
    return out.select(
        "stock_code", "description",
        F.coalesce(F.col("units_sold"), F.lit(0)).cast("long").alias("units_sold"),
        units_ret.alias("units_returned"),
        as_double(F.coalesce(F.col("revenue"), F.lit(0))).alias("revenue"),
        as_double(F.coalesce(F.col("revenue_lost"), F.lit(0))).alias("revenue_lost"),
        pct(units_ret, F.coalesce(F.col("units_sold"), F.lit(0)), 2).alias("return_rate_pct"))


def register_views(r: Retail) -> None:
    """Expose the five warehouse views under their reference names for ``spark.sql``."""
    monthly_revenue(r).createOrReplaceTempView("vw_monthly_revenue")
    product_ranking(r).createOrReplaceTempView("vw_top_products")
    country_ranking(r).createOrReplaceTempView("vw_revenue_by_country")
    rfm_segments(r).createOrReplaceTempView("vw_customer_rfm")
    return_rate(r).createOrReplaceTempView("vw_return_rate")
