"""Batch jobs: the command-line equivalents of the cleaning, loading and reporting steps.

    python -m tillsight.jobs etl   --raw <export.csv|dir> --out <warehouse dir>
    python -m tillsight.jobs marts --warehouse <warehouse dir> --out <marts dir>
                                   [--years 2010,2011] [--countries "EIRE,France"]
                                   --home "United Kingdom" --rfm-date "2011-12-10 00:00:00"
                                   [--churn-cutoff "2010-12-10 00:00:00"]

``etl`` cleans the raw export, writes the flat clean tables (Parquet partitioned by
year, month, plus CSV copies), builds the star schema and writes its five tables;
the cleaning report and the row counts are written next to them.  ``marts`` reads a
stored star schema and writes every mart (warehouse views and queries, dashboard
tabs under the optional filter, exploratory reports, data-quality reports, and with
a cutoff date the evaluation of both churn models).

Outputs are written with ``overwrite``: re-running a job replaces its output.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight import params as P
from tillsight.model import Retail
from tillsight.operators import cleaning, quality
from tillsight.plans import churn, dashboard, eda, etl, star, views
from tillsight.sources.csv import malformed_values, read_raw_transactions, write_csv
from tillsight.sources.ordered import write_ordered
from tillsight.sources.sinks import write_table

STAR_TABLES = ("customers", "products", "invoices", "invoice_items", "returns")


def run_etl(spark: SparkSession, raw_path: str, out: str) -> Retail:
    raw = read_raw_transactions(spark, raw_path)
    sales, returns = cleaning.clean(raw)
    write_table(sales, f"{out}/clean_sales", ["year", "month"])
    write_table(returns, f"{out}/clean_returns")
    sales = spark.read.parquet(f"{out}/clean_sales").select(*cleaning.CLEAN_COLUMNS)
    returns = spark.read.parquet(f"{out}/clean_returns")
    write_csv(sales, f"{out}/csv/clean_sales")
    write_csv(returns, f"{out}/csv/clean_returns")
    r = star.build(sales, returns)
    for name, df, parts in (("customers", r.customers, None), ("products", r.products, None),
                            ("invoices", r.invoices, ["year"]),
                            ("invoice_items", r.items, None), ("returns", r.returns, None)):
        write_table(df, f"{out}/{name}", parts)
    base = read_star(spark, out, derived=False)
    # derived shapes every mart reads: the flat line table and the invoice summary
    write_table(star.flat_lines(star.loadable(sales, returns)[0]), f"{out}/lines",
                ["year", "month"])
    write_table(base.invoice_totals(), f"{out}/totals", ["year"])
    write_table(etl.eda_totals(raw), f"{out}/eda_totals")
    stored = read_star(spark, out)
    write_table(malformed_values(spark, raw_path), f"{out}/_reports/malformed")
    write_table(cleaning.cleaning_report(raw, sales, returns), f"{out}/_reports/cleaning")
    write_table(star.row_counts(stored), f"{out}/_reports/row_counts")
    return stored


SUMMARY = ["invoice_no", "customer_id", "country", "invoice_date", "year", "month", "is_guest",
           "revenue", "units", "n_lines"]


def read_star(spark: SparkSession, out: str, derived: bool = True) -> Retail:
    """The stored star schema, with its derived line table and invoice summary."""
    def t(name: str) -> DataFrame:
        return spark.read.parquet(f"{out}/{name}")
    header = ["invoice_no", "customer_id", "country", "invoice_date", "year", "month",
              "is_guest"]
    items = t("invoice_items")
    return Retail(
        invoices=t("invoices").select(*header), items=items, returns=t("returns"),
        products=t("products"), customers=t("customers"),
        totals=t("totals").select(*SUMMARY) if derived else None,
        lines=t("lines").select(*items.columns, "description",
                                *[c for c in header if c != "invoice_no"]) if derived else None)


def marts(r: Retail, years=None, countries=None, eda_totals: DataFrame | None = None,
          home: str = P.HOME_COUNTRY,
          rfm_date: str = P.RFM_REFERENCE_DATE,
          churn_cutoff: str | None = None) -> dict[str, DataFrame]:
    """Every mart over a star schema; dashboard tabs under the given filter, exploratory
    reports over ``eda_totals`` (the summary of the exploratory lines; without one, over the
    star's invoices).  With ``churn_cutoff``, both churn models are fitted and evaluated."""
    out: dict[str, DataFrame] = {}
    r = replace(r, rfm=views.rfm_scored(r, rfm_date), ranking=views.product_ranking(r))
    for name in ("monthly_growth", "monthly_revenue", "top_customers", "rfm_segments",
                 "rfm_segment_summary", "rfm_segment_share", "topn_customer_share",
                 "country_revenue", "country_ranking", "product_ranking",
                 "pareto_80", "pareto_count", "pareto_curve_85", "rfm_at_risk",
                 "top10_customers_rfm", "return_rate"):
        out[f"views/{name}"] = getattr(views, name)(r)
    out["views/intl_top10"] = views.intl_top10(r, home)
    f = r.filtered(years=years, countries=countries)
    out["dashboard/kpi_cards"] = dashboard.kpi_cards(f)
    for name in ("monthly_rolling_avg", "revenue_by_year", "top10_countries",
                 "heatmap_month_year", "top10_products", "top10_units", "pareto_rows",
                 "pareto_cutoff", "price_volume_top200", "revenue_guest_split",
                 "top10_customers", "new_customers_monthly", "hist_customer_revenue",
                 "returns_kpis", "returns_by_country", "returns_by_product",
                 "returns_monthly", "filter_options"):
        out[f"dashboard/{name}"] = getattr(dashboard, name)(f)
    e = eda_totals if eda_totals is not None else r.invoice_totals().withColumn(
        "customer_id", F.when(~F.col("is_guest"), F.col("customer_id")))
    for name in ("kpi_overview", "peak_month", "revenue_by_weekday", "weekday_extremes",
                 "retention_split", "hist_orders_per_customer"):
        out[f"eda/{name}"] = getattr(eda, name)(e)
    out["eda/home_market_share"] = eda.home_market_share(e, home)
    out["eda/intl_markets"] = eda.intl_markets(e, home)
    if churn_cutoff is not None:
        features = churn.churn_features(r, churn_cutoff)
        out["churn/churn_features"] = features
        for model in churn.MODELS:
            # one fit a model, shared by its marts
            scored = replace(r, churn={model: churn.churn_scores(
                r, model=model, cutoff=churn_cutoff).checkpoint()})
            out[f"churn/{model}_eval"] = churn.churn_eval(scored, model=model)
            out[f"churn/{model}_cost_benefit"] = churn.churn_cost_benefit(scored, model=model)
    for name in ("dq_not_null", "dq_check", "dq_pk_dups", "dq_fk_orphans"):
        out[f"quality/{name}"] = getattr(quality, name)(r)
    out["quality/customer_orphans"] = quality.customer_orphans(r.customers)
    return out


# Final order of the marts that have one (read them with sources.ordered.read_ordered).
_MONTHS = [("year", True), ("month", True)]
_YEAR_MONTH = [("year_month", True)]
MART_ORDER = {
    "views/monthly_growth": _MONTHS, "views/monthly_revenue": _MONTHS,
    "views/top_customers": [("rank", True)], "views/pareto_80": [("rank", True)],
    "views/product_ranking": [("revenue_rank", True)],
    "views/country_revenue": [("total_revenue", False)],
    "views/country_ranking": [("revenue_rank", True)],
    "views/rfm_segments": [("rfm_avg", False)],
    "views/return_rate": [("return_rate_pct", False)],
    "dashboard/monthly_rolling_avg": _YEAR_MONTH, "dashboard/returns_monthly": _YEAR_MONTH,
    "dashboard/new_customers_monthly": _YEAR_MONTH,
    "dashboard/revenue_by_year": [("year", True)],
    "dashboard/heatmap_month_year": [("year", True)],
    "dashboard/top10_countries": [("revenue", False)],
    "dashboard/top10_products": [("revenue", False)],
    "dashboard/top10_units": [("quantity", False)],
    "dashboard/pareto_rows": [("rank", True)],
    "dashboard/price_volume_top200": [("total_revenue", False)],
    "dashboard/top10_customers": [("revenue", False)],
    "dashboard/returns_by_country": [("return_count", False)],
    "dashboard/returns_by_product": [("return_count", False)],
    "eda/intl_markets": [("revenue", False)],
    "eda/revenue_by_weekday": [("day_order", True)],
    "eda/weekday_extremes": [("day_order", True)],
}


def run_marts(spark: SparkSession, warehouse: str, out: str, years=None,
              countries=None, home: str = P.HOME_COUNTRY,
              rfm_date: str = P.RFM_REFERENCE_DATE,
              churn_cutoff: str | None = None) -> dict[str, str]:
    r = read_star(spark, warehouse)
    summary = spark.read.parquet(f"{warehouse}/eda_totals").select(*etl.EDA_SUMMARY)
    paths = {}
    for name, df in marts(
            r, years, countries, summary, home, rfm_date, churn_cutoff).items():
        path = f"{out}/{name}"
        if name in MART_ORDER:
            write_ordered(df, path, MART_ORDER[name])
        else:
            write_table(df, path)
        paths[name] = path
    return paths


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tillsight.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    e = sub.add_parser("etl")
    e.add_argument("--raw", required=True)
    e.add_argument("--out", required=True)
    m = sub.add_parser("marts")
    m.add_argument("--warehouse", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--years", default=None, help="comma-separated; omit for all years")
    m.add_argument("--countries", default="", help="comma-separated; empty for all")
    m.add_argument("--home", required=True, help="country of the home market")
    m.add_argument("--rfm-date", required=True, help="RFM reference date")
    m.add_argument("--churn-cutoff", default=None,
                   help="fit and evaluate the churn models at this date; omit for none")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"tillsight-{args.job}").getOrCreate()
    if args.job == "etl":
        run_etl(spark, args.raw, args.out)
    else:
        years = [int(y) for y in args.years.split(",") if y] if args.years is not None else None
        countries = [c for c in args.countries.split(",") if c]
        run_marts(spark, args.warehouse, args.out, years, countries, args.home, args.rfm_date,
                  args.churn_cutoff)


if __name__ == "__main__":
    main()
