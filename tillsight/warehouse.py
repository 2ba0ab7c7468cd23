"""Stored warehouse tables: written once per session, then every mart scans them.

A mart names the tables worth storing for it (:func:`synthetic`, :func:`cleaned`); what it
does not read is not built.

:func:`materialize` writes a :class:`Retail` as Parquet tables under the
session's checkpoint folder (shared storage on a cluster) and returns a
``Retail`` that reads them back:

==============  ======================================================  =============
table           content                                                 partitioned
==============  ======================================================  =============
lines           sale lines with their invoice attributes (flat table)   year, month
totals          one row per invoice: header + revenue, units, lines     year
invoices        invoice headers                                          year
items           sale lines (star fact)                                   –
returns         return lines                                             –
products        product dimension                                        –
customers       customer dimension                                       –
==============  ======================================================  =============

Writes go through ``REBALANCE`` on the partition columns: AQE keeps each
year/month together but splits a month that holds a large share of the rows
into several files, so one hot month never lands in one writer task.

The build is keyed by (application id, source folder) and runs once per
session; the source tables are read-only for the session's life.
"""

from __future__ import annotations

import os
import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.model import Retail
from tillsight.params import GUEST_ID
from tillsight.sources.sinks import scratch_path, shuffles_dropped

_LOCK = threading.Lock()
_BUILT: dict[tuple[str, str, str], object] = {}


def _write(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    spark = df.sparkSession
    cols = df.columns
    # partitioned tables: cluster each partition value (few files per month, a hot
    # month split by AQE); unpartitioned ones are written as they stream, no shuffle
    out = df.hint("rebalance", *partition_by) if partition_by else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    # partition columns come back last; restore the column order
    return spark.read.parquet(path).select(*cols)


def materialize(r: Retail, name: str = "warehouse",
                customers_from_totals=None) -> Retail:
    """Store ``r``.  The line ⋈ header join runs once: the line table is written
    from the stored headers, and the invoice summary and the line fact are then
    derived from the stored lines (no second pass over the raw join).

    ``customers_from_totals``: optional ``totals -> customers`` function; when
    given, the customer table is derived from the stored invoice summary (its
    purchase dates need the invoices that have sale lines, which the summary
    already holds) instead of from ``r.customers``.
    """
    spark = r.items.sparkSession
    base = scratch_path(spark, name)
    totals_cols = r.invoice_totals().columns

    def fact_chain() -> dict[str, DataFrame]:
        invoices = _write(r.invoices, f"{base}/invoices", ["year"])
        lines = _write(replace(r, invoices=invoices).sales(), f"{base}/lines", ["year", "month"])
        per_invoice = lines.groupBy(*invoices.columns).agg(
            F.sum("revenue").alias("revenue"),
            F.sum("quantity").alias("units"),
            F.count(F.lit(1)).alias("n_lines"))
        # the line table blanks the guest id; the summary carries the star-schema key
        per_invoice = per_invoice.withColumn(
            "customer_id", F.when(F.col("is_guest"), F.lit(GUEST_ID).cast("long"))
            .otherwise(F.col("customer_id")))
        def totals_then_customers() -> dict[str, DataFrame]:
            totals = _write(per_invoice.select(*totals_cols), f"{base}/totals", ["year"])
            out = {"totals": totals}
            if customers_from_totals is not None:
                out["customers"] = _write(customers_from_totals(totals), f"{base}/customers")
            return out

        rest = _parallel(spark, {
            "totals": totals_then_customers,
            "items": lambda: _write(lines.select(*r.items.columns), f"{base}/items"),
        })
        return {"invoices": invoices, "lines": lines, **rest.pop("totals"), **rest}

    # independent tables are written by concurrent jobs
    jobs = {
        "facts": fact_chain,
        "returns": lambda: _write(r.returns, f"{base}/returns"),
        "products": lambda: _write(r.products, f"{base}/products"),
    }
    if customers_from_totals is None:
        jobs["customers"] = lambda: _write(r.customers, f"{base}/customers")
    out = _parallel(spark, jobs)
    facts = out.pop("facts")
    customers = facts["customers"] if customers_from_totals is not None else out["customers"]
    return Retail(invoices=facts["invoices"], items=facts["items"], returns=out["returns"],
                  products=out["products"], customers=customers,
                  totals=facts["totals"], lines=facts["lines"])


def _parallel(spark: SparkSession, jobs: dict) -> dict:
    """Run independent builds as concurrent Spark jobs (one driver thread each).

    The caller's job description (a thread-local Spark property) is carried into
    the worker threads, so their jobs stay attributed in logs."""
    sc = spark.sparkContext
    desc = sc.getLocalProperty("spark.job.description")

    def tagged(fn):
        def run():
            if desc is not None:
                sc.setJobDescription(desc)
            return fn()
        return run

    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = {name: pool.submit(tagged(fn)) for name, fn in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def _cached(spark: SparkSession, kind: str, folder: str, build):
    key = (spark.sparkContext.applicationId, kind, os.path.abspath(folder))
    with _LOCK:
        if key not in _BUILT:
            _BUILT[key] = build()
        return _BUILT[key]


def _stored(spark: SparkSession, kind: str, folder: str,
            tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """These tables as stored this session; those not yet stored are written, by
    concurrent jobs."""
    app, at = spark.sparkContext.applicationId, os.path.abspath(folder)
    keys = {name: (app, f"{kind}-{name}", at) for name in tables}
    with _LOCK:
        missing = {name: df for name, df in tables.items() if keys[name] not in _BUILT}
        if missing:
            base = scratch_path(spark, kind)
            with shuffles_dropped(spark):
                done = _parallel(spark, {
                    name: lambda df=df, name=name: _write(df, f"{base}/{name}")
                    for name, df in missing.items()})
            _BUILT.update({keys[name]: df for name, df in done.items()})
        return {name: _BUILT[key] for name, key in keys.items()}


def _totals(r: Retail) -> DataFrame:
    """Invoice summary of the headers that have sale lines.  Lines meet the headers summed per
    invoice; equal headers are one row that counts its lines once for each of them."""
    per_invoice = r.items.groupBy("invoice_no").agg(
        F.sum("revenue").alias("revenue"), F.sum("quantity").alias("units"),
        F.count(F.lit(1)).alias("n_lines"))
    kind = per_invoice.schema["revenue"].dataType
    return r.invoices.join(per_invoice, "invoice_no").groupBy(*r.invoices.columns).agg(
        F.sum("revenue").cast(kind).alias("revenue"), F.sum("units").alias("units"),
        F.sum("n_lines").alias("n_lines"))


def synthetic(spark: SparkSession, folder: str, stored: tuple[str, ...] | None = None) -> Retail:
    """The canonical model of the test tables.

    ``stored``: the tables that are worth storing for the caller (of totals, customers, items
    and returns), each written once per session; the others stay plans, so a mart pays for
    what it reads.  ``None``: the whole warehouse, partitioned, stored once per session."""
    from tillsight.sources import synthetic as syn
    base = syn.customer_base(spark, folder)
    if stored is None:
        return _cached(spark, "canonical", folder, lambda: materialize(
            syn.load(spark, folder), "canonical",
            customers_from_totals=lambda totals: syn.add_purchase_dates(base, totals)))
    r = syn.load(spark, folder)

    def keep(**plans: DataFrame) -> dict[str, DataFrame]:
        wanted = {name: df for name, df in plans.items() if name in stored}
        return {**plans, **_stored(spark, "canonical", folder, wanted)}
    first = keep(
        totals=_totals(r), returns=r.returns,
        # lines without a header are in no invoice
        items=r.items.join(r.invoices.select("invoice_no"), "invoice_no")
        .select(*r.items.columns))
    return replace(r, **first, **keep(
        customers=syn.add_purchase_dates(base, first["totals"])))


#: What :func:`cleaned` can store: the clean tables, the star (its returns as ``fact_returns``)
#: and the exploratory summary.
ETL_TABLES = ("sales", "returns", "invoices", "items", "fact_returns", "products", "customers",
              "eda")


def cleaned(spark: SparkSession, folder: str, stored: tuple[str, ...] = ETL_TABLES):
    """Raw export → clean tables → star schema on the test tables.

    The export is stored once per session, and so is each table in ``stored`` (one that is
    read often); the others stay plans over it.  The star's tables are written one after the
    other, so the disk holds the shuffles of one at a time."""
    from tillsight.plans import star
    from tillsight.plans.etl import Cleaned, eda_totals, run_cleaning
    from tillsight.sources import synthetic as syn
    # the export as a file: the raw view of the test tables is a five-way join,
    # stored once so cleaning and the raw-level reports scan it like an export
    raw = _stored(spark, "etl", folder,
                  {"raw": syn.raw_transactions(spark, folder)})["raw"]

    def keep(**plans: DataFrame) -> dict[str, DataFrame]:
        wanted = {name: df for name, df in plans.items() if name in stored}
        return {**plans, **_stored(spark, "etl", folder, wanted)}
    c = run_cleaning(raw)
    flat = keep(sales=c.sales, returns=c.returns, eda=eda_totals(raw))
    if "products" in stored:
        # in parts: their shuffles are large, what comes of them is small
        stored = (*stored, "prices", "medians", "descriptions")
    tables = star.build(flat["sales"], flat["returns"], lambda name, df: keep(**{name: df})[name])
    return Cleaned(raw, flat["sales"], flat["returns"], tables, flat["eda"])


def _stored_view(spark: SparkSession, folder: str, name: str, compute,
                 stored: tuple[str, ...]) -> DataFrame:
    r = synthetic(spark, folder, stored)
    return _cached(spark, name, folder,
                   lambda: _write(compute(r), f"{scratch_path(spark, name)}/view"))


def synthetic_with_rfm(spark: SparkSession, folder: str) -> Retail:
    """The canonical model plus the RFM view stored once per session: five
    marts read the scores, and scoring runs three distributed orderings."""
    from tillsight.plans.views import rfm_scored
    return replace(synthetic(spark, folder, ()),
                   rfm=_stored_view(spark, folder, "rfm", rfm_scored, ("totals", "customers")))


def synthetic_with_ranking(spark: SparkSession, folder: str) -> Retail:
    """The canonical model plus the product ranking view stored once per
    session: four marts read it, and it runs a distributed rank and running sum."""
    from tillsight.plans.views import product_ranking
    return replace(synthetic(spark, folder, ()),
                   ranking=_stored_view(spark, folder, "ranking", product_ranking, ("items",)))


def synthetic_with_churn(spark: SparkSession, folder: str, model: str = "forest") -> Retail:
    """The canonical model plus a churn model's holdout scores, stored
    once per session, so the evaluation and the cost-benefit sweep read the same
    fitted model."""
    from tillsight.plans.churn import churn_scores
    return replace(synthetic(spark, folder, ()),
                   churn={model: _stored_view(spark, folder, f"churn-{model}",
                                              lambda r: churn_scores(r, model=model),
                                              ("totals",))})


def raw_export_csv(spark: SparkSession, folder: str) -> str:
    """Path of the raw export written as CSV (reference header names), once per
    session: the source the raw-CSV reader is exercised on."""
    from tillsight.sources import synthetic as syn
    from tillsight.sources.csv import RAW_COLUMNS, write_csv

    def build() -> str:
        path = f"{scratch_path(spark, 'raw-csv')}/export"
        raw = syn.raw_transactions(spark, folder)
        write_csv(raw.withColumnsRenamed({v: k for k, v in RAW_COLUMNS.items()}), path)
        return path

    return _cached(spark, "raw-csv", folder, build)
