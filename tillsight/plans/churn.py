"""Churn prediction: features, two models, precision / recall, cost-benefit.

The reference describes this project part (classifier, precision and recall,
saved churn versus incentive cost) without code, features or label; the
definitions here are ours and are parameters in :mod:`tillsight.params`:

* features per registered customer, from invoices before the cutoff: recency and
  tenure in days, invoices, revenue, revenue of the last year;
* label ``churned = 1`` when the customer has no invoice in the horizon after the
  cutoff;
* two models trained on a hash-based 80 % of customers and evaluated on the rest:
  a seeded ``RandomForestClassifier`` (MLlib: distributed tree building) and boosted
  trees (:mod:`tillsight.operators.boosting`: one aggregate a level);
* precision / recall from grouped counts; the cost-benefit sweep buckets the
  churn probability on a 1/20 grid (partial aggregation) and accumulates the
  ≤ 21 bucket rows — no cross join, no per-threshold pass over the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight import params as P
from tillsight.functions.numeric import as_double, ddiv, dround
from tillsight.model import Retail
from tillsight.operators import boosting

FEATURES = ["recency_days", "frequency", "monetary", "tenure_days", "last_year_revenue"]
GRID = 20


def churn_features(r: Retail, cutoff: str = P.CHURN_CUTOFF,
                   horizon_days: int = P.CHURN_HORIZON_DAYS) -> DataFrame:
    """One row per registered customer with a purchase before the cutoff."""
    cut = F.lit(cutoff).cast("timestamp_ntz")
    end = cut + F.make_dt_interval(F.lit(horizon_days))
    year_before = cut - F.make_dt_interval(F.lit(365))
    inv = r.invoice_totals().filter(~F.col("is_guest"))
    d = F.col("invoice_date")
    per_customer = inv.groupBy("customer_id").agg(
        F.max(F.when(d < cut, d)).alias("last_date"),
        F.min(F.when(d < cut, d)).alias("first_date"),
        F.count_if(d < cut).alias("frequency"),
        F.sum(F.when(d < cut, F.col("revenue"))).alias("monetary_dec"),
        F.coalesce(F.sum(F.when((d >= year_before) & (d < cut), F.col("revenue"))),
                   F.lit(0)).alias("last_year_dec"),
        F.count_if((d >= cut) & (d < end)).alias("future_orders"))
    return per_customer.filter(F.col("frequency") > 0).select(
        "customer_id",
        F.extract(F.lit("DAY"), cut - F.col("last_date")).cast("int").alias("recency_days"),
        "frequency",
        as_double("monetary_dec").alias("monetary"),
        F.extract(F.lit("DAY"), cut - F.col("first_date")).cast("int").alias("tenure_days"),
        as_double("last_year_dec").alias("last_year_revenue"),
        (F.col("future_orders") == 0).cast("int").alias("churned"))


def _is_test(seed: int) -> F.Column:
    # holdout by a seeded digest of the customer: stable under any partitioning
    digest = F.md5(F.concat_ws(",", F.lit(str(seed)), F.col("customer_id").cast("string"))
                   .cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(5) == 0


def _forest(train: DataFrame, test: DataFrame, seed: int) -> DataFrame:
    pipeline = Pipeline(stages=[
        VectorAssembler(inputCols=FEATURES, outputCol="features"),
        RandomForestClassifier(labelCol="churned", featuresCol="features", numTrees=40,
                               maxDepth=5, seed=seed)])
    return pipeline.fit(train).transform(test) \
        .withColumn("p_churn", vector_to_array("probability")[1])


def _boosted(train: DataFrame, test: DataFrame, seed: int) -> DataFrame:
    # nothing is drawn: the model follows from the rows alone
    model = boosting.fit(train, FEATURES, "churned", rounds=P.CHURN_ROUNDS,
                         depth=P.CHURN_DEPTH, bins=P.CHURN_BINS, rate=P.CHURN_RATE)
    return model.score(test, "p_churn")


MODELS: dict[str, Callable[[DataFrame, DataFrame, int], DataFrame]] = {
    "forest": _forest, "boosted": _boosted}


def churn_scores(r: Retail, seed: int = P.CHURN_SEED, model: str = "forest", **kw) -> DataFrame:
    """Holdout customers with label, churn probability and their revenue at stake."""
    if model in r.churn and seed == P.CHURN_SEED and not kw:
        return r.churn[model]
    feats = churn_features(r, **kw).withColumn("is_test", _is_test(seed))
    scored = MODELS[model](feats.filter(~F.col("is_test")), feats.filter(F.col("is_test")), seed)
    return scored.select("customer_id", "churned", "last_year_revenue", "p_churn")


def churn_eval(r: Retail, threshold: float = P.CHURN_THRESHOLD, **kw) -> DataFrame:
    """Confusion counts, precision and recall at ``threshold`` on the holdout
    (``model="forest"`` or ``"boosted"``)."""
    s = churn_scores(r, **kw).withColumn("pred", (F.col("p_churn") >= threshold).cast("int"))
    c = s.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if((F.col("pred") == 1) & (F.col("churned") == 1)).alias("tp"),
        F.count_if((F.col("pred") == 1) & (F.col("churned") == 0)).alias("fp"),
        F.count_if((F.col("pred") == 0) & (F.col("churned") == 1)).alias("fn"),
        F.count_if((F.col("pred") == 0) & (F.col("churned") == 0)).alias("tn"))
    return c.select(
        F.lit(threshold).alias("threshold"), "customers", "tp", "fp", "fn", "tn",
        ddiv("tp", F.col("tp") + F.col("fp")).alias("precision"),
        ddiv("tp", F.col("tp") + F.col("fn")).alias("recall"))


def churn_cost_benefit(r: Retail, incentive: float = P.CHURN_INCENTIVE_COST,
                       success: float = P.CHURN_RETENTION_SUCCESS, **kw) -> DataFrame:
    """Net value of targeting customers above each threshold of the 1/20 grid."""
    s = churn_scores(r, **kw)
    bucket = F.least(F.floor(F.col("p_churn") * GRID), F.lit(GRID)).cast("int")
    per_bucket = s.groupBy(bucket.alias("bucket")).agg(
        F.count_if(F.col("churned") == 1).alias("pos"),
        F.count_if(F.col("churned") == 0).alias("neg"),
        # cents: an exact sum in any order
        F.sum(F.when(F.col("churned") == 1, F.col("last_year_revenue").cast("decimal(18,2)")))
        .cast("double").alias("pos_value"))
    spark = s.sparkSession
    grid = spark.range(GRID + 1).select(F.col("id").cast("int").alias("bucket"))
    # the grid has GRID + 1 rows: the windows below are bounded by it
    at_or_above = Window.orderBy(F.col("bucket").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    full = grid.join(per_bucket, "bucket", "left").na.fill(0, ["pos", "neg"]) \
        .na.fill(0.0, ["pos_value"])
    cum = full.select(
        "bucket",
        F.sum("pos").over(at_or_above).alias("tp"),
        F.sum("neg").over(at_or_above).alias("fp"),
        F.sum("pos_value").over(at_or_above).alias("tp_value"),
        F.sum("pos").over(everything).alias("positives"))
    return cum.filter((F.col("bucket") >= 1) & (F.col("bucket") < GRID)).select(
        (F.col("bucket") / F.lit(float(GRID))).alias("threshold"),
        "tp", "fp", (F.col("positives") - F.col("tp")).alias("fn"),
        ddiv("tp", F.col("tp") + F.col("fp")).alias("precision"),
        ddiv("tp", "positives").alias("recall"),
        # money to the cent
        dround(F.col("tp_value") * F.lit(success), 2).alias("saved_value"),
        ((F.col("tp") + F.col("fp")) * F.lit(incentive)).alias("incentive_cost"),
        dround(F.col("tp_value") * F.lit(success)
               - (F.col("tp") + F.col("fp")) * F.lit(incentive), 2).alias("net_value"))


def churn_boosted_scores(r: Retail) -> DataFrame:
    """Holdout customers with the boosted model's churn probability to six decimals."""
    return churn_scores(r, model="boosted").select(
        "customer_id", "churned", dround("p_churn", 6).alias("p_churn"))


def churn_boosted_eval(r: Retail) -> DataFrame:
    """:func:`churn_eval` of the boosted model."""
    return churn_eval(r, model="boosted")


def churn_boosted_cost_benefit(r: Retail) -> DataFrame:
    """:func:`churn_cost_benefit` of the boosted model."""
    return churn_cost_benefit(r, model="boosted")


def churn_models(r: Retail, threshold: float = P.CHURN_THRESHOLD, **kw) -> DataFrame:
    """Both models on the same holdout: one row of :func:`churn_eval` each."""
    first, *rest = [churn_eval(r, threshold, model=m, **kw).withColumn("model", F.lit(m))
                    for m in MODELS]
    for other in rest:
        first = first.unionByName(other)
    return first
