"""Churn model: consistent counts, monotone sweep, deterministic under a seed."""

from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tillsight import jobs, warehouse
from tillsight import params as P
from tillsight.plans import churn


def test_eval_and_sweep(spark):
    r = warehouse.synthetic(spark, SF_MID)
    scores = churn.churn_scores(r)
    e = churn.churn_eval(r).collect()[0]
    positives = scores.filter(F.col("churned") == 1).count()
    assert e.tp + e.fn == positives and e.customers == scores.count()
    assert 0.0 <= e.recall <= 1.0 and (e.precision is None or 0.0 <= e.precision <= 1.0)
    sweep = churn.churn_cost_benefit(r).orderBy("threshold").collect()
    assert len(sweep) == 19
    tps = [row.tp for row in sweep]
    assert tps == sorted(tps, reverse=True)
    assert all(row.tp + row.fn == positives for row in sweep)
    again = churn.churn_eval(r).collect()[0]
    assert again == e


def test_both_models_on_one_holdout(spark):
    r = warehouse.synthetic(spark, SF_MID)
    rows = {row.model: row for row in churn.churn_models(r).collect()}
    assert set(rows) == {"forest", "boosted"}
    assert rows["forest"].customers == rows["boosted"].customers
    assert rows["forest"].tp + rows["forest"].fn == rows["boosted"].tp + rows["boosted"].fn


def test_jobs_write_churn_marts_when_asked(spark):
    r = warehouse.synthetic(spark, SF_MID)
    out = jobs.marts(r, churn_cutoff=P.CHURN_CUTOFF)
    assert out["churn/boosted_eval"].collect() == churn.churn_boosted_eval(r).collect()
    assert out["churn/forest_cost_benefit"].count() == 19
    assert not any(k.startswith("churn/") for k in jobs.marts(r))
