"""Histogram boosting: against a row-by-row version, held-out gain, layouts, edge cases."""

import math
import random

import numpy as np
import pytest

from tillsight.operators.boosting import UNIT, Split, fit

SCHEMA = "id long, a double, b double, c double, y int"


def planted(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.random(), rng.gauss(0, 1), float(rng.randrange(4))
        y = int((a > 0.6) != (b > 0.3)) if rng.random() > 0.1 else rng.randrange(2)
        out.append((i, a, b if i % 17 else None, c, y))
    return out


def row_by_row(rows, rounds, depth, bins, rate):
    """The same definition on plain arrays: every split tried on every node's rows."""
    x = np.array([[np.nan if v is None else v for v in r[1:4]] for r in rows], float)
    y = np.array([r[4] for r in rows])
    binned = np.zeros(x.shape, int)
    for f in range(x.shape[1]):
        v = x[~np.isnan(x[:, f]), f]
        for e in np.percentile(v, [100 * k / bins for k in range(1, bins)]):
            binned[:, f] += np.where(np.isnan(x[:, f]), False, x[:, f] > e)
    margin = np.full(len(y), math.floor(
        math.log(((y == 1).sum() + .5) / ((y == 0).sum() + .5)) * UNIT + .5))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(margin / UNIT)))
        g = np.floor((p - y) * UNIT + .5)
        h = np.floor(p * (1 - p) * UNIT + .5)

        def strength(at):
            return g[at].sum() ** 2 / (h[at].sum() + UNIT)

        def leaf(at, level):
            best = None
            if level < depth:
                for f in range(x.shape[1]):
                    for b in range(bins):
                        left, right = at & (binned[:, f] <= b), at & (binned[:, f] > b)
                        if min(h[left].sum(), h[right].sum()) < UNIT:
                            continue
                        gain = strength(left) + strength(right) - strength(at)
                        if gain > 0 and (best is None or gain > best[0]):
                            best = gain, left, right
            if best:
                leaf(best[1], level + 1)
                leaf(best[2], level + 1)
            else:
                step[at] = math.floor(rate * (-g[at].sum() / (h[at].sum() + UNIT)) * UNIT + .5)
        step = np.zeros(len(y))
        leaf(np.ones(len(y), bool), 0)
        margin = margin + step
    return 1 / (1 + np.exp(-(margin / UNIT)))


@pytest.mark.parametrize("copies", [1, 3])
def test_equals_row_by_row(spark, copies):
    rows = planted(400) * copies
    df = spark.createDataFrame(rows, SCHEMA)
    model = fit(df, ["a", "b", "c"], "y", rounds=4, depth=3, bins=8)
    got = [r.p for r in model.score(df).collect()]
    assert got == pytest.approx(row_by_row(rows, 4, 3, 8, 0.3), abs=1e-9)


def test_held_out_gain_and_layout(spark):
    train = spark.createDataFrame(planted(3000), SCHEMA)
    model = fit(train, ["a", "b", "c"], "y")
    # the label is the exclusive or of two features: no single threshold finds it
    held = model.score(spark.createDataFrame(planted(1000, seed=2), SCHEMA)).collect()
    assert np.mean([(r.p >= 0.5) == r.y for r in held]) > 0.85
    assert fit(train.repartition(13, "b"), ["a", "b", "c"], "y") == model


def test_edge_cases(spark):
    none = fit(spark.createDataFrame([], SCHEMA), ["a", "b"], "y", rounds=2)
    assert none.trees == (0, 0) and none.base == 0
    messy = [(1, None, None, 1.0, 1), (2, float("nan"), None, 1.0, 0), (3, None, None, 1.0, None)]
    df = spark.createDataFrame(messy, SCHEMA)
    model = fit(df, ["a", "b", "c"], "y", rounds=2)
    assert not any(isinstance(t, Split) for t in model.trees)
    assert [r.p for r in model.score(df).collect()] == [0.5, 0.5, 0.5]
    # scoring keeps the caller's columns, and replaces one of the same name
    clash = df.withColumnRenamed("y", "p").withColumnRenamed("id", "node")
    assert model.score(clash).columns == ["node", "a", "b", "c", "p"]
    one = spark.createDataFrame([(i, float(i), 0.0, 0.0, 1) for i in range(50)], SCHEMA)
    p = fit(one, ["a", "b"], "y").score(one).first().p
    assert 0.95 < p < 1
