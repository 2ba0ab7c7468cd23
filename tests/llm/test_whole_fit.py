"""The latent space is fitted on every passage of every document."""

from collections import Counter

import numpy as np

from tests.conftest import spark  # noqa: F401
from tillsight.llm import decontaminate as d


def _docs():
    return [(i, " ".join(f"w{(i * 7 + k * (k % 5 + 1)) % 90}" for k in range(n)))
            for i, n in enumerate([200, 64, 65, 0, 10, 130] * 2)]


def test_every_passage_is_fitted(spark, monkeypatch):  # noqa: F811
    docs, seen, fit = _docs(), [], d.latent_space
    monkeypatch.setattr(d, "latent_space", lambda corpus, *a: (
        seen.extend(corpus.collect()), fit(corpus, *a))[1])
    items = spark.createDataFrame([(1, docs[1][1]), (2, "w1 w2 w3 w4 w5 w6 w7 w8 w9")],
                                  "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = d.contaminated(df, items, fit_documents=1).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} >= {(1, 1)}
    got = []
    for r in seen:
        slots, times = iter(r["slots"]), iter(r["times"])
        got += [sorted((next(slots), next(times)) for _ in range(n)) for n in r["lengths"]]
    want = [sorted(Counter(d.slots_of(t.encode().split()[a:a + d.WINDOW]).tolist()).items())
            for _, t in docs for a in range(0, len(t.split()), d.WINDOW)]
    assert len(seen) == len(docs) and sorted(got) == sorted(want)


def test_basis_is_that_of_a_whole_svd(spark):  # noqa: F811
    idf = np.linspace(0.5, 3, d.SLOTS).astype(np.float32)
    units = [d._unit(d.slots_of(t.encode().split()[a:a + d.WINDOW]), idf)
             for _, t in _docs() for a in range(0, len(t.split()), d.WINDOW)]
    own = units[:4]  # the first document
    known = np.unique(np.concatenate([s for s, _ in units]))
    texts = spark.createDataFrame([(t.encode(),) for _, t in _docs()[1:]], "text binary")
    table = texts.repartition(3).mapInArrow(d._passage_rows, d._ROWS)
    basis = d.latent_basis(table, idf, own, 0.5, known, 6)
    whole = np.zeros((len(units), len(known)))
    for k, (s, v) in enumerate(units):
        whole[k, np.searchsorted(known, s)] = v * (1 if k < 4 else 0.5)
    best = np.linalg.svd(whole, full_matrices=False)[2][:6].T
    assert basis.shape == best.shape
    assert np.allclose(basis.T @ basis, np.eye(6), atol=1e-3)
    # the same space: all of it lies in the other
    assert np.allclose(np.linalg.norm(best.T @ basis, 2, axis=0), 1, atol=1e-2)
