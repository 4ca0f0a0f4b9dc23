"""The quality model against a plain refit, and on rows that it has not seen."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from changelake.llm import quality_model as qm
from changelake.llm.common import held_out


@pytest.fixture(scope="module")
def tables(spark):
    return tuple(spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))


@pytest.fixture(scope="module")
def model(tables):
    return qm.train(*tables)


def scored(docs, labels, model):
    rows = qm.score(docs, model).select("doc.doc_id", "doc.text", "score")
    return rows.join(labels.select("doc_id", "quality"), "doc_id").collect()


def test_held_out_auc_and_f1_of_the_rejected(tables, model):
    docs, labels = tables
    rows = [r for r in scored(docs.where(held_out()), labels, model) if r.quality is not None]
    good, bad = (np.array([r.score for r in rows if r.quality == k]) for k in (1, 0))
    auc = np.mean((good[:, None] > bad[None, :]) + 0.5 * (good[:, None] == bad[None, :]))
    hit, false, missed = (bad < qm.THRESHOLD).sum(), (good < qm.THRESHOLD).sum(), (bad >= qm.THRESHOLD).sum()
    f1 = 2 * hit / (2 * hit + false + missed)
    print("held out", len(good), len(bad), "AUC", round(float(auc), 4), "F1 of class 0", round(float(f1), 4))
    assert len(bad) >= 5 and auc >= 0.9 and f1 >= 0.6


def test_weights_are_those_of_a_plain_refit(tables, model):
    """All learnable labels at this size: log-count ratios and projected dual ascent written plainly give the same margins."""
    docs, labels = (t.where(~held_out()) for t in tables)
    rows = sorted((r.doc_id, r.quality, qm.indicators(r.text or "")) for r in docs.join(labels.select("doc_id", "quality"), "doc_id")
                  .where(F.col("quality").isin(0, 1)).collect())
    y = np.array([1.0 if q else -1.0 for _, q, _ in rows])
    count: dict = {}
    for _, q, grams in rows:
        for g in grams:
            n = count.setdefault(g, [0, 0])
            n[q] += 1
    known = sorted(count, key=lambda g: (-sum(count[g]), "\x1f".join(g).encode()))
    known = [g for g in known if sum(count[g]) >= qm.MIN_DOCS][:qm.MAX_FEATURES]
    n1, n0 = (y > 0).sum(), (y < 0).sum()
    ratio = np.array([np.log((count[g][1] + 1) / (n1 + 2)) - np.log((count[g][0] + 1) / (n0 + 2)) for g in known])
    at = {g: i for i, g in enumerate(known)}
    x = np.zeros((len(rows), len(known)))
    for k, (_, _, grams) in enumerate(rows):
        for g in grams:
            if g in at:
                x[k, at[g]] = ratio[at[g]]
    x = np.hstack([x, np.ones((len(rows), 1))])
    gram, alpha = (x * y[:, None]) @ (x * y[:, None]).T, np.zeros(len(rows))
    for _ in range(400):  # coordinates in turn, to the optimum of the dual
        for k in range(len(rows)):
            alpha[k] = np.clip(alpha[k] + (1 - gram[k] @ alpha) / gram[k, k], 0, qm.PENALTY)
    w = x.T @ (alpha * y)
    want = x @ w
    got = np.array([model.margin(t) for t in [r.text or "" for r in sorted(docs.join(labels.select("doc_id", "quality"), "doc_id")
                    .where(F.col("quality").isin(0, 1)).collect(), key=lambda r: r.doc_id)]])
    assert np.corrcoef(want, got)[0, 1] > 0.995 and np.mean(np.sign(want) == np.sign(got)) > 0.99
    # the model's objective is near that of the optimum
    primal = lambda m, norm: 0.5 * norm + qm.PENALTY * np.maximum(0, 1 - y * m).sum()
    scaled = np.array([model.weights.get(g, 0.0) for g in known])
    own = np.divide(scaled, ratio, out=np.zeros_like(scaled), where=ratio != 0)
    assert primal(got, own @ own + model.bias ** 2) <= 1.05 * primal(want, w @ w)
