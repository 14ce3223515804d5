"""Mergeable moments (M13) and naive Bayes statistics (M3)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from benchtrail.operators import bayes as B
from benchtrail.operators import moments as I

SCHEMA = "id long, v array<double>, label int"


def table(n=300, dim=5, seed=1):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim)) @ r.normal(size=(dim, dim)) + 1000  # far from 0: sums of squares would cancel
    return [(i, x[i].tolist(), int(x[i][0] > 1000) + int(x[i][1] > 1001)) for i in range(n)]


ODD = [(900, None, 1), (901, [1.0], 1), (902, [math.nan] * 5, 1), (903, [None] * 5, 0), (904, [math.inf] * 5, 0)]


@pytest.mark.parametrize("chunks", [1, 7, 50])
def test_same_components_from_any_chunks(spark, monkeypatch, chunks):
    monkeypatch.setattr(I, "FAN", 3)
    rows = table()
    x = np.array([v for _, v, _ in rows])
    df = spark.createDataFrame(rows + ODD, SCHEMA).withColumn("chunk", F.col("id") % chunks)
    parts = I.moments(df, "v", 5, "chunk")
    assert parts.count() == chunks
    model = I.update(I.update(None, parts.filter("chunk < 3")), parts.filter("chunk >= 3")) if chunks > 3 else I.update(None, parts)
    cov = np.cov(x.T)
    for r in I.covariances(model).collect():
        assert r.n == 300 and abs(r.covariance - cov[r.i, r.j]) < 1e-8
    mean, axes, variances = I.components(model, 3)
    assert np.allclose(mean, x.mean(axis=0)) and np.allclose(variances, np.sort(np.linalg.eigvalsh(cov))[::-1][:3])
    assert np.allclose(axes @ cov @ axes.T, np.diag(variances), atol=1e-8) and all(a[np.abs(a).argmax()] > 0 for a in axes)
    got = {r.id: r.pca for r in I.project(df, "v", model, 3).collect()}
    assert np.allclose([got[i] for i, _, _ in rows], (x - mean) @ axes.T) and all(got[i] is None for i, _, _ in ODD)


def test_no_rows(spark):
    none = I.moments(spark.createDataFrame([], SCHEMA), "v", 5)
    assert none.count() == 0 and I.update(None, none).count() == 0 and I.components(none, 2)[1].size == 0
    one = I.moments(spark.createDataFrame(table(1), SCHEMA), "v", 5)
    assert one.first().n == 1 and I.covariances(one).filter("covariance is not null").count() == 0
    trained = B.model(B.statistics(spark.createDataFrame([], SCHEMA), "v", "label", 5))
    assert B.classify(spark.createDataFrame(table(2), SCHEMA), trained, "id", "v").filter("prediction is null").count() == 2


def test_bayes_by_addition_equals_a_whole_fit(spark):
    rows = table(200)
    df = spark.createDataFrame(rows + ODD, SCHEMA)
    days = [B.statistics(df.filter(F.col("id") % 3 == d), "v", "label", 5) for d in range(3)]
    key = lambda r: (r.label, r.feature)
    once = sorted(B.model(B.statistics(df, "v", "label", 5)).collect(), key=key)
    added = sorted(B.model(B.merged(B.merged(days[0], days[1]), days[2])).collect(), key=key)
    assert [key(r) for r in once] == [key(r) for r in added]
    assert np.allclose([(r.log_prior, r.log_prob) for r in once], [(r.log_prior, r.log_prob) for r in added])
    x, y = np.array([v for _, v, _ in rows]), np.array([label for _, _, label in rows])
    scaled = (x - x.min(axis=0)) / (x.max(axis=0) - x.min(axis=0))
    sums = np.stack([scaled[y == c].sum(axis=0) for c in range(3)])
    theta = np.log(sums + 0.01) - np.log(sums.sum(axis=1, keepdims=True) + 0.05)
    prior = np.log([np.mean(y == c) for c in range(3)])
    assert np.allclose([r.log_prob for r in once], theta.ravel())
    got = {r.id: r.prediction for r in B.classify(df, B.model(B.statistics(df, "v", "label", 5)), "id", "v").collect()}
    assert [got[i] for i, _, _ in rows] == (scaled @ theta.T + prior).argmax(axis=1).tolist() and all(got[i] is None for i, _, _ in ODD)


def test_a_feature_that_does_not_vary(spark):
    df = spark.createDataFrame([(i, [1.0, float(i % 2)], i % 2) for i in range(10)], SCHEMA)
    trained = B.model(B.statistics(df, "v", "label", 2))
    assert {r.id: r.prediction for r in B.classify(df, trained, "id", "v").collect()} == {i: i % 2 for i in range(10)}
