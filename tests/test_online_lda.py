"""Inference of many documents at once against one at a time, and the fit against Spark's own."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.clustering import LDA
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import types as T

from commentscope.functions import variational
from commentscope.functions.variational import digamma, infer, statistics, trigamma
from commentscope.operators.online_lda import fit_online
from commentscope.operators.topics import PLAIN_VECTORS
from commentscope.storage import new_dir


def drawn(n, terms, topics=3, seed=1):
    pick = np.random.default_rng(seed)
    docs = [np.sort(pick.choice(terms, pick.integers(1, terms), replace=False)) for _ in range(n)]
    counts = [pick.integers(1, 5, len(d)).astype(float) for d in docs]
    betas = np.exp(variational.expectation(pick.gamma(2.0, 3.0, (terms, topics))).T)
    return docs, counts, betas, np.array([0.2, 0.4, 0.3]), pick.gamma(100, 0.01, topics)


def alone(ids, counts, betas, alpha, start):
    """Topic counts of one document, step by step."""
    weights, gamma = betas[:, ids], start
    while True:
        theta = np.exp(digamma(gamma) - digamma(np.array([gamma.sum()])))
        last, gamma = gamma, theta * (weights @ (counts / (theta @ weights + 1e-100))) + alpha
        if np.abs(gamma - last).mean() <= variational.MEAN_CHANGE:
            return gamma


def test_digamma_and_trigamma():
    x = np.array([0.05, 0.5, 1.0, 3.0, 250.0, 1e9])
    steps = digamma(x + 1) - digamma(x)
    assert np.allclose(steps[:5], 1 / x[:5], rtol=1e-10)
    assert np.allclose(digamma(np.array([1.0, 0.5])), [-0.5772156649015329, -1.9635100260214235], rtol=1e-12)
    assert np.allclose(trigamma(np.array([1.0, 0.5])), [np.pi**2 / 6, np.pi**2 / 2], rtol=1e-11)


@pytest.mark.parametrize("columns", [1, 4, 512])
def test_documents_together_are_those_alone(monkeypatch, columns):
    monkeypatch.setattr(variational, "COLUMNS", columns)
    docs, counts, betas, alpha, start = drawn(60, 40)
    sizes = np.array([len(d) for d in docs])
    gamma, theta = infer(np.concatenate(docs), np.concatenate(counts), sizes, betas, alpha, start)
    wanted = np.array([alone(d, c, betas, alpha, start) for d, c in zip(docs, counts)]).T
    assert np.allclose(gamma, wanted, rtol=1e-10)
    assert np.allclose(theta, np.exp(variational.expectation(wanted)), rtol=1e-10)


def test_sums_count_documents_as_often_as_they_are_drawn(monkeypatch):
    monkeypatch.setattr(variational, "STEP_TERMS", 50)
    docs, counts, betas, alpha, start = drawn(9, 20)
    docs[4], counts[4] = docs[4][:0], counts[4][:0]  # no terms
    rows = [0, 1, 1, 2, 3, 4, 4, 5, 6, 6, 6, 7, 8]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(rows), pa.array([docs[r] for r in rows]), pa.array([counts[r] for r in rows])],
        names=["row", "ids", "counts"],
    )
    sums, logs, n = statistics([batch], betas, alpha, start)
    wanted, wanted_logs = np.zeros((3, 20)), np.zeros(3)
    for r in [r for r in rows if r != 4]:
        gamma = alone(docs[r], counts[r], betas, alpha, start)
        log = variational.expectation(gamma)
        theta = np.exp(log)
        wanted[:, docs[r]] += np.outer(theta, counts[r] / (theta @ betas[:, docs[r]]))
        wanted_logs += log
    assert n == 11
    assert np.allclose(sums, wanted) and np.allclose(logs, wanted_logs)


def test_the_fit_is_that_of_sparks_optimizer(spark):
    pick = np.random.default_rng(5)
    size, rows = 30, []
    for k in range(200):
        ids = np.flatnonzero(pick.random(size) < np.where(np.arange(size) % 2 == k % 2, 0.4, 0.05))
        rows.append((k, Vectors.sparse(size, [(int(i), 1.0) for i in ids])))
    schema = T.StructType(
        [T.StructField("part", T.LongType()), T.StructField("features", VectorUDT())]
    )
    path = new_dir(spark, "vectors")
    spark.createDataFrame(rows, schema).repartition(3, "part").write.parquet(path)
    plain = spark.read.schema(PLAIN_VECTORS).parquet(path).select("features")
    model = fit_online(plain, size, num_topics=2, max_iter=5, seed=77)
    stored = spark.read.schema(schema).parquet(path).select("features")
    spark_model = LDA(k=2, maxIter=5, optimizer="online", seed=77, subsamplingRate=1.0).fit(stored)
    assert np.allclose(
        model.topicsMatrix().toArray(), spark_model.topicsMatrix().toArray(), rtol=1e-5
    )
    assert np.allclose(
        model.estimatedDocConcentration().toArray(),
        spark_model.estimatedDocConcentration().toArray(),
        rtol=1e-5,
    )
    assert model.logLikelihood(stored) == pytest.approx(spark_model.logLikelihood(stored), rel=1e-5)
