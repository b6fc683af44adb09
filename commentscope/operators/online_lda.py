"""Online variational Bayes for latent Dirichlet allocation, as Spark's optimizer does it.

Draws, start values and steps are those of `pyspark.ml.clustering.LDA` with its online optimizer
and documents drawn with replacement, so a seed gives the same topics up to the rounding of sums.
Spark infers one document at a time; here a task infers many at once (`functions/variational.py`).
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.clustering import LocalLDAModel
from pyspark.mllib.common import _py2java
from pyspark.mllib.linalg import Matrices, Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import variational

# Defaults of Spark's optimizer: how slowly and how far later steps count less, and the shape of
# the distribution of start values.
TAU0 = 1024.0
KAPPA = 0.51
GAMMA_SHAPE = 100.0


def _start_values(spark: SparkSession, seed: int, count: int) -> np.ndarray:
    """What Spark's optimizer draws from a gamma distribution."""
    jvm = spark._jvm
    twister = jvm.org.apache.commons.math3.random.MersenneTwister(seed)
    distributions = jvm.breeze.stats.distributions
    gamma = distributions.Gamma(GAMMA_SHAPE, 1.0 / GAMMA_SHAPE, distributions.RandBasis(twister))
    return np.array([float(x) for x in gamma.sample(count).mkString(",").split(",")])


def _wrapped(number: int) -> int:
    """A 64-bit number as the JVM adds."""
    return (number + (1 << 63)) % (1 << 64) - (1 << 63)


def _sums(drawn: DataFrame, betas: np.ndarray, alpha: np.ndarray, starts: list[np.ndarray]):
    """`variational.statistics` over all documents: sums by topic and term, sums by topic, count."""
    topics, size = betas.shape
    names = [f"s{k}" for k in range(topics)]
    context = drawn.sparkSession.sparkContext
    shared = context.broadcast((betas, alpha, starts))
    work = variational.statistics

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        betas, alpha, starts = shared.value
        start = starts[TaskContext.get().partitionId()]
        sums, logs, documents = work(batches, betas, alpha, start)
        if not documents:
            return
        # The last row holds what is not of a term.
        terms = np.append(np.arange(size), -1)
        columns = [np.append(row, log) for row, log in zip(sums, logs)]
        held = np.append(sums.any(axis=0), True)
        arrays = [pa.array(terms[held]), pa.array(np.full(held.sum(), documents))]
        arrays += [pa.array(column[held]) for column in columns]
        yield pa.RecordBatch.from_arrays(arrays, names=["term", "n", *names])

    schema = "term bigint, n bigint, " + ", ".join(f"{n} double" for n in names)
    rows = (
        drawn.mapInArrow(task, schema)
        .groupBy("term")
        .agg(F.sum("n").alias("n"), *[F.sum(n).alias(n) for n in names])
        .toArrow()
    )
    shared.unpersist()
    terms = rows.column("term").to_numpy()
    values = np.array([rows.column(n).to_numpy() for n in names])
    sums = np.zeros((topics, size))
    sums[:, terms[terms >= 0]] = values[:, terms >= 0]
    if not len(terms):
        return sums, np.zeros(topics), 0
    last = terms == -1
    return sums, values[:, last][:, 0], int(rows.column("n").to_numpy()[last][0])


def _next_alpha(alpha: np.ndarray, logs: np.ndarray, documents: int, weight: float) -> np.ndarray:
    """A weighted Newton step, unless it leaves the positive numbers."""
    gradient = documents * (logs / documents - variational.expectation(alpha))
    c = documents * variational.trigamma(alpha.sum())
    q = -documents * variational.trigamma(alpha)
    b = (gradient / q).sum() / (1 / c + (1 / q).sum())
    moved = alpha - weight * (gradient - b) / q
    return moved if (moved > 0).all() else alpha


def fit_online(
    documents: DataFrame, size: int, *, num_topics: int, max_iter: int, seed: int
) -> LocalLDAModel:
    """Topics of stored `documents`: `features`, a vector of `size` term counts, as the struct that
    stores it. Each iteration draws as many documents as there are, with replacement."""
    spark = documents.sparkSession
    # Workers find the package beside the driver's copy; on a cluster it comes with --py-files.
    root = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    random = spark._jvm.java.util.Random(seed)
    alpha, eta = np.full(num_topics, 1.0 / num_topics), 1.0 / num_topics
    # How often a term is of a topic.
    counts = _start_values(spark, random.nextLong(), num_topics * size).reshape(num_topics, size)
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("features.indices").alias("ids"),
        F.col("features.values").alias("counts"),
    )
    partitions = documents.rdd.getNumPartitions()
    step = 0
    for _ in range(max_iter):
        drawn = rows.sample(withReplacement=True, fraction=1.0, seed=random.nextLong())
        seeds = random.nextLong()
        starts = [_start_values(spark, _wrapped(seeds + k), num_topics) for k in range(partitions)]
        betas = np.exp(variational.expectation(counts.T).T)
        sums, logs, n = _sums(drawn, betas, alpha, starts)
        step += 1
        if not n:
            continue
        weight = (TAU0 + step) ** -KAPPA
        counts = (1 - weight) * counts + weight * (sums * betas + eta)
        alpha = _next_alpha(alpha, logs, n, weight)
    context = spark.sparkContext
    old = spark._jvm.org.apache.spark.mllib.clustering.LocalLDAModel(
        _py2java(context, Matrices.dense(size, num_topics, counts.ravel())),
        _py2java(context, Vectors.dense(alpha)),
        eta,
        GAMMA_SHAPE,
    )
    ml = spark._jvm.org.apache.spark.ml.clustering.LocalLDAModel(
        "lda_topics", size, old, spark._jsparkSession
    )
    model = LocalLDAModel(ml)
    model.setSeed(seed)
    return model
