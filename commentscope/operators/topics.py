"""Topics in comment texts: the term vocabulary and latent Dirichlet allocation."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.clustering import LDAModel
from pyspark.ml.feature import CountVectorizerModel, StopWordsRemover
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..storage import new_dir
from .online_lda import fit_online


def _documents(comments: DataFrame) -> DataFrame:
    return comments.where(F.col("body").isNotNull()).select(tokens(F.col("body")).alias("terms"))


# Stands for all documents among the terms, where a share of them is asked for. No token is empty.
ALL = ""


def _term_counts(documents: DataFrame, count_terms: bool, stop_words: list[str], total: bool) -> DataFrame:
    """Documents and occurrences per term; without `count_terms` a document counts a term once.
    With `total`, a term `ALL` counts the documents in the same pass."""
    if not count_terms:
        # Distinct terms without the stop words, in one pass over a document's terms.
        once = F.array_except("terms", F.lit(stop_words))
        listed = F.concat(F.array(F.lit(ALL)), once) if total else once
        per_term = documents.select(F.explode(listed).alias("term")).groupBy("term")
        return per_term.agg(F.count("*").alias("documents")).withColumn(
            "occurrences", F.col("documents")
        )
    # Each document lists its terms, and after them each distinct term once more.
    listed = documents.select(
        F.size("terms").alias("length"),
        F.posexplode(F.concat("terms", F.array_distinct("terms"))).alias("place", "term"),
    )
    return (
        listed.groupBy("term")
        .agg(
            F.count_if(F.col("place") >= F.col("length")).alias("documents"),
            F.count_if(F.col("place") < F.col("length")).alias("occurrences"),
        )
        .where(~F.col("term").isin(stop_words))
    )


def _vocabulary(
    documents: DataFrame, size: int, min_documents: float, count_terms: bool, language: str
) -> DataFrame:
    stop_words = StopWordsRemover.loadDefaultStopWords(language)
    order = [F.desc("occurrences"), "term"]
    share = min_documents < 1
    if not share or count_terms:
        # Occurrences and documents rank terms differently, so the cut needs the total before it.
        least = documents.agg(F.count("*") * min_documents).scalar() if share else F.lit(min_documents)
        counts = _term_counts(documents, count_terms, stop_words, total=False)
        return counts.where(F.col("documents") >= least).orderBy(*order).limit(size)
    # No term stands in more documents than there are, so the total leads the list.
    leading = _term_counts(documents, False, stop_words, total=True).orderBy(*order).limit(size + 1)
    total = F.max(F.when(F.col("term") == ALL, F.col("documents"))).over(Window.partitionBy())
    return (
        leading.withColumn("least", total * min_documents)
        .where((F.col("documents") >= F.col("least")) & (F.col("term") != ALL))
        .drop("least")
        .orderBy(*order)
        .limit(size)
    )


def topic_vocabulary(
    comments: DataFrame,
    *,
    size: int = 3000,
    min_documents: float = 500,
    count_terms: bool = False,
    language: str = "english",
) -> DataFrame:
    """The `size` most frequent terms, without stop words, that occur in at least
    `min_documents` documents.

    Below 1, `min_documents` is a share of the documents, which are counted in the same pass; with
    `count_terms` in a second one, which splits no text. Equal counts go by term. No job runs here.
    """
    return _vocabulary(_documents(comments), size, min_documents, count_terms, language)


@dataclass(frozen=True)
class Fit:
    """Fitted topics, the terms by index, and the stored vectors: of the documents that the fit has
    seen, and of those that were kept out of it."""

    model: LDAModel
    terms: list[str]
    seen: DataFrame
    kept_out: DataFrame


# A stored vector, read without Spark's type for it, which makes an object of each.
PLAIN_VECTORS = (
    "part bigint, features struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
)

# Ids are dealt into so many parts by their hash.
PARTS = 10_000


def _part(id_column: str) -> Column:
    """Part of a document, the same in every run and wherever it is stored."""
    return F.pmod(F.xxhash64(id_column), F.lit(PARTS))


def fit_topics(
    comments: DataFrame,
    *,
    seed: int,
    num_topics: int = 5,
    max_iter: int = 10,
    vocabulary_size: int = 3000,
    min_documents: float = 500,
    count_terms: bool = False,
    language: str = "english",
    id_column: str = "id",
    sampling_rate: float = 1.0,
    held_out_share: float = 0.0,
) -> Fit:
    """Topics by online variational Bayes.

    The fit looks at the share `sampling_rate` of the documents, chosen by a hash of their id, at
    all of these in each iteration, so nothing is drawn by partition and the seed alone decides.
    `held_out_share` keeps other documents out of it. A document counts a term once, unless
    `count_terms`. Fitting runs jobs: one for the vocabulary, which alone comes to the driver
    (`vocabulary_size` terms), one that stores the sparse vectors, and one per iteration.
    """
    documents = comments.where(F.col("body").isNotNull()).select(
        _part(id_column).alias("part"), tokens(F.col("body")).alias("terms")
    )
    vocabulary = _vocabulary(documents, vocabulary_size, min_documents, count_terms, language)
    terms = [row["term"] for row in vocabulary.collect()]
    if not terms:
        raise ValueError(f"no term occurs in at least {min_documents} documents")

    # The vectorizer passes over terms outside the vocabulary, stop words among them.
    vectorizer = CountVectorizerModel.from_vocabulary(
        terms, inputCol="terms", outputCol="features"
    ).setBinary(not count_terms)
    transformed = vectorizer.transform(documents).select("part", "features")
    path = new_dir(comments.sparkSession, "vectors")
    transformed.write.parquet(path)
    read = comments.sparkSession.read
    vectors = read.schema(transformed.schema).parquet(path)
    first_held_out = round(PARTS * (1 - held_out_share))
    fitted = F.col("part") < round(first_held_out * sampling_rate)
    seen = vectors.where(fitted).select("features")
    model = fit_online(
        read.schema(PLAIN_VECTORS).parquet(path).where(fitted).select("features"),
        len(terms),
        num_topics=num_topics,
        max_iter=max_iter,
        seed=seed,
    )
    kept_out = vectors.where(F.col("part") >= first_held_out).select("features")
    return Fit(model, terms, seen, kept_out)


def lda_topics(comments: DataFrame, *, terms_per_topic: int = 20, **options) -> DataFrame:
    """Topics of `fit_topics`, each with its heaviest terms and their weights."""
    return _described(fit_topics(comments, **options), terms_per_topic)


def _described(fit: Fit, terms_per_topic: int) -> DataFrame:
    lookup = F.lit(fit.terms)
    return fit.model.describeTopics(terms_per_topic).select(
        "topic",
        F.transform("termIndices", lambda i: F.element_at(lookup, i + 1)).alias("terms"),
        "termWeights",
    )


def _term_sums(vectors: DataFrame, size: int) -> list[float]:
    """How often each term occurs in all vectors: one number a term."""
    if vectors.isEmpty():
        return [0.0] * size
    return vectors.select(Summarizer.sum(F.col("features"))).first()[0].toArray().tolist()


def topic_checks(
    comments: DataFrame, *, terms_per_topic: int = 20, held_out_share: float = 0.1, **options
) -> DataFrame:
    """A row per topic that tells whether the fit holds: `distinct_terms` among its heaviest ones,
    how many of them are `known_terms` of the vocabulary, whether weights fall, and whether the
    topics explain documents kept out of the fit better than a single topic does.

    That compares the variational bound of the held-out likelihood with the exact likelihood under
    the terms' shares in all other documents, so the topics have to make up for the bound's slack.
    """
    fit = fit_topics(comments, held_out_share=held_out_share, **options)
    size = len(fit.terms)
    seen, kept_out = _term_sums(fit.seen, size), _term_sums(fit.kept_out, size)
    total = sum(seen) + size
    single = sum(n * math.log((m + 1) / total) for n, m in zip(kept_out, seen))
    better = bool(sum(kept_out)) and fit.model.logLikelihood(fit.kept_out) > single
    vocabulary = F.lit(fit.terms)
    falls = F.zip_with(
        F.slice("termWeights", 1, terms_per_topic - 1),
        F.slice("termWeights", 2, terms_per_topic - 1),
        lambda a, b: a >= b,
    )
    return _described(fit, terms_per_topic).select(
        "topic",
        F.size(F.array_distinct("terms")).alias("distinct_terms"),
        F.size(F.array_intersect("terms", vocabulary)).alias("known_terms"),
        F.forall(falls, lambda x: x).alias("falling_weights"),
        F.lit(better).alias("better_than_one_topic"),
    )
