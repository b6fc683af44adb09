"""Sentiment against votes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import any_match, extreme_rules, first_match
from ..functions.times import magnitude
from ..plans import summary as S

PREVIEW_CHARACTERS = 200


def sentiment_check(comments: DataFrame) -> DataFrame:
    """Mean and spread of sentiment for high, low and middling scores."""
    band = S.key(comments, "check_band").alias("rango_score")
    return S.summarise(comments, [band]).select(
        "rango_score",
        S.mean_sentiment().alias("avg_sentiment_real"),
        S.sentiment_deviation().alias("desviacion_sentiment"),
    )


def score_sentiment_matrix(comments: DataFrame) -> DataFrame:
    """Comment count per score band and sentiment band."""
    keys = [
        S.key(comments, "score_band").alias("rango_score"),
        S.key(comments, "sentiment_band").alias("rango_sentiment"),
    ]
    return (
        S.summarise(comments, keys)
        .select("rango_score", "rango_sentiment", F.col(S.MARK).alias("cantidad"))
        .orderBy("rango_score", "rango_sentiment")
    )


def _candidates(comments: DataFrame, score_floor: int | None) -> DataFrame:
    rules = extreme_rules(F.col("score"), F.col("sentiment"))
    found = comments.where(any_match(rules))
    if score_floor is not None:
        found = found.where((F.col("score") >= score_floor) | (F.col("score") <= -score_floor))
    return found


def extreme_comments(
    comments: DataFrame, *, limit: int = 100, score_floor: int | None = None
) -> DataFrame:
    """The `limit` extreme comments with the largest |score|; equal scores go by id.

    Each task keeps its own best `limit` rows. The conditions are on bare columns, so Parquet
    skips pages without candidates. `score_floor` from `extreme_score_floor` narrows that
    further without changing the answer.
    """
    rules = extreme_rules(F.col("score"), F.col("sentiment"))
    return (
        _candidates(comments, score_floor)
        .select(
            "id",
            "subreddit_name",
            "created_utc",
            "score",
            "sentiment",
            first_match(rules).alias("extremo_tipo"),
            F.substring("body", 1, PREVIEW_CHARACTERS).alias("preview_texto"),
            magnitude(F.col("score")).alias("size"),
        )
        .orderBy(F.desc("size"), "id")
        .limit(limit)
        .drop("size")
    )


def extreme_score_floor(comments: DataFrame, limit: int) -> int | None:
    """|score| of the last comment that makes the list, read from the two number columns only.

    None when fewer than `limit` extreme comments have a score. This runs a job and brings one
    number to the driver.
    """
    size = magnitude(F.col("score")).alias("size")
    best = _candidates(comments, None).select(size).orderBy(F.desc("size")).limit(limit)
    row = best.agg(F.count("size").alias("n"), F.min("size").alias("floor")).first()
    return row["floor"] if row["n"] == limit else None
