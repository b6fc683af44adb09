"""Controversy by community."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import summary as S


def community_controversy(comments: DataFrame) -> DataFrame:
    """Comment count and means per community and content type, largest first."""
    keys = [
        S.key(comments, "subreddit_name").alias("subreddit_name"),
        S.key(comments, "content_type").alias("tipo_contenido"),
    ]
    return (
        S.summarise(comments, keys)
        .select(
            "subreddit_name",
            "tipo_contenido",
            F.col(S.MARK).alias("cantidad"),
            S.mean_score().alias("score_promedio"),
            S.mean_sentiment().alias("sentiment_promedio"),
        )
        .orderBy(F.desc("cantidad"), "subreddit_name", "tipo_contenido")
    )
