"""Comparison of communities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import calendar_days, event_time
from ..plans import summary as S


def community_comparison(comments: DataFrame) -> DataFrame:
    """Scorecard per community, largest first.

    The pace divides by the calendar days from first to last comment, at least one.
    """
    days = calendar_days(F.col("primer_comentario"), F.col("ultimo_comentario"))
    pace = F.col("total_comentarios") / F.greatest("dias_activos", F.lit(1))
    return (
        S.summarise(comments, [S.key(comments, "subreddit_name").alias("subreddit_name")])
        .select(
            "subreddit_name",
            F.col(S.MARK).alias("total_comentarios"),
            S.mean_sentiment().alias("sentiment_promedio"),
            S.sentiment_deviation().alias("sentiment_std"),
            S.mean_score().alias("score_promedio"),
            F.col("nsfw_count").alias("contenido_nsfw"),
            event_time(F.col("first_utc")).alias("primer_comentario"),
            event_time(F.col("last_utc")).alias("ultimo_comentario"),
        )
        .select("*", days.alias("dias_activos"))
        .select("*", pace.alias("comentarios_por_dia"))
        .orderBy(F.desc("total_comentarios"), "subreddit_name")
    )
