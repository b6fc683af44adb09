"""Activity over time. All three reports accept comments or the hourly summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import DAY_NAMES, NORMAL
from ..functions.labels import alert_label, day_name
from ..plans import summary as S
from .frames import trailing


def daily_trend(comments: DataFrame) -> DataFrame:
    """Mean sentiment and comment count per day; comments without a time form one NULL day."""
    day = F.date_trunc("day", S.key(comments, "hour")).alias("periodo")
    return (
        S.summarise(comments, [day])
        .select(
            "periodo",
            S.mean_sentiment().alias("avg_sentiment"),
            F.col(S.MARK).alias("volumen"),
        )
        .orderBy("periodo")
    )


def hourly_pattern(comments: DataFrame) -> DataFrame:
    """Means and comment count per weekday (1 = Sunday) and hour of day."""
    hour = S.key(comments, "hour")
    cells = S.summarise(
        comments, [F.dayofweek(hour).alias("dia_semana"), F.hour(hour).alias("hora")]
    )
    return cells.select(
        "dia_semana",
        "hora",
        # The contract names an unknown day like the last one of the week.
        day_name(F.col("dia_semana"), missing=DAY_NAMES[7]).alias("nombre_dia"),
        S.mean_score().alias("score_promedio"),
        F.col(S.MARK).alias("volumen"),
        S.mean_sentiment().alias("sentiment_promedio"),
    ).orderBy("dia_semana", "hora")


def activity_anomalies(
    comments: DataFrame,
    *,
    window_hours: int = 24,
    threshold: float = 3,
    block_rows: int | None = None,
) -> DataFrame:
    """Hours whose volume leaves the trailing mean by more than `threshold` deviations.

    The frame is the hour itself and the `window_hours` hours before it that have comments.
    The window runs in one task, over a row per clock hour (8,784 a year), never over comments.
    With `block_rows`, it runs in blocks of so many hours instead; the hours are stored for that.
    The hour takes part in its own mean, so |deviation| is at most (n - 1) / sqrt(n) in a frame
    of n rows: a threshold of 3 needs 11 rows or more.
    """
    hours = S.by_hour(comments).select(
        F.col("hour").alias("periodo"),
        F.col(S.MARK).alias("volumen"),
        S.mean_sentiment().alias("sentiment_promedio"),
    )
    measures = {"media_movil": F.avg("volumen"), "std_movil": F.stddev_samp("volumen")}
    if block_rows:
        framed = trailing(hours, ["periodo"], window_hours, measures, block_rows=block_rows)
    else:
        frame = Window.orderBy("periodo").rowsBetween(-window_hours, Window.currentRow)
        framed = hours.select("*", *[m.over(frame).alias(name) for name, m in measures.items()])
    scored = framed.select(
        "*",
        # A constant frame has no spread, and so no deviation.
        F.try_divide(F.col("volumen") - F.col("media_movil"), "std_movil").alias("desviacion_std"),
    )
    return (
        scored.select("*", alert_label(F.col("desviacion_std"), threshold).alias("es_anomalia"))
        .where(F.col("es_anomalia") != NORMAL)
        .orderBy(F.desc("periodo"))
    )
