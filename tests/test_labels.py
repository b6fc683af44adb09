"""Every threshold at, just below and just above its value, and with missing values."""

import pytest
from pyspark.sql import functions as F

from commentscope.functions import labels

# id, score, sentiment, check band, score band, sentiment band, extreme label, content type, class
ROWS = [
    ("e01", 101, 0.71, "Alto", "Muy Alto (50+)", "Muy Positivo", "Viral Positivo", "Viral Positivo", "Positivo"),
    ("e02", 101, 0.7, "Alto", "Muy Alto (50+)", "Muy Positivo", "Alto Engagement", "Viral Positivo", "Positivo"),
    ("e03", 100, 0.71, "Neutro", "Muy Alto (50+)", "Muy Positivo", "Normal", "Viral Positivo", "Positivo"),
    ("e04", 50, 0.5, "Neutro", "Muy Alto (50+)", "Muy Positivo", "Normal", "Normal", "Positivo"),
    ("e05", 49, 0.51, "Neutro", "Alto (10-49)", "Muy Positivo", "Normal", "Viral Positivo", "Positivo"),
    ("e06", 21, 0.51, "Neutro", "Alto (10-49)", "Muy Positivo", "Normal", "Viral Positivo", "Positivo"),
    ("e07", 20, 0.51, "Neutro", "Alto (10-49)", "Muy Positivo", "Normal", "Normal", "Positivo"),
    ("e08", 10, 0.3, "Neutro", "Alto (10-49)", "Positivo", "Normal", "Normal", "Neutral"),
    ("e09", 9, 0.31, "Neutro", "Positivo (0-9)", "Positivo", "Normal", "Normal", "Positivo"),
    ("e10", 0, 0.1, "Neutro", "Positivo (0-9)", "Positivo", "Normal", "Neutral", "Neutral"),
    ("e11", -1, -0.31, "Neutro", "Bajo (-5 a -1)", "Negativo", "Normal", "Controversial Negativo", "Negativo"),
    ("e12", -1, -0.3, "Neutro", "Bajo (-5 a -1)", "Negativo", "Normal", "Normal", "Neutral"),
    ("e13", -5, -0.1, "Neutro", "Bajo (-5 a -1)", "Neutral", "Normal", "Neutral", "Neutral"),
    ("e14", -6, -0.11, "Neutro", "Muy Bajo (<-5)", "Negativo", "Normal", "Neutral", "Neutral"),
    ("e15", -10, -0.2, "Neutro", "Muy Bajo (<-5)", "Negativo", "Normal", "Normal", "Neutral"),
    ("e16", -11, -0.19, "Bajo", "Muy Bajo (<-5)", "Negativo", "Normal", "Neutral", "Neutral"),
    ("e17", -20, -0.71, "Bajo", "Muy Bajo (<-5)", "Muy Negativo", "Normal", "Controversial Negativo", "Negativo"),
    ("e18", -21, -0.71, "Bajo", "Muy Bajo (<-5)", "Muy Negativo", "Controversial Negativo", "Controversial Negativo", "Negativo"),
    ("e19", -21, -0.7, "Bajo", "Muy Bajo (<-5)", "Muy Negativo", "Normal", "Controversial Negativo", "Negativo"),
    ("e20", -101, 0.0, "Bajo", "Muy Bajo (<-5)", "Neutral", "Alto Engagement", "Neutral", "Neutral"),
    ("e21", 0, 0.8, "Neutro", "Positivo (0-9)", "Muy Positivo", "Normal", "Normal", "Positivo"),
    ("e22", 0, -0.81, "Neutro", "Positivo (0-9)", "Muy Negativo", "Sentimiento Extremo", "Normal", "Negativo"),
    ("e23", 5, -0.5, "Neutro", "Positivo (0-9)", "Negativo", "Normal", "Normal", "Negativo"),
    ("e24", 5, -0.51, "Neutro", "Positivo (0-9)", "Muy Negativo", "Normal", "Normal", "Negativo"),
    ("e25", None, 0.9, "Neutro", "Muy Bajo (<-5)", "Muy Positivo", "Sentimiento Extremo", "Normal", "Positivo"),
    ("e26", None, None, "Neutro", "Muy Bajo (<-5)", "Muy Negativo", "Normal", "Normal", "Neutral"),
    ("e27", 200, None, "Alto", "Muy Alto (50+)", "Muy Negativo", "Alto Engagement", "Normal", "Neutral"),
]


@pytest.fixture(scope="module")
def labelled(spark):
    df = spark.createDataFrame([r[:3] for r in ROWS], "id string, score bigint, sentiment double")
    score, sentiment = F.col("score"), F.col("sentiment")
    return {
        row["id"]: row
        for row in df.select(
            "id",
            labels.check_band(score).alias("check"),
            labels.score_band(score).alias("score_band"),
            labels.sentiment_band(sentiment).alias("sentiment_band"),
            labels.first_match(labels.extreme_rules(score, sentiment), "Normal").alias("extreme"),
            labels.content_type(score, sentiment).alias("content"),
            labels.polarity(sentiment, 0.3, "Neutral").alias("polarity"),
        ).collect()
    }


@pytest.mark.parametrize("row", ROWS, ids=[r[0] for r in ROWS])
def test_labels(labelled, row):
    assert tuple(labelled[row[0]])[1:] == row[3:]


def test_day_names(spark):
    days = spark.range(1, 8).select(F.col("id").cast("int").alias("d")).union(
        spark.sql("SELECT CAST(NULL AS INT)")
    )
    rows = days.select("d", labels.day_name(F.col("d")).alias("n")).collect()
    assert [r["n"] for r in sorted(rows, key=lambda r: (r["d"] is None, r["d"]))] == [
        "Domingo", "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", None,
    ]


def test_alert_threshold_is_strict(spark):
    df = spark.createDataFrame([(3.0,), (3.01,), (-3.0,), (-3.01,), (None,)], "z double")
    rows = df.select(labels.alert_label(F.col("z"), 3).alias("a")).collect()
    assert [r["a"] for r in rows] == ["Normal", "Pico Alto", "Normal", "Caída Brusca", "Normal"]


def test_not_a_number_counts_as_large(spark):
    df = spark.createDataFrame([(float("nan"),)], "s double")
    assert df.select(labels.sentiment_band(F.col("s"))).first()[0] == "Muy Positivo"
