"""Values that results must carry exactly: labels, cuts and patterns, and nothing else."""

# Weekday names by Spark's dayofweek number, 1 = Sunday.
DAY_NAMES = {
    1: "Domingo",
    2: "Lunes",
    3: "Martes",
    4: "Miércoles",
    5: "Jueves",
    6: "Viernes",
    7: "Sábado",
}

# Score bands of the score x sentiment matrix, each from its lower bound (inclusive).
SCORE_FLOORS = [
    (50, "Muy Alto (50+)"),
    (10, "Alto (10-49)"),
    (0, "Positivo (0-9)"),
    (-5, "Bajo (-5 a -1)"),
]
SCORE_BELOW_ALL = "Muy Bajo (<-5)"

# Sentiment bands of the same matrix, each from its lower bound (inclusive).
SENTIMENT_FLOORS = [
    (0.5, "Muy Positivo"),
    (0.1, "Positivo"),
    (-0.1, "Neutral"),
    (-0.5, "Negativo"),
]
SENTIMENT_BELOW_ALL = "Muy Negativo"

# Three score bands of the sentiment check (bounds exclusive).
CHECK_HIGH = (100, "Alto")
CHECK_LOW = (-10, "Bajo")
CHECK_MIDDLE = "Neutro"

# Content types of a community.
CONTROVERSIAL = "Controversial Negativo"
VIRAL = "Viral Positivo"
NEUTRAL = "Neutral"
NORMAL = "Normal"

# Further labels of extreme comments.
HIGH_ENGAGEMENT = "Alto Engagement"
EXTREME_SENTIMENT = "Sentimiento Extremo"

# Sentiment classes of the word ranking and of the community ranking.
POSITIVE_CLASS = "Positivo"
NEGATIVE_CLASS = "Negativo"
WORD_NEUTRAL_CLASS = "Neutral"
RANKING_NEUTRAL_CLASS = "Neutro"

# Activity alerts.
SPIKE = "Pico Alto"
DROP = "Caída Brusca"

# Characters that survive text cleaning. They are listed one by one because a
# regex class of single Latin letters is a bit table, and one with ranges is not.
LETTERS = "abcdefghijklmnopqrstuvwxyzáéíóúñü"
DIGITS = "0123456789"
