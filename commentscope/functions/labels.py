"""Labels as ordered (condition, label) rules.

A condition that is NULL does not match, so a row with missing values takes the default label.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V

Rule = tuple[Column, str]


def first_match(rules: Sequence[Rule], default: str | None = None) -> Column:
    """Label of the first rule that holds; `default` (or NULL) when none does."""
    (condition, label), *rest = rules
    chain = F.when(condition, label)
    for condition, label in rest:
        chain = chain.when(condition, label)
    return chain if default is None else chain.otherwise(default)


def any_match(rules: Sequence[Rule]) -> Column:
    """True where at least one rule holds."""
    return reduce(lambda a, b: a | b, [condition for condition, _ in rules])


def banded(value: Column, floors: Sequence[tuple[float, str]], below: str) -> Column:
    """Band of `value`, given (lower bound, label) pairs from the highest bound down."""
    return first_match([(value >= floor, label) for floor, label in floors], below)


def outside(value: Column, limit: float) -> Column:
    """|value| > limit, written on the bare column so that it can reach a Parquet scan."""
    return (value > limit) | (value < -limit)


def within(value: Column, limit: float) -> Column:
    """|value| < limit, on the bare column."""
    return (value > -limit) & (value < limit)


def score_band(score: Column) -> Column:
    return banded(score, V.SCORE_FLOORS, V.SCORE_BELOW_ALL)


def sentiment_band(sentiment: Column) -> Column:
    return banded(sentiment, V.SENTIMENT_FLOORS, V.SENTIMENT_BELOW_ALL)


def check_band(
    score: Column,
    high: tuple[float, str] = V.CHECK_HIGH,
    low: tuple[float, str] = V.CHECK_LOW,
) -> Column:
    return first_match([(score > high[0], high[1]), (score < low[0], low[1])], V.CHECK_MIDDLE)


def polarity(sentiment: Column, cut: float, neutral: str) -> Column:
    """Positive beyond +cut, negative beyond -cut, else `neutral`."""
    return first_match(
        [(sentiment > cut, V.POSITIVE_CLASS), (sentiment < -cut, V.NEGATIVE_CLASS)], neutral
    )


def content_type(
    score: Column,
    sentiment: Column,
    *,
    negative_below: float = -0.3,
    viral_score: float = 20,
    viral_sentiment: float = 0.5,
    neutral_within: float = 0.2,
) -> Column:
    return first_match(
        [
            ((score < 0) & (sentiment < negative_below), V.CONTROVERSIAL),
            ((score > viral_score) & (sentiment > viral_sentiment), V.VIRAL),
            (within(sentiment, neutral_within), V.NEUTRAL),
        ],
        V.NORMAL,
    )


def extreme_rules(
    score: Column,
    sentiment: Column,
    *,
    viral_score: float = 100,
    viral_sentiment: float = 0.7,
    hated_score: float = -20,
    hated_sentiment: float = -0.7,
    engagement: float = 100,
    strong_sentiment: float = 0.8,
) -> list[Rule]:
    return [
        ((score > viral_score) & (sentiment > viral_sentiment), V.VIRAL),
        ((score < hated_score) & (sentiment < hated_sentiment), V.CONTROVERSIAL),
        (outside(score, engagement), V.HIGH_ENGAGEMENT),
        (outside(sentiment, strong_sentiment), V.EXTREME_SENTIMENT),
    ]


def day_name(day_number: Column, *, missing: str | None = None) -> Column:
    """Weekday name; a NULL day gives `missing`."""
    return first_match([(day_number == n, name) for n, name in V.DAY_NAMES.items()], missing)


def alert_label(deviation: Column, threshold: float) -> Column:
    return first_match([(deviation > threshold, V.SPIKE), (deviation < -threshold, V.DROP)], V.NORMAL)
