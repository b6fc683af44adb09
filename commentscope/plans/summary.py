"""Mergeable summaries of comments.

Most reports are counts, means and spreads of the same three columns under different keys.
A summary keeps the additive parts of those measures per group, so it can be merged to any
coarser grouping. Two summaries answer seven reports:

* the hourly one (a row per clock hour) feeds daily trend, hourly pattern and anomalies;
* the community one (a row per community and combination of labels, at most a few dozen
  combinations each) feeds sentiment check, score matrix, controversy and comparison.

Comments are then read once for both, narrow columns only, and the reports read the small
summaries. Each grouping is a plain aggregation, so partial sums are formed before the shuffle
and a community that holds a third of all comments costs one partial row per task and label.

Spreads merge as sums of squares around a mean that is known before they are added up, so nothing
cancels where values are far from zero and close together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.times import event_time

# Keys that reports group by, as expressions over raw comments.
KEYS = {
    "hour": lambda: F.date_trunc("hour", event_time(F.col("created_utc"))),
    "subreddit_name": lambda: F.col("subreddit_name"),
    "check_band": lambda: labels.check_band(F.col("score")),
    "score_band": lambda: labels.score_band(F.col("score")),
    "sentiment_band": lambda: labels.sentiment_band(F.col("sentiment")),
    "content_type": lambda: labels.content_type(F.col("score"), F.col("sentiment")),
}

COMMUNITY_KEYS = ("subreddit_name", "check_band", "score_band", "sentiment_band", "content_type")

MARK = "comment_count"


def is_summary(df: DataFrame) -> bool:
    return MARK in df.columns


def key(df: DataFrame, name: str) -> Column:
    """Key column `name`: stored in a summary, computed from raw comments."""
    return F.col(name) if is_summary(df) else KEYS[name]()


def _measures() -> list[Column]:
    seen = F.count("sentiment")
    return [
        F.count("*").alias(MARK),
        F.count("score").alias("score_count"),
        F.sum(F.col("score").cast("double")).alias("score_sum"),
        seen.alias("sentiment_count"),
        F.sum("sentiment").alias("sentiment_sum"),
        (F.var_pop("sentiment") * seen).alias("sentiment_spread"),
        F.min("sentiment").alias("sentiment_min"),
        F.max("sentiment").alias("sentiment_max"),
        F.count_if("subreddit_nsfw").alias("nsfw_count"),
        F.min("created_utc").alias("first_utc"),
        F.max("created_utc").alias("last_utc"),
    ]


# Mean over all parts of a group, known to each part.
CENTRE = "centre"


def _merged_measures() -> list[Column]:
    least, most = F.min("sentiment_min"), F.max("sentiment_max")
    # Squares inside the parts plus those between the means of the parts and the common mean.
    between = F.col("sentiment_count") * (mean_sentiment() - F.col(CENTRE)) ** 2
    spread = F.sum(F.col("sentiment_spread") + between)
    return [
        F.sum(MARK).alias(MARK),
        F.sum("score_count").alias("score_count"),
        F.sum("score_sum").alias("score_sum"),
        F.sum("sentiment_count").alias("sentiment_count"),
        F.sum("sentiment_sum").alias("sentiment_sum"),
        # Means of equal values may differ in their last bits; equal values have no spread.
        F.when(least == most, F.lit(0.0)).otherwise(spread).alias("sentiment_spread"),
        least.alias("sentiment_min"),
        most.alias("sentiment_max"),
        F.sum("nsfw_count").alias("nsfw_count"),
        F.min("first_utc").alias("first_utc"),
        F.max("last_utc").alias("last_utc"),
    ]


def _merged(summary: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """A finer summary merged to `keys`. The window serves the spread alone: Catalyst drops it from
    reports without one. It needs the same distribution as the grouping after it."""
    names = summary.select(*keys).columns
    measures = [c for c in summary.columns if c not in KEYS and c not in names]
    group = Window.partitionBy(*names)
    centre = F.try_divide(F.sum("sentiment_sum").over(group), F.sum("sentiment_count").over(group))
    parts = summary.select(*keys, *measures).withColumn(CENTRE, centre)
    return parts.groupBy(*names).agg(*_merged_measures())


def summarise(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """Measures per group, from raw comments or from a finer summary.

    Reports that use few measures pay for few: Catalyst drops the unused aggregates.
    """
    return _merged(df, keys) if is_summary(df) else df.groupBy(*keys).agg(*_measures())


def by_hour_and_community(comments: DataFrame) -> DataFrame:
    """Both summaries of raw comments in one scan, told apart by `summary` (`hours` or
    `communities`); the keys of the other one are NULL."""
    names = ["hour", *COMMUNITY_KEYS]
    keyed = comments.select(
        *[KEYS[name]().alias(name) for name in names],
        "subreddit_nsfw", "created_utc", "sentiment", "score",
    )
    which = F.when(F.grouping("hour") == 0, "hours").otherwise("communities")
    return keyed.groupingSets([["hour"], list(COMMUNITY_KEYS)], *names).agg(
        which.alias("summary"), *_measures()
    )


def part_of(summaries: DataFrame, name: str) -> DataFrame:
    """One of the two summaries, with its own keys."""
    others = COMMUNITY_KEYS if name == "hours" else ("hour",)
    return summaries.where(F.col("summary") == name).drop("summary", *others)


def by_hour(comments: DataFrame) -> DataFrame:
    return summarise(comments, [key(comments, "hour").alias("hour")])


def by_community(comments: DataFrame) -> DataFrame:
    return summarise(comments, [key(comments, name).alias(name) for name in COMMUNITY_KEYS])


def mean_score() -> Column:
    return F.try_divide("score_sum", "score_count")


def mean_sentiment() -> Column:
    return F.try_divide("sentiment_sum", "sentiment_count")


def sentiment_deviation() -> Column:
    """Sample standard deviation; NULL for fewer than two values."""
    return F.sqrt(F.try_divide(F.col("sentiment_spread"), F.col("sentiment_count") - 1))
