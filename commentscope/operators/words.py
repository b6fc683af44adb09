"""Word frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import NEGATIVE_CLASS, POSITIVE_CLASS, WORD_NEUTRAL_CLASS
from ..functions.text import tokens

# Spark cuts a ranked window to the wanted ranks before its shuffle up to this many ranks.
BUILT_IN_RANK_CUT = 1000
RANK_SHARDS = 64


def _leading(counts: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """The first `n` rows of each group, with their `rank`.

    Few groups hold all rows, so each must shrink before it meets in one task. Spark does that
    by itself for small `n`; beyond, the rows are ranked in shards first, which keeps every row
    that can be among the first `n`.
    """
    if n > BUILT_IN_RANK_CUT:
        shard = F.pmod(F.xxhash64("word"), F.lit(RANK_SHARDS))
        in_shard = Window.partitionBy(group, "shard").orderBy(*order)
        counts = (
            counts.withColumn("shard", shard)
            .withColumn("rank", F.row_number().over(in_shard))
            .where(F.col("rank") <= n)
            .drop("shard", "rank")
        )
    in_group = Window.partitionBy(group).orderBy(*order)
    return counts.withColumn("rank", F.row_number().over(in_group)).where(F.col("rank") <= n)


def top_words_by_sentiment(
    comments: DataFrame,
    *,
    top_n: int = 20,
    min_length: int = 4,
    sentiment_cut: float = 0.3,
    join_lines: bool = True,
) -> DataFrame:
    """The `top_n` words of each sentiment class; equal counts go by word.

    By default only the plain space and dropped characters part words, so two words around a
    line break count as one; `join_lines=False` parts them at any whitespace.
    """
    sentiment = F.col("sentiment")
    # No word reaches over a plain space, so the pieces between spaces are counted first, and each
    # distinct piece is lowered and matched once. A word has no more characters than its piece.
    # Counting all classes per piece shuffles one row a piece, not one a piece and class.
    by_piece = (
        comments.select(
            (sentiment > sentiment_cut).alias("positive"),
            (sentiment < -sentiment_cut).alias("negative"),
            F.explode(F.split("body", " ")).alias("piece"),
        )
        .where(F.length("piece") >= min_length)
        .groupBy("piece")
        .agg(
            F.count_if("positive").alias("positive"),
            F.count_if("negative").alias("negative"),
            F.count("*").alias("total"),
        )
    )
    words = tokens(F.col("piece"), min_length=min_length, join_lines=join_lines)
    by_word = (
        by_piece.select("positive", "negative", "total", F.explode(words).alias("word"))
        .groupBy("word")
        .agg(*[F.sum(name).alias(name) for name in ("positive", "negative", "total")])
    )
    in_class = {
        POSITIVE_CLASS: F.col("positive"),
        NEGATIVE_CLASS: F.col("negative"),
        WORD_NEUTRAL_CLASS: F.col("total") - F.col("positive") - F.col("negative"),
    }
    classes = [
        F.struct(F.lit(label).alias("sentiment_categoria"), count.alias("frecuencia"))
        for label, count in in_class.items()
    ]
    counts = by_word.select(F.inline(F.array(*classes)), "word").where(F.col("frecuencia") > 0)
    order = [F.desc("frecuencia"), F.asc("word")]
    return (
        _leading(counts, "sentiment_categoria", order, top_n)
        .select("sentiment_categoria", "word", "frecuencia", "rank")
        .orderBy("sentiment_categoria", "rank")
    )


def word_count(texts: DataFrame, *, column: str = "selftext") -> DataFrame:
    """How often each word occurs in `column`, most frequent first; digits part words."""
    return (
        texts.select(F.explode(tokens(F.col(column), keep_digits=False)).alias("palabra"))
        .groupBy("palabra")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "palabra")
    )
