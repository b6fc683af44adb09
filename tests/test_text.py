import random

from pyspark.sql import functions as F

from commentscope import operators as O
from commentscope.functions.text import clean_text, tokens

SAMPLE = "Hello\nWorld CAFÉ-2024  ñandú\tÜber naïve"


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


def test_cleaning_keeps_whitespace_and_splits_at_foreign_letters(spark):
    assert one(spark, SAMPLE, clean_text) == "hello\nworld café 2024  ñandú\tüber na ve"


def test_tokens_joined_over_line_breaks(spark):
    found = one(spark, SAMPLE, lambda c: tokens(c, join_lines=True))
    assert found == ["hello\nworld", "café", "2024", "ñandú\tüber", "na", "ve"]


def test_tokens_without_digits(spark):
    found = one(spark, SAMPLE, lambda c: tokens(c, keep_digits=False))
    assert found == ["hello", "world", "café", "ñandú", "über", "na", "ve"]


def test_null_and_empty_text(spark):
    assert one(spark, None, tokens) is None
    assert one(spark, "", tokens) == []
    assert one(spark, "¿¡!?", tokens) == []


def test_tokens_equal_cleaning_splitting_and_filtering(spark):
    """One matching pass gives what the three steps give, on random text."""
    rng = random.Random(5)
    alphabet = "aábÑñüUzZ019 \t\n\x0b\f\r.-_'ßçÉé中😀İ \xa0"
    texts = [("".join(rng.choices(alphabet, k=rng.randint(0, 60))),) for _ in range(400)]
    df = spark.createDataFrame(texts, "t string")
    t = F.col("t")

    def split(cleaned, pattern, longer_than):
        return F.filter(F.split(cleaned, pattern), lambda w: F.length(w) > longer_than)

    wrong = df.where(
        (tokens(t, min_length=4, join_lines=True) != split(clean_text(t), " ", 3))
        | (tokens(t) != split(clean_text(t), r"\s+", 0))
        | (tokens(t, keep_digits=False) != split(clean_text(t, keep_digits=False), r"\s+", 0))
    )
    assert wrong.collect() == []


def test_top_words_ties_go_by_word_and_ranks_have_no_gap(spark, make_comments):
    df = make_comments(
        [
            {"sentiment": 0.9, "body": "beta alpha beta alpha gamma"},
            {"sentiment": 0.9, "body": "the cat gamma delta"},
            {"sentiment": None, "body": "unknown mood"},
            {"sentiment": 0.9, "body": None},
        ]
    )
    rows = [tuple(r) for r in O.top_words_by_sentiment(df, top_n=3).collect()]
    assert rows == [
        ("Neutral", "mood", 1, 1),
        ("Neutral", "unknown", 1, 2),
        ("Positivo", "alpha", 2, 1),
        ("Positivo", "beta", 2, 2),
        ("Positivo", "gamma", 2, 3),
    ]


def test_line_break_joins_words_unless_told_otherwise(make_comments):
    df = make_comments([{"sentiment": -0.9, "body": "sunny\nday sunny"}])
    joined = O.top_words_by_sentiment(df).collect()
    assert [r["word"] for r in joined] == ["sunny", "sunny\nday"]
    parted = O.top_words_by_sentiment(df, join_lines=False).collect()
    assert [(r["word"], r["frecuencia"]) for r in parted] == [("sunny", 2)]


def test_words_are_matched_once_per_distinct_piece(spark, make_comments):
    """The same counts as by matching every text whole, but texts are only parted at spaces before
    the pieces are counted."""
    rng = random.Random(7)
    alphabet = "aabbÑñüU019  \t\n.-'ßÉ中😀İK"
    df = make_comments(
        [
            {
                "sentiment": rng.choice([-0.9, 0.0, 0.9, None]),
                "body": "".join(rng.choices(alphabet, k=rng.randint(0, 80))),
            }
            for _ in range(300)
        ]
    )
    for length, joined in ((1, True), (4, True), (2, False)):
        words = tokens(F.col("body"), min_length=length, join_lines=joined)
        whole = (
            df.select("sentiment", F.explode(words).alias("word"))
            .withColumn(
                "sentiment_categoria",
                F.when(F.col("sentiment") > 0.3, "Positivo")
                .when(F.col("sentiment") < -0.3, "Negativo")
                .otherwise("Neutral"),
            )
            .groupBy("sentiment_categoria", "word")
            .agg(F.count("*").alias("frecuencia"))
        )
        found = O.top_words_by_sentiment(df, top_n=900, min_length=length, join_lines=joined)
        assert sorted(found.drop("rank").collect()) == sorted(whole.collect())
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        counted = plan.index("count(if")
        assert "regexp_extract_all" in plan[:counted]
        assert "regexp_extract_all" not in plan[counted:]


def test_large_ranking_is_the_same_in_shards(spark, make_comments, monkeypatch):
    from commentscope.operators import words

    rng = random.Random(11)
    df = make_comments(
        [
            {
                "sentiment": rng.choice([-0.9, 0.0, 0.9]),
                "body": " ".join(f"word{rng.randint(0, 300)}" for _ in range(30)),
            }
            for _ in range(60)
        ]
    )
    direct = O.top_words_by_sentiment(df, top_n=40).collect()
    monkeypatch.setattr(words, "BUILT_IN_RANK_CUT", 10)
    assert O.top_words_by_sentiment(df, top_n=40).collect() == direct
    assert len(direct) == 120


def test_word_count(spark):
    df = spark.createDataFrame([("a1b A, b",), (None,), ("a",)], "selftext string")
    assert [tuple(r) for r in O.word_count(df).collect()] == [("a", 3), ("b", 2)]


def test_vocabulary_counts_documents_or_occurrences(make_comments):
    df = make_comments(
        [{"body": "tree tree the leaf"}, {"body": "leaf tree"}, {"body": "root"}, {"body": None}]
    )
    presence = O.topic_vocabulary(df, min_documents=2).collect()
    assert [tuple(r) for r in presence] == [("leaf", 2, 2), ("tree", 2, 2)]
    counted = O.topic_vocabulary(df, min_documents=2, count_terms=True).collect()
    assert [tuple(r) for r in counted] == [("tree", 2, 3), ("leaf", 2, 2)]
    share = O.topic_vocabulary(df, min_documents=0.5).collect()
    assert [r["term"] for r in share] == ["leaf", "tree"]
