import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from commentscope import operators as O
from commentscope.functions.times import event_time, magnitude, parse_time

SUNDAY_NIGHT = 1704670200  # 2024-01-07 23:30 UTC


def hourly_volumes(volumes, start=1704067200):
    """Comments with the given counts per consecutive hour."""
    return [
        {"id": f"{h}-{i}", "created_utc": start + 3600 * h + i, "sentiment": 0.5}
        for h, volume in enumerate(volumes)
        for i in range(volume)
    ]


def test_daily_trend_keeps_unknown_days(make_comments):
    df = make_comments(
        [
            {"created_utc": SUNDAY_NIGHT, "sentiment": 0.5},
            {"created_utc": SUNDAY_NIGHT + 60, "sentiment": None},
            {"created_utc": SUNDAY_NIGHT + 3600, "sentiment": -0.5},
            {"created_utc": None, "sentiment": 1.0},
        ]
    )
    assert [tuple(r) for r in O.daily_trend(df).collect()] == [
        (None, 1.0, 1),
        (dt.datetime(2024, 1, 7), 0.5, 2),
        (dt.datetime(2024, 1, 8), -0.5, 1),
    ]


def test_hourly_pattern_day_numbers(make_comments):
    df = make_comments([{"created_utc": SUNDAY_NIGHT, "score": 4}, {"created_utc": None}])
    assert [tuple(r) for r in O.hourly_pattern(df).collect()] == [
        (None, None, "Sábado", None, 1, None),
        (1, 23, "Domingo", 4.0, 1, None),
    ]


@pytest.mark.parametrize(
    ("hours", "deviation"), [(9, 2.667), (10, 2.846), (11, 3.015), (25, 4.8), (40, 4.8)]
)
def test_deviation_is_bounded_by_the_frame(make_comments, hours, deviation):
    df = make_comments(hourly_volumes([1] * (hours - 1) + [1000]))
    rows = O.activity_anomalies(df, threshold=2.5).collect()
    assert len(rows) == 1
    assert rows[0]["desviacion_std"] == pytest.approx(deviation, abs=5e-4)
    found = O.activity_anomalies(df).count()
    assert found == (1 if hours >= 11 else 0)


def test_constant_volume_has_no_alert(make_comments):
    assert O.activity_anomalies(make_comments(hourly_volumes([3] * 30))).count() == 0


def test_drop_is_labelled(make_comments):
    df = make_comments(hourly_volumes([50] * 24 + [1]))
    assert [r["es_anomalia"] for r in O.activity_anomalies(df).collect()] == ["Caída Brusca"]


def test_extreme_comments_order_ties_by_id_and_cut_the_preview(make_comments):
    df = make_comments(
        [
            {"id": "b", "score": 300, "body": "x" * 500},
            {"id": "a", "score": -300, "body": "short"},
            {"id": "c", "score": 500, "sentiment": 0.8},
            {"id": "d", "sentiment": -0.9},
            {"id": "e", "score": 100, "sentiment": 0.8},
        ]
    )
    rows = O.extreme_comments(df).collect()
    assert [r["id"] for r in rows] == ["c", "a", "b", "d"]
    assert len(rows[2]["preview_texto"]) == 200
    assert [r["id"] for r in O.extreme_comments(df, limit=2).collect()] == ["c", "a"]


@pytest.mark.parametrize("limit", [1, 7, 100, 500])
def test_score_floor_does_not_change_the_list(stored_comments, limit):
    floor = O.extreme_score_floor(stored_comments, limit)
    direct = O.extreme_comments(stored_comments, limit=limit).collect()
    assert O.extreme_comments(stored_comments, limit=limit, score_floor=floor).collect() == direct


def test_score_floor_is_unknown_when_candidates_are_few(make_comments):
    df = make_comments([{"score": 300}, {"sentiment": 0.9}])
    assert O.extreme_score_floor(df, 2) is None
    assert O.extreme_score_floor(df, 1) == 300


def test_comparison_of_communities(make_comments):
    day = 86400
    df = make_comments(
        [
            {"subreddit_name": "a", "created_utc": 0, "sentiment": 0.0, "subreddit_nsfw": True},
            {"subreddit_name": "a", "created_utc": 4 * day, "sentiment": 1.0, "score": 3},
            {"subreddit_name": "a", "created_utc": day, "subreddit_nsfw": False},
            {"subreddit_name": "b", "created_utc": None, "sentiment": 0.25},
        ]
    )
    a, b = O.community_comparison(df).collect()
    assert (a["total_comentarios"], a["contenido_nsfw"], a["dias_activos"]) == (3, 1, 4)
    assert a["sentiment_std"] == pytest.approx(math.sqrt(0.5))
    assert a["comentarios_por_dia"] == 0.75
    assert (b["sentiment_std"], b["dias_activos"], b["comentarios_por_dia"]) == (None, None, 1.0)
    assert b["primer_comentario"] is None


def test_ranking_cuts_and_labels(spark):
    comparison = spark.createDataFrame(
        [
            ("big", 51, 0.21, 3.0),
            ("edge", 52, 0.2, 2.0),
            ("cold", 90, -0.21, 1.0),
            ("small", 50, 0.9, 1.0),
            ("mute", 53, None, 1.0),
        ],
        "subreddit_name string, total_comentarios bigint, sentiment_promedio double,"
        "comentarios_por_dia double",
    )
    ranking = O.community_ranking(comparison).collect()
    assert [(r["subreddit_name"], r["etiqueta_sentimiento"]) for r in ranking] == [
        ("cold", "Negativo"),
        ("mute", "Neutro"),
        ("edge", "Neutro"),
        ("big", "Positivo"),
    ]
    assert ranking[3]["velocidad_actividad"] == 3.0


def test_heatmap_leaves_an_unknown_day_unnamed(make_comments):
    df = make_comments([{"created_utc": None}, {"created_utc": SUNDAY_NIGHT}])
    heat = O.weekly_heatmap(O.hourly_pattern(df)).collect()
    assert {(r["dia_nombre"], r["dia_semana"]) for r in heat} == {(None, None), ("Domingo", 1)}


def test_every_comment_is_counted_once(fixture_comments):
    total = fixture_comments.count()

    def summed(df, column):
        return df.agg(F.sum(column)).first()[0]

    assert summed(O.daily_trend(fixture_comments), "volumen") == total
    assert summed(O.hourly_pattern(fixture_comments), "volumen") == total
    assert summed(O.score_sentiment_matrix(fixture_comments), "cantidad") == total
    assert summed(O.community_controversy(fixture_comments), "cantidad") == total
    assert summed(O.community_comparison(fixture_comments), "total_comentarios") == total


def test_times_out_of_range_are_unknown(spark):
    df = spark.createDataFrame([(0,), (2**62,), (-(2**63),), (None,)], "s bigint")
    assert [r[0] for r in df.select(event_time(F.col("s"))).collect()] == [
        dt.datetime(1970, 1, 1), None, None, None,
    ]


def test_parse_time_from_text(spark):
    df = spark.createDataFrame([("2024-01-07 23:30:00",), ("60",), ("soon",), (None,)], "t string")
    assert [r[0] for r in df.select(parse_time(F.col("t"))).collect()] == [
        dt.datetime(2024, 1, 7, 23, 30), dt.datetime(1970, 1, 1, 0, 1), None, None,
    ]


def test_magnitude_of_the_smallest_integer(spark):
    df = spark.createDataFrame([(-3,), (3,), (-(2**63),), (None,)], "v bigint")
    assert [r[0] for r in df.select(magnitude(F.col("v"))).collect()] == [3, 3, -(2**63), None]


def test_topics_need_a_vocabulary_and_repeat_with_their_seed(make_comments):
    df = make_comments(
        [{"body": f"sea water wave {i % 3}"} for i in range(30)]
        + [{"body": f"car road wheel {i % 3}"} for i in range(30)]
    )
    with pytest.raises(ValueError, match="500 documents"):
        O.lda_topics(df, seed=1)
    topics = O.lda_topics(df, seed=1, num_topics=2, min_documents=5, terms_per_topic=3)
    assert topics.columns == ["topic", "terms", "termWeights"]
    rows = topics.collect()
    assert len(rows) == 2
    for row in rows:
        assert len(row["terms"]) == 3
        assert list(row["termWeights"]) == sorted(row["termWeights"], reverse=True)
