"""Reports from a summary equal reports from comments."""

import random
import statistics

import pytest

from commentscope import operators as O
from commentscope.plans import summary as S
from commentscope.plans.full_run import (
    OUTPUTS,
    register_result_views,
    run_reports,
    stored_results,
)

FROM_HOURS = [O.daily_trend, O.hourly_pattern, O.activity_anomalies]
FROM_COMMUNITIES = [
    O.sentiment_check,
    O.score_sentiment_matrix,
    O.community_controversy,
    O.community_comparison,
]


def values(df):
    """Rows with doubles to nine places, in a fixed order."""

    def plain(value):
        return round(value, 9) + 0.0 if isinstance(value, float) else value

    return sorted((tuple(plain(v) for v in row) for row in df.collect()), key=repr)


@pytest.fixture(scope="module")
def odd_comments(make_comments):
    """Comments with missing values, constant groups and single rows."""
    rng = random.Random(3)
    rows = [
        {
            "subreddit_name": rng.choice(["a", "b", None]),
            "subreddit_nsfw": rng.choice([True, False, None]),
            "created_utc": rng.choice([None, 1704067200 + rng.randint(0, 10**6)]),
            "sentiment": rng.choice([None, rng.randint(-100, 100) / 100]),
            "score": rng.choice([None, rng.randint(-150, 150)]),
        }
        for _ in range(500)
    ]
    rows += [{"subreddit_name": "flat", "sentiment": 0.5, "score": s} for s in (-50, 0, 30, 120)]
    rows += [{"subreddit_name": "single", "sentiment": 0.1}, {"subreddit_name": "blank"}]
    return make_comments(rows)


@pytest.mark.parametrize("report", FROM_HOURS, ids=lambda f: f.__name__)
def test_hourly_summary(fixture_comments, odd_comments, report):
    for comments in (fixture_comments, odd_comments):
        assert values(report(S.by_hour(comments))) == values(report(comments))


@pytest.mark.parametrize("report", FROM_COMMUNITIES, ids=lambda f: f.__name__)
def test_community_summary(fixture_comments, odd_comments, report):
    for comments in (fixture_comments, odd_comments):
        assert values(report(S.by_community(comments))) == values(report(comments))


def test_summaries_merge_again(odd_comments):
    """Hours merged to days give the days' own measures."""
    hours = S.by_hour(odd_comments)
    assert values(O.daily_trend(S.summarise(hours, [S.key(hours, "hour")]))) == values(
        O.daily_trend(odd_comments)
    )


def test_spread_far_from_zero(make_comments):
    """Values near a billion, in parts whose means differ, and equal values that no sum holds exactly."""
    far = [{"subreddit_name": "far", "score": i % 300 - 100, "sentiment": 1e9 + i % 7} for i in range(700)]
    flat = [{"subreddit_name": "flat", "score": i % 300 - 100, "sentiment": 0.1} for i in range(701)]
    parts = S.by_community(make_comments(far + flat))
    assert parts.count() > 4
    merged = S.summarise(parts, [S.key(parts, "subreddit_name")])
    merged = {r["subreddit_name"]: r for r in merged.select("*", S.sentiment_deviation().alias("sd")).collect()}
    assert merged["far"]["sd"] == pytest.approx(statistics.stdev(i % 7 for i in range(700)), abs=1e-6)
    assert merged["flat"]["sd"] == 0


def test_both_summaries_in_one_scan(odd_comments):
    both = S.by_hour_and_community(odd_comments)
    for name, alone in (("hours", S.by_hour), ("communities", S.by_community)):
        part, expected = S.part_of(both, name), alone(odd_comments)
        assert sorted(part.columns) == sorted(expected.columns)
        assert values(part.select(expected.columns)) == values(expected)
    assert S.by_hour_and_community(odd_comments.limit(0)).collect() == []


def test_labels_per_community_stay_few(stored_comments):
    rows = S.by_community(stored_comments).groupBy("subreddit_name").count().collect()
    assert max(r["count"] for r in rows) <= 100


@pytest.fixture(scope="module")
def run(spark, stored_comments, tmp_path_factory):
    return run_reports(stored_comments, str(tmp_path_factory.mktemp("run")), "sample")


def test_full_run_stores_every_report(spark, run, stored_comments):
    expected = {
        "tendencias_diarias": O.daily_trend(stored_comments),
        "patrones_horarios": O.hourly_pattern(stored_comments),
        "anomalias": O.activity_anomalies(stored_comments),
        "validacion_sentimiento": O.sentiment_check(stored_comments),
        "distribucion_sentiment_score": O.score_sentiment_matrix(stored_comments),
        "controversia_por_subreddit": O.community_controversy(stored_comments),
        "comparativa_subreddits": O.community_comparison(stored_comments),
        "comentarios_extremos": O.extreme_comments(stored_comments, limit=500),
        "top_palabras_sentimiento": O.top_words_by_sentiment(stored_comments, top_n=50),
    }
    assert set(run) == set(OUTPUTS) == set(expected)
    for table, reader in stored_results(spark, run).items():
        assert values(reader()) == values(expected[table]), table


def test_views_over_a_run(spark, run):
    assert register_result_views(spark, run) == [
        "view_heatmap_semanal",
        "view_ranking_subreddits",
        "view_alertas_recientes",
    ]
    alerts = spark.table("view_alertas_recientes")
    assert alerts.columns == ["periodo", "tipo_anomalia", "volumen", "sentiment_promedio"]
    assert spark.table("view_heatmap_semanal").count() > 0
