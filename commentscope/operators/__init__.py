"""Reports. Each takes comments (or a summary of them) and returns a lazy DataFrame."""

from .engagement import community_controversy
from .reporting import community_comparison
from .sentiment import extreme_comments, extreme_score_floor, score_sentiment_matrix, sentiment_check
from .temporal import activity_anomalies, daily_trend, hourly_pattern
from .topics import fit_topics, lda_topics, topic_checks, topic_vocabulary
from .views import (
    VIEW_NAMES,
    community_ranking,
    create_views,
    recent_alerts,
    register_views,
    weekly_heatmap,
)
from .words import top_words_by_sentiment, word_count

__all__ = [
    "VIEW_NAMES",
    "activity_anomalies",
    "community_comparison",
    "community_controversy",
    "community_ranking",
    "create_views",
    "daily_trend",
    "extreme_comments",
    "extreme_score_floor",
    "hourly_pattern",
    "fit_topics",
    "lda_topics",
    "recent_alerts",
    "register_views",
    "score_sentiment_matrix",
    "sentiment_check",
    "top_words_by_sentiment",
    "topic_checks",
    "topic_vocabulary",
    "weekly_heatmap",
    "word_count",
]
