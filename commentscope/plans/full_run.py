"""The whole run: stored comments to stored reports, tables and views."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from .. import operators as O
from ..sinks import Writer, publish_results, write_result
from ..sources.results import read_result
from ..storage import path_exists
from . import summary as S


@dataclass(frozen=True)
class Output:
    """A report of the full run: its folder below the base path and how it is built."""

    folder: str
    source: str  # which input: hours, communities or comments
    build: Callable[[DataFrame], DataFrame]


# Result table and folder of every report, with the limits of a full run.
OUTPUTS: dict[str, Output] = {
    "tendencias_diarias": Output(
        "analytics/temporal/tendencias_diarias", "hours", O.daily_trend
    ),
    "patrones_horarios": Output(
        "analytics/temporal/patrones_horarios", "hours", O.hourly_pattern
    ),
    "anomalias": Output("analytics/temporal/anomalias", "hours", O.activity_anomalies),
    "validacion_sentimiento": Output(
        "analytics/sentiment/validacion", "communities", O.sentiment_check
    ),
    "distribucion_sentiment_score": Output(
        "analytics/sentiment/distribucion", "communities", O.score_sentiment_matrix
    ),
    "controversia_por_subreddit": Output(
        "analytics/engagement/controversia", "communities", O.community_controversy
    ),
    "comparativa_subreddits": Output(
        "reports/subreddit_comparativa", "communities", O.community_comparison
    ),
    "comentarios_extremos": Output(
        "analytics/sentiment/extremos",
        "comments",
        lambda comments: O.extreme_comments(
            comments, limit=500, score_floor=O.extreme_score_floor(comments, 500)
        ),
    ),
    "top_palabras_sentimiento": Output(
        "analytics/text/palabras_clave",
        "comments",
        lambda comments: O.top_words_by_sentiment(comments, top_n=50),
    ),
}


# Table and folder of the optional topics.
TOPICS_TABLE = "temas_lda"
TOPICS_FOLDER = "analytics/text/temas_lda"

SUMMARIES = ("hours", "communities")


def output_paths(base_path: str, run_name: str, *, topics: bool = False) -> dict[str, str]:
    """Where a run stores each result."""
    folders = {table: out.folder for table, out in OUTPUTS.items()}
    if topics:
        folders[TOPICS_TABLE] = TOPICS_FOLDER
    base = base_path.rstrip("/")
    return {table: f"{base}/{folder}/{run_name}" for table, folder in folders.items()}


def run_reports(
    comments: DataFrame,
    base_path: str,
    run_name: str,
    *,
    fmt: str = "parquet",
    parallel_jobs: int = 4,
    topics: Mapping[str, object] | None = None,
) -> dict[str, str]:
    """Compute and store every report; returns result table -> path.

    `topics` holds the arguments of `lda_topics` (at least a seed) and adds the topics, which
    hold arrays and so cannot be stored as CSV.

    Comments are scanned once for both summaries and once per report on single comments or texts.
    Summaries go to storage, so the seven reports on them read a small table that outlives any
    executor, and nothing is cached. Independent jobs run at the same time, so that the tail of
    one does not leave the cluster idle.
    """
    if topics is not None and fmt == "csv":
        raise ValueError("topics hold arrays, which CSV cannot store")
    spark = comments.sparkSession
    paths = output_paths(base_path, run_name, topics=topics is not None)

    def store_summaries() -> dict[str, DataFrame]:
        """Write both summaries and read them back by their known schema, each from its folder."""
        path = f"{base_path.rstrip('/')}/summaries/{run_name}"
        both = S.by_hour_and_community(comments)
        both.write.mode("overwrite").partitionBy("summary").parquet(path)
        read = spark.read.schema(both.schema).parquet(path)
        return {name: S.part_of(read, name) for name in SUMMARIES}

    def store(table: str, source: DataFrame) -> None:
        write_result(OUTPUTS[table].build(source), paths[table], fmt=fmt)

    def store_topics() -> None:
        write_result(O.lda_topics(comments, **topics), paths[TOPICS_TABLE], fmt=fmt)

    with ThreadPoolExecutor(parallel_jobs) as pool:

        def submit(job: Callable, *args):
            return pool.submit(inheritable_thread_target(spark)(job), *args)

        summaries = submit(store_summaries)
        jobs = [
            submit(store, table, comments)
            for table, out in OUTPUTS.items()
            if out.source == "comments"
        ]
        if topics is not None:
            jobs.append(submit(store_topics))
        ready = summaries.result()
        jobs += [
            submit(store, table, ready[out.source])
            for table, out in OUTPUTS.items()
            if out.source in ready
        ]
        for job in jobs:
            job.result()
    return paths


def stored_results(
    spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet"
) -> dict[str, Callable[[], DataFrame]]:
    """Readers of a run's results, by table; nothing is read before a reader is called."""

    def reader(table: str, path: str) -> Callable[[], DataFrame]:
        return lambda: read_result(spark, path, table, fmt)

    return {table: reader(table, path) for table, path in paths.items()}


def publish_run(
    spark: SparkSession,
    write: Writer,
    *,
    paths: Mapping[str, str] | None = None,
    base_path: str = "",
    run_name: str = "comments",
    fmt: str = "parquet",
    modes: Mapping[str, str] | None = None,
    reject_violations: bool = False,
    surrogate_id: bool = False,
) -> DataFrame:
    """Publish a run's stored results, from `paths` or from where the named run put them. Topics
    are published if the run stored them."""
    if not paths:
        paths = output_paths(base_path, run_name, topics=True)
        if not path_exists(spark, paths[TOPICS_TABLE]):
            del paths[TOPICS_TABLE]
    results = stored_results(spark, paths, fmt)
    return publish_results(
        spark, results, write, modes=modes, reject_violations=reject_violations,
        surrogate_id=surrogate_id, run_name=run_name,
    )


def register_result_views(
    spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet"
) -> list[str]:
    """Register the presentation views over a run's stored results."""
    readers = stored_results(spark, paths, fmt)
    return O.register_views({t: readers[t]() for t in readers if t in O.VIEW_NAMES})
