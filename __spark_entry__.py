"""Queries over the test tables, and the same questions as SQL for an independent check."""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from commentscope import fixtures  # noqa: E402
from commentscope import operators as O  # noqa: E402
from commentscope.functions.text import clean_text  # noqa: E402
from commentscope.plans.full_run import (  # noqa: E402
    publish_run,
    run_reports,
    stored_results,
)
from commentscope.plans.summary import by_community, by_hour  # noqa: E402
from commentscope.schemas import RAW_HEADER, conform, violations  # noqa: E402
from commentscope.sinks import (  # noqa: E402
    clean_for_serving,
    publish_results,
    version_writer,
    write_result,
)
from commentscope.sources import (  # noqa: E402
    land_checked,
    land_raw,
    read_comments_csv,
    read_result,
)
from commentscope.storage import new_dir  # noqa: E402
from oracles import CONTROL_TOTALS, ORACLES  # noqa: E402

# The training-data operators are a subpackage of their own, which the rest works without.
try:
    import corpus_pipeline
    from commentscope.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "commentscope.llm"):
        raise
    LLM_QUERIES, LLM_ORACLES = {}, {}
else:
    LLM_QUERIES = {**llm_queries.QUERIES, "pipeline": corpus_pipeline.run}
    LLM_ORACLES = dict(llm_queries.ORACLES)
    if corpus_pipeline.ORACLE_SQL is not None:
        LLM_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

Query = Callable[[SparkSession, str], DataFrame]


def _comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return fixtures.comments(spark, sf_dir)


def _places(value: Column, places: int = 6) -> Column:
    return F.round(value + F.lit(1e-9), places) + F.lit(0.0)


def _comparable(df: DataFrame) -> DataFrame:
    """Doubles to six places, times without a zone, as the SQL side gives them.

    The nudge keeps exact halves, which two engines can hold a last bit apart, from rounding
    to different sides.
    """
    kinds = dict(df.dtypes)

    def column(name: str) -> Column:
        if kinds[name] == "double":
            return _places(F.col(name)).alias(name)
        if kinds[name] == "timestamp":
            return F.col(name).cast("timestamp_ntz").alias(name)
        return F.col(name)

    return df.select(*[column(c) for c in df.columns])


def _report(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _comparable(build(_comments(spark, sf_dir)))


# --- text --------------------------------------------------------------------------------


def _word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fixtures.spread(fixtures.table(spark, sf_dir, "documents"), "doc_id")
    return O.word_count(documents, column="text")


def _cleaned_text(comments: DataFrame) -> DataFrame:
    cleaned = clean_text(F.col("body"))
    return comments.select("id", F.md5(cleaned).alias("clean_md5"), F.length(cleaned).alias("chars"))


def _vocabulary(comments: DataFrame) -> DataFrame:
    return O.topic_vocabulary(comments, min_documents=0.05)


def _vocabulary_counts(comments: DataFrame) -> DataFrame:
    return O.topic_vocabulary(comments, min_documents=0.05, count_terms=True)


def _topics(comments: DataFrame) -> DataFrame:
    return O.lda_topics(comments, seed=20240101, min_documents=0.05)


def _topic_checks(comments: DataFrame) -> DataFrame:
    return O.topic_checks(comments, seed=20240101, min_documents=0.05, max_iter=5)


# --- files and tables --------------------------------------------------------------------

# Least number of files of a large dataset: Spark's CSV reader takes one task for each.
CSV_FILES = 16

# Rows of a raw file, as texts of a few kB; a file is read by one task, however large the dataset.
RAW_FILE_ROWS = 20_000
RAW_COMPRESSION = "gzip"


def _write_raw(comments: DataFrame, path: str, rows_per_file: int = RAW_FILE_ROWS) -> None:
    """Comments as raw CSV files, from where they are: texts are not shuffled for it."""
    write_result(
        comments.toDF(*RAW_HEADER),
        path,
        fmt="csv",
        rows_per_file=rows_per_file,
        compression=RAW_COMPRESSION,
    )


def _raw_csv(spark: SparkSession, sf_dir: str, files: int = 1) -> str:
    """The comments as a raw CSV folder with the dotted header, in `files` files at least."""
    path = new_dir(spark, "raw-csv")
    comments = _comments(spark, sf_dir)
    share = comments.count() // files if files > 1 else RAW_FILE_ROWS
    _write_raw(comments, path, max(1, min(share, RAW_FILE_ROWS)))
    return path


def _hashed(comments: DataFrame) -> DataFrame:
    return comments.withColumn("body", F.md5("body"))


def _csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hashed(read_comments_csv(spark, _raw_csv(spark, sf_dir)))


def _csv_scan_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hashed(read_comments_csv(spark, _raw_csv(spark, sf_dir, CSV_FILES)))


def _dataset_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw comments in two folders below the dataset's folder, one of them deeper."""
    path = new_dir(spark, "dataset")
    comments = _comments(spark, sf_dir)
    odd = F.col("id").cast("bigint") % 2
    for folder, part in (("a", 0), ("b/c", 1)):
        _write_raw(comments.where(odd == part), f"{path}/{folder}")
    return _landed_days(land_raw(spark, path, new_dir(spark, "bronze")))


def _bronze_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw_csv(spark, sf_dir, CSV_FILES)
    return _landed_days(land_raw(spark, raw, new_dir(spark, "bronze")))


def _landed_days(landed: DataFrame) -> DataFrame:
    return (
        landed.groupBy(F.to_date(F.timestamp_seconds("created_utc")).alias("day"))
        .agg(
            F.count("*").alias("comments"),
            F.count("body").alias("bodies"),
            F.sum("score").alias("score_sum"),
            F.sum(F.length("body")).cast("bigint").alias("characters"),
        )
        .orderBy("day")
    )


def _round_trip(fmt: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = new_dir(spark, f"result-{fmt}")
        extremes = O.extreme_comments(_comments(spark, sf_dir), limit=500)
        write_result(extremes, path, fmt=fmt, single_file=True)
        return read_result(spark, path, "comentarios_extremos", fmt)

    return query


def _serving_cleanup(comments: DataFrame) -> DataFrame:
    """Daily trend as untyped text with an index column and unreadable days, made to conform."""
    text = O.daily_trend(comments).select(
        F.lit("0").alias("Unnamed: 0"),
        F.when(F.dayofmonth("periodo") % 7 != 0, F.date_format("periodo", "yyyy-MM-dd HH:mm:ss"))
        .otherwise("unknown day")
        .alias("periodo"),
        F.col("avg_sentiment").cast("string").alias("avg_sentiment"),
        F.col("volumen").cast("string").alias("volumen"),
    )
    return conform(clean_for_serving(text), "tendencias_diarias")


def _without_some_times(comments: DataFrame) -> DataFrame:
    known = F.col("id").cast("bigint") % 83 != 0
    return comments.withColumn("created_utc", F.when(known, F.col("created_utc")))


def _pattern_unknown_times(comments: DataFrame) -> DataFrame:
    return O.hourly_pattern(_without_some_times(comments))


def _declared_checks(comments: DataFrame) -> DataFrame:
    return violations(_pattern_unknown_times(comments), "patrones_horarios")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _full_run(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    return run_reports(_comments(spark, sf_dir), new_dir(spark, "run"), "comments")


def _full_run_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = stored_results(spark, _full_run(spark, sf_dir))
    return _union(
        [
            results[table]().agg(
                F.lit(table).alias("output"),
                F.count("*").alias("rows"),
                _places(F.expr(total).cast("double"), 3).alias("control_total"),
            )
            for table, total in CONTROL_TOTALS.items()
        ]
    )


def _row_text(df: DataFrame) -> Column:
    """A row as text that both engines write alike: doubles to six places, times without zone."""
    kinds = dict(df.dtypes)

    def text(name: str) -> Column:
        value = F.col(name)
        if kinds[name] == "double":
            value = _places(value).cast("decimal(20,6)")
        if kinds[name] == "timestamp":
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        return F.coalesce(value.cast("string"), F.lit("-"))

    return F.concat_ws("|", *[text(name) for name in df.columns]).alias("row_text")


def _new_database(spark: SparkSession) -> str:
    location = new_dir(spark, "serving")
    database = "serving_" + location.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{location}'")
    return database


def _published_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of all tables, of which one half grows by appending, after a run was published
    twice."""
    results = stored_results(spark, _full_run(spark, sf_dir))
    database = _new_database(spark)
    modes = {table: "append" for table in list(results)[::2]}
    for _ in range(2):
        status = publish_results(
            spark, results, version_writer(database, "comments"), modes=modes
        )
    tables = [spark.table(f"{database}.{table}") for table in results]
    rows = _union(
        [df.select(F.lit(t).alias("table"), _row_text(df)) for t, df in zip(results, tables)]
    )
    return rows.join(F.broadcast(status), "table").select("table", "status", "row_text")


def _result_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the views in the catalog, read by another session."""
    paths = _full_run(spark, sf_dir)
    database = _new_database(spark)
    publish_run(spark, version_writer(database, "comments"), paths=paths)
    names = O.create_views(spark, database)
    reader = spark.newSession()
    reader.conf.set("spark.sql.session.timeZone", "UTC")
    views = [reader.table(name) for name in names]
    return _union(
        [
            df.select(F.lit(name.split(".")[1]).alias("view"), _row_text(df))
            for name, df in zip(names, views)
        ]
    )


# Files whose last record is never closed, and how many records each of them has.
DEFECT_FILES = 16
DEFECT_RECORDS = 100


def _raw_csv_with_defects(spark: SparkSession, sf_dir: str) -> str:
    """The comments as raw CSV lines, some of them spoilt by their number.

    The first comments are sorted into the files that end in a record never closed. The others,
    which are nearly all, are written from where they are: a header leads the rows of each file.
    """
    path = new_dir(spark, "raw-defects")
    number = F.col("id").cast("bigint")
    comments = _comments(spark, sf_dir)
    line = F.to_csv(
        F.struct(*comments.columns),
        {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"},
    )
    before_last = F.regexp_replace(line, ",[^,]*$", "")
    unclosed = F.concat(F.lit("comment,"), "id", F.lit(',7,news,true,0,/c,"never closed, so,,'))
    spoilt = (
        F.when(number < DEFECT_FILES, unclosed)
        .when(number % 211 == 0, before_last)
        .when(number % 223 == 0, F.concat(line, F.lit(",more")))
        .when(number % 227 == 0, F.concat(before_last, F.lit(",n/a")))
        .otherwise(line)
    )
    sorted_in = number < DEFECT_FILES * DEFECT_RECORDS
    lines = comments.where(sorted_in).select(
        (number % DEFECT_FILES).alias("file"),
        F.when(number < DEFECT_FILES, 2).otherwise(1).alias("place"),
        spoilt.alias("value"),
    )
    header = ",".join(RAW_HEADER)
    headers = spark.range(DEFECT_FILES).select(
        F.col("id").alias("file"), F.lit(0).alias("place"), F.lit(header).alias("value")
    )
    (
        lines.unionByName(headers)
        .repartition(DEFECT_FILES, "file")
        .sortWithinPartitions("file", "place")
        .select("file", "value")
        .write.partitionBy("file")
        .text(f"{path}/unclosed")
    )
    # The lower 33 bits count the rows of a task, which fill one file after the other.
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    (
        comments.where(~sorted_in)
        .select(spoilt.alias("value"), row.alias("row"))
        .select(
            F.when(F.col("row") % RAW_FILE_ROWS == 0, F.concat(F.lit(header + "\n"), "value"))
            .otherwise(F.col("value"))
            .alias("value")
        )
        .write.option("maxRecordsPerFile", RAW_FILE_ROWS)
        .option("compression", RAW_COMPRESSION)
        .text(f"{path}/others")
    )
    return path


def _landing_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and what their parsed columns add up to, by outcome and bad columns."""
    raw = _raw_csv_with_defects(spark, sf_dir)
    landing = land_checked(spark, raw, new_dir(spark, "checked"))
    rejects = landing.rejects.select(
        "kind", F.array_join("bad_columns", ",").alias("bad_columns"), "id", "score", "body"
    )
    accepted = landing.comments.select(
        F.lit("accepted").alias("kind"), F.lit("").alias("bad_columns"), "id", "score", "body"
    )
    bodies = F.when(F.col("kind") != "unclosed_quote", F.length("body"))
    return (
        accepted.unionByName(rejects)
        .groupBy("kind", "bad_columns")
        .agg(
            F.count("*").alias("records"),
            F.sum(F.col("id").cast("bigint")).alias("id_sum"),
            F.sum("score").alias("score_sum"),
            F.sum(bodies).cast("bigint").alias("characters"),
        )
    )


# --- driver contract ---------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Daily trend of the smallest test data."""
    return queries()["daily_trend"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {
        "daily_trend": _report(O.daily_trend),
        "hourly_pattern": _report(O.hourly_pattern),
        "hourly_pattern_unknown_times": _report(_pattern_unknown_times),
        "activity_anomalies": _report(O.activity_anomalies),
        "activity_anomalies_sigma2": _report(lambda c: O.activity_anomalies(c, threshold=2)),
        "activity_anomalies_blocks": _report(
            lambda c: O.activity_anomalies(c, threshold=2, block_rows=100)
        ),
        "sentiment_by_score_band": _report(O.sentiment_check),
        "score_sentiment_matrix": _report(O.score_sentiment_matrix),
        "extreme_comments": _report(lambda c: O.extreme_comments(c, limit=500)),
        "community_controversy": _report(O.community_controversy),
        "community_comparison": _report(O.community_comparison),
        "activity_anomalies_from_summary": _report(
            lambda c: O.activity_anomalies(by_hour(c), threshold=2)
        ),
        "score_sentiment_matrix_from_summary": _report(
            lambda c: O.score_sentiment_matrix(by_community(c))
        ),
        "community_comparison_from_summary": _report(
            lambda c: O.community_comparison(by_community(c))
        ),
        "top_words_by_sentiment": _report(lambda c: O.top_words_by_sentiment(c, top_n=50)),
        "word_count": _word_count,
        "cleaned_text": _report(_cleaned_text),
        "topic_vocabulary": _report(_vocabulary),
        "topic_vocabulary_counts": _report(_vocabulary_counts),
        "topics_lda": _report(_topics),
        "topics_lda_checks": _report(_topic_checks),
        "weekly_heatmap": _report(lambda c: O.weekly_heatmap(O.hourly_pattern(c))),
        "community_ranking": _report(lambda c: O.community_ranking(O.community_comparison(c))),
        "recent_alerts": _report(lambda c: O.recent_alerts(O.activity_anomalies(c))),
        "csv_scan": _csv_scan,
        "csv_scan_split": _csv_scan_split,
        "bronze_landing": _bronze_landing,
        "dataset_landing": _dataset_landing,
        "landing_rejects": _landing_rejects,
        "result_round_trip": _round_trip("parquet"),
        "result_round_trip_csv": _round_trip("csv"),
        "serving_cleanup": _report(_serving_cleanup),
        "declared_checks": _report(_declared_checks),
        "published_results": _published_results,
        "result_views": _result_views,
        "full_run_outputs": _full_run_outputs,
        **LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    """SQL for every query that SQL can express."""
    return {**ORACLES, **LLM_ORACLES}
