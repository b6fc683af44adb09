"""Session factory. Storage credentials belong in Spark configuration, not here."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.rdd.compress": "true",
    "spark.speculation": "false",
    "spark.driver.maxResultSize": "2g",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def create_session(
    app_name: str = "commentscope",
    *,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    s3a_endpoint: str | None = None,
    extra: Mapping[str, str] | None = None,
) -> SparkSession:
    """Session with UTC days and adaptive execution.

    Leave `master` unset on a cluster, where spark-submit gives it. Size
    `shuffle_partitions` so that a shuffle partition stays near 128-200 MB; adaptive
    execution merges smaller ones. `s3a_endpoint` names an S3-compatible store reached by
    path-style addresses. `extra` wins over every default.
    """
    settings = dict(DEFAULTS)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if s3a_endpoint is not None:
        settings["spark.hadoop.fs.s3a.endpoint"] = s3a_endpoint
        settings["spark.hadoop.fs.s3a.path.style.access"] = "true"
        settings["spark.hadoop.fs.s3a.connection.ssl.enabled"] = str(
            not s3a_endpoint.startswith("http://")
        ).lower()
    settings.update(extra or {})

    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
