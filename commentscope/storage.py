"""Shared scratch storage for data that must outlive executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder instead.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not configured and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="commentscope-"))
    return configured or context.getCheckpointDir()


# Local property that names the open scope; Spark hands it on to threads that a job starts.
SCOPE = "commentscope.scratch"


def _root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/commentscope"


def new_dir(spark: SparkSession, purpose: str) -> str:
    """Path of a fresh folder below the shared one, within the open scope if there is one."""
    scope = spark.sparkContext.getLocalProperty(SCOPE)
    folder = f"{_root(spark)}/{scope}" if scope else _root(spark)
    return f"{folder}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Scope whose scratch tables go when it ends, by an error too.

    What is computed within must be written, or collected, before the scope ends. A scope within
    a scope ends by itself; scopes of other threads are left alone.
    """
    context = spark.sparkContext
    outer = context.getLocalProperty(SCOPE)
    scope = f"{outer}/scope-{uuid.uuid4().hex}" if outer else f"scope-{uuid.uuid4().hex}"
    context.setLocalProperty(SCOPE, scope)
    try:
        yield
    finally:
        context.setLocalProperty(SCOPE, outer)
        remove(spark, f"{_root(spark)}/{scope}")


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, in whatever store it is; nothing happens where there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`df` as a table below the shared folder: computed once, and independent of executors."""
    path = new_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds files that Spark would read, in whatever store it is."""
    try:
        return not spark.read.format("binaryFile").load(path).select("path").isEmpty()
    except AnalysisException:
        return False
