"""Tables that change at once: every publishing is a version of its own, behind a view.

The rows of all versions of a table lie in one store, partitioned by run and version. What readers
see under the table's name is a view over the versions that count now. Publishing writes the new
version where no reader looks and then replaces the view, which is one catalog operation: a reader
sees the rows of before or of after, and a publishing that fails leaves nothing to see. A run has
one version that counts, so publishing it again, or retrying it, replaces its rows, whether the
table is replaced by each run or grows by one run after the other.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Writer

STORE_SUFFIX = "__versions"
RUN, VERSION = "_run", "_version"
PROPERTY = "commentscope.live"


def _quoted(text: str) -> str:
    """Text for between the quotes of an SQL literal."""
    return text.replace("\\", "\\\\").replace("'", "\\'")


def live_versions(spark: SparkSession, name: str) -> dict[str, str]:
    """The version that counts of each run of a published table; empty for a new one."""
    if not spark.catalog.tableExists(name):
        return {}
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if PROPERTY not in properties:
        raise ValueError(f"{name} exists and was not published in versions")
    return json.loads(properties[PROPERTY])


def _show(spark: SparkSession, name: str, columns: list[str], live: dict[str, str]) -> None:
    """Let readers of `name` see these versions from now on."""
    shown = ", ".join(f"'{v}'" for v in live.values())
    listed = ", ".join(f"`{c}`" for c in columns)
    state = json.dumps(live, sort_keys=True)
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{PROPERTY}' = '{_quoted(state)}') AS "
        f"SELECT {listed} FROM {name}{STORE_SUFFIX} WHERE {VERSION} IN ({shown})"
    )


def _remove(spark: SparkSession, store: str, kept: set[str]) -> None:
    """Drop the rows of all versions but `kept`."""
    for row in spark.sql(f"SHOW PARTITIONS {store}").collect():
        run, version = (unquote(part.split("=", 1)[1]) for part in row[0].split("/"))
        if version not in kept:
            spark.sql(
                f"ALTER TABLE {store} DROP IF EXISTS PARTITION "
                f"({RUN} = '{_quoted(run)}', {VERSION} = '{version}')"
            )


def publish_version(df: DataFrame, name: str, run: str, *, replace: bool) -> None:
    """Make `df` the rows of `run` in the table `name`. With `replace` they are its only rows, else
    the rows of other runs stay.

    The versions that were shown last are kept until the next publishing, for readers that are
    still at work; older ones, and what failed publishings left, go. One publisher at a time.
    """
    spark = df.sparkSession
    before = live_versions(spark, name)
    version = uuid.uuid4().hex
    store = f"{name}{STORE_SUFFIX}"
    rows = df.withColumns({RUN: F.lit(run), VERSION: F.lit(version)})
    rows.write.format("parquet").mode("append").partitionBy(RUN, VERSION).saveAsTable(store)
    live = {**({} if replace else before), run: version}
    _show(spark, name, df.columns, live)
    _remove(spark, store, {*before.values(), *live.values()})


def version_writer(database: str, run: str) -> Writer:
    """Writer into versioned tables of a catalog database, for the rows of one run."""

    def write(df: DataFrame, table: str, mode: str) -> None:
        if mode not in ("overwrite", "append"):
            raise ValueError(f"no such mode: {mode}")
        publish_version(df, f"{database}.{table}", run, replace=mode == "overwrite")

    return write
