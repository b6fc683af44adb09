"""Serving tables: cleaning, conforming and publishing results."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import event_time, parse_time
from ..operators.numbering import numbered
from ..schemas import conform, violation_counts

STATUS = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("violations", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

Writer = Callable[[DataFrame, str, str], None]


def clean_for_serving(df: DataFrame, *, unix_as_timestamp: bool = False) -> DataFrame:
    """Drop index columns that other tools add, and give time columns a type.

    `periodo` becomes a timestamp. `created_utc` becomes a bigint, as declared, or a timestamp
    on request. What does not parse becomes NULL.
    """
    kinds = dict(df.dtypes)

    def typed(name: str) -> Column:
        column = F.col(f"`{name}`")
        if name == "periodo" and kinds[name] != "timestamp":
            return parse_time(column).alias(name)
        if name == "created_utc":
            seconds = column if kinds[name] == "bigint" else column.try_cast("bigint")
            return (event_time(seconds) if unix_as_timestamp else seconds).alias(name)
        return column

    return df.select(*[typed(c) for c in df.columns if not c.startswith("Unnamed")])


def with_surrogate_id(df: DataFrame, run_name: str) -> DataFrame:
    """A unique `row_id` per row: the run's name and the row's place in the order of all columns.
    The same rows get the same ids in every load and after every retry."""
    return numbered(df, df.columns, "row_id").select(
        F.concat_ws("-", F.lit(run_name), F.col("row_id")).alias("row_id"),
        *[F.col(f"`{c}`") for c in df.columns],
    )


def table_writer(database: str | None = None, fmt: str = "parquet") -> Writer:
    """Writer into catalog tables."""

    def write(df: DataFrame, table: str, mode: str) -> None:
        name = f"{database}.{table}" if database else table
        df.write.format(fmt).mode(mode).saveAsTable(name)

    return write


def jdbc_writer(url: str, **options: str) -> Writer:
    """Writer into database tables; `overwrite` empties a declared table and keeps its rules."""

    def write(df: DataFrame, table: str, mode: str) -> None:
        target = {"url": url, "dbtable": table, "truncate": "true", **options}
        df.write.format("jdbc").options(**target).mode(mode).save()

    return write


def broken_rules(counts: Mapping[str, int]) -> dict[str, int]:
    return {name: n for name, n in counts.items() if name != "rows" and n}


def publish_table(
    df: DataFrame,
    table: str,
    write: Writer,
    *,
    mode: str = "overwrite",
    reject_violations: bool = False,
    surrogate_id: bool = False,
    run_name: str = "run",
) -> dict[str, int]:
    """Conform a result to its declared table and write it; returns counts of rows and of
    broken rules, taken while writing.

    With `reject_violations`, the rules are checked first, and a result that breaks one is not
    written.
    """
    ready = conform(clean_for_serving(df), table)
    counts = violation_counts(table)
    if reject_violations:
        broken = broken_rules(ready.agg(*counts).first().asDict())
        if broken:
            raise ValueError(f"{table}: rows break declared rules: {json.dumps(broken)}")
    if surrogate_id:
        ready = with_surrogate_id(ready, run_name)
    observed = Observation()
    write(ready.observe(observed, *counts), table, mode)
    return observed.get


def publish_results(
    spark: SparkSession,
    results: Mapping[str, DataFrame | Callable[[], DataFrame]],
    write: Writer,
    *,
    modes: Mapping[str, str] | None = None,
    reject_violations: bool = False,
    surrogate_id: bool = False,
    run_name: str = "run",
) -> DataFrame:
    """Publish each result; a row per table tells how it went.

    A result may be a function that reads it, so that an unreadable one counts as a failure of
    its table. A failing table leaves the others alone. `modes` says which tables grow by
    "append" instead of being replaced.
    """
    rows = []
    for table, result in results.items():
        try:
            df = result() if callable(result) else result
            mode = (modes or {}).get(table, "overwrite")
            counts = publish_table(
                df, table, write, mode=mode, reject_violations=reject_violations,
                surrogate_id=surrogate_id, run_name=run_name,
            )
            broken = json.dumps(broken_rules(counts))
            rows.append((table, "published", counts["rows"], broken, None))
        except Exception as error:  # one table's failure is that table's status
            rows.append((table, "failed", None, None, f"{type(error).__name__}: {error}"))
    return spark.createDataFrame(rows, STATUS)
