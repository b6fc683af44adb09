"""Reader for stored results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import RESULTS

# Text that no field holds: an empty unquoted field is NULL, an empty quoted one is empty text.
NO_SUCH_TEXT = "\x00null"


def read_result(spark: SparkSession, path: str, table: str, fmt: str = "parquet") -> DataFrame:
    """A stored result with the declared types of `table`."""
    reader = spark.read.schema(RESULTS[table].columns)
    if fmt == "csv":
        reader = reader.options(
            header=True, multiLine=True, escape='"', enforceSchema=False, nullValue=NO_SUCH_TEXT
        )
    return reader.format(fmt).load(path)
