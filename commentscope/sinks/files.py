"""Result files."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Quotes doubled and outer spaces kept, so that any text comes back as it was.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_result(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    mode: str = "overwrite",
    single_file: bool = False,
    rows_per_file: int | None = None,
    compression: str | None = None,
) -> None:
    """Write a result in the given format.

    `single_file` sends the result through one task: for small reports only. `rows_per_file` lets a
    task begin a new file after so many rows, which CSV needs to be read by many tasks.
    """
    writer = (df.coalesce(1) if single_file else df).write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if compression is not None:
        writer = writer.option("compression", compression)
    writer.save(path)
