"""Writers for results: files and serving tables."""

from .files import write_result
from .tables import (
    Writer,
    clean_for_serving,
    jdbc_writer,
    publish_results,
    publish_table,
    table_writer,
    with_surrogate_id,
)
from .versions import live_versions, publish_version, version_writer

__all__ = [
    "Writer",
    "clean_for_serving",
    "jdbc_writer",
    "live_versions",
    "publish_results",
    "publish_table",
    "publish_version",
    "table_writer",
    "version_writer",
    "with_surrogate_id",
    "write_result",
]
